import numpy as np
import pytest

from cadenza.llm import ann, caps

SCHEMA = "vec_id long, embedding array<float>, norm int, block int"


def rows(n=600, d=32, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[100:200] = x[100] + 0.05 * rng.normal(size=(100, d))
    x[200:260] = x[200]
    x[300:340] = x[100:140] * 3
    x = x.astype(np.float32).astype(float)
    out = [(i, [float(v) for v in r], 0, 0) for i, r in enumerate(x)]
    bad = [(1000, None, 0, 0), (1020, [0.0] * d, 0, 0), (1040, [float("nan")] * d, 0, 0), (1060, [float("inf")] * d, 0, 0), (1080, [None, *[1.0] * (d - 1)], 0, 0), (1100, [1.0], 0, 0)]
    return x, out, bad


@pytest.fixture(scope="module")
def table(spark):
    x, good, bad = rows()
    return x, spark.createDataFrame(good + bad, SCHEMA)


def test_search_finds_nearly_all(spark, table):
    x, df = table
    index, model = ann.build(df)
    assert index.count() == len(x)
    got = ann.search(index, model, df.filter("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect()
    hit = 0
    for q in range(0, len(x), 20):
        own = [r for r in got if r.query_id == q]
        scores = (x * x[q]).sum(1)
        best = [i for i in np.lexsort((np.arange(len(x)), -scores)) if i != q][:20]
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(r.score == pytest.approx(scores[r.vec_id], abs=1e-12) for r in own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hit += len({r.vec_id for r in own} & set(best))
    assert len(got) == 30 * 20 and hit >= 0.9 * len(got)


def test_search_of_few_and_of_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, 0), (20, [0.5, 0.5], 0, 0), (3, [0.5, 0.5], 0, 0)], SCHEMA)
    index, model = ann.build(df)
    got = ann.search(index, model, df.filter("vec_id % 20 = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got)] == [(0, 1, 3, 0.5), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]
    empty = spark.createDataFrame([], SCHEMA)
    assert ann.search(*ann.build(empty), empty).count() == 0
    assert caps.near_duplicates(empty).count() == 0


def test_caps_against_brute_force(spark, table):
    x, df = table
    y = x / np.linalg.norm(x, axis=1)[:, None]
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        after = np.minimum(label, np.where(near, label[None, :], len(x)).min(1))
        if (after == label).all():
            break
        label = after
    got = {r.vec_id: r for r in caps.near_duplicates(df).collect()}
    assert len(got) == len(x) + 6
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), label[i], label[i] == i)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(1000, 1101, 20))


def test_blocks_report_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK", 16)
    rng = np.random.default_rng(3)
    x = rng.normal(size=32) + 0.01 * rng.normal(size=(90, 32))
    df = spark.createDataFrame([(i, r.tolist(), 1 + i % 3) for i, r in enumerate(x)], "node long, v array<double>, n long")
    got = caps.links(df).groupBy("node").sum("others").collect()
    whole = sum(1 + i % 3 for i in range(90))
    assert {r[0]: r[1] for r in got} == {i: whole - 1 - i % 3 for i in range(90)}
    assert caps.links(df).count() < 90 * 89 // 2


def test_repeated_and_null_ids(spark, table):
    x, df = table
    index, model = ann.build(df.union(df.filter("vec_id < 300")))
    plain = ann.search(*ann.build(df), df.filter("vec_id % 20 = 0"))
    twice = ann.search(index, model, df.filter("vec_id % 20 = 0").union(df.filter("vec_id IN (20, 220)")).union(spark.createDataFrame([(None, [1.0] * 32, 0, 0)], SCHEMA)))
    assert sorted(map(tuple, twice.select("query_id", "rank").collect())) == sorted(map(tuple, plain.select("query_id", "rank").collect()))
    for q in (20, 220):
        own = [r.vec_id for r in twice.filter(f"query_id = {q}").collect()]
        assert len(own) == len(set(own)) == 20
    found = caps.near_duplicates(df.union(df.filter("vec_id IN (0, 1)")).union(spark.createDataFrame([(None, [1.0] * 32, 0, 0)], SCHEMA))).collect()
    got = {r.vec_id: r for r in found}
    assert len(found) == df.count() + 3 and (got[0].n_links, got[0].component_id, got[0].kept) == (1, 0, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)


@pytest.mark.parametrize("d", [96, 768])
def test_links_in_other_dimensions(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(60, d))
    y = x + 0.3 * rng.normal(size=(60, d))
    df = spark.createDataFrame([(i, r.tolist(), 0, 0) for i, r in enumerate(np.concatenate([x, y]))], SCHEMA)
    z = np.concatenate([x, y]).astype(np.float32).astype(float)
    z /= np.linalg.norm(z, axis=1)[:, None]
    want = ((z @ z.T >= 0.95).sum(1) - 1).tolist()
    got = {r.vec_id: r.n_links for r in caps.near_duplicates(df).collect()}
    assert sum(want) > 20 and sum(got[i] == n for i, n in enumerate(want)) >= 118


@pytest.mark.parametrize("d", [16, 64, 128, 256, 768])
def test_caps_recall_at_other_dimensions(d):
    filters = caps.Filters(d)
    lists = [filters.decode(v) for v in caps.Filters.pairs(d, caps.THRESHOLD, 9, 500)]
    own = [[set(found[row == i].tolist()) for i in range(500)] for row, found in lists]
    assert sum(bool(a & b) for a, b in zip(*own, strict=True)) >= 497
    assert d < 64 or sum(map(len, own[0])) < 100 * 500


def test_cap_that_misses_is_an_error():
    with pytest.raises(ValueError):
        caps.Filters(256, cap=0.42)


def test_filters_grow_with_the_vectors():
    """At 100 times the vectors, filters have no more members, vectors meet no more than twice the filters, and pairs at the
    threshold are found."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    few = caps.MANY
    assert caps.words_for(few) == caps.words_for(1000) == caps.WORDS
    met, members = [], []
    for n in (few, 100 * few):
        words = caps.words_for(n)
        filters = caps.Filters(64, words=words)
        met.append(len(filters.decode(x)[0]) / len(x))
        members.append(n * met[-1] / (caps.TABLES * words * words))
        a, b = filters.pairs(64, caps.THRESHOLD, 99, 2000)
        assert filters.recall(a, b) >= 0.99
    assert met[1] <= 2 * met[0] and members[1] <= 2 * caps.BLOCK, (met, members)
