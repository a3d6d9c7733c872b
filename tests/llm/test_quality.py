import math

import pytest

from cadenza.llm import quality
from cadenza.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, draw_key string, rank string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def found(spark):
    rows = quality.sampled(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    return {r.id: r for r in rows}


def test_draw_against_brute_force(spark, found):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    counts = [[quality.SMOOTH] * quality.BUCKETS for _ in range(2)]
    for i, t in texts.items():
        for b in quality.buckets(t):
            counts[0][b] += 1
            counts[1][b] += labels.get(i) == 1
    totals = [sum(c) for c in counts]
    for i, t in texts.items():
        own = quality.buckets(t)
        w = sum(math.log(counts[1][b] / totals[1]) - math.log(counts[0][b] / totals[0]) for b in own) * 16 / (len(own) + 16)
        assert math.isclose(w, found[i].log_weight, rel_tol=1e-8, abs_tol=1e-8)
    assert sorted(r.rank for r in found.values()) == list(range(1, len(texts) + 1))
    k = sum(r.kept for r in found.values())
    assert {i for i, r in found.items() if r.kept} == {i for i, r in found.items() if r.rank <= k}


def test_labelled_documents(spark, found):
    labels = [(found[r.doc_id].kept, r.quality) for r in table(spark, SF, "labels").collect() if r.doc_id in found]
    good = [kept for kept, q in labels if q == 1]
    bad = [kept for kept, q in labels if q == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_keep_good_takes_the_drawn(spark, found):
    docs = table(spark, SF, "documents")
    kept = quality.keep_good(docs, table(spark, SF, "labels"))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in found.items() if r.kept)


def test_inclusion_follows_the_weights(spark):
    """Of documents with one text each share one weight, drawn are 1 - exp(-weight * t) of them; another seed draws others."""
    kinds = ["calm useful sentence", "calm useful !!!", "calm !!! $$$", "!!! $$$ ???"]
    rows = [(i, kinds[i % 4], "", "") for i in range(4000)]
    labels = [(i, int(i % 4 < 2), 0) for i in range(0, 400)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    one, other = ({r.id: r for r in quality.sampled(docs, labels, keep=0.4, evidence=2.0, seed=seed).collect()} for seed in (42, 43))
    weights = [math.exp(one[k].log_weight) for k in range(4)]
    low, high = 0.0, 1e6
    for _ in range(200):
        t = (low + high) / 2
        low, high = (t, high) if sum(1 - math.exp(-w * t) for w in weights) < 1.6 else (low, t)
    for k, w in enumerate(weights):
        for found in (one, other):
            assert sum(found[i].kept for i in range(k, 4000, 4)) / 1000 == pytest.approx(1 - math.exp(-w * t), abs=0.05)
    assert sum(r.kept for r in one.values()) == 1600
    assert 200 < sum(one[i].kept != other[i].kept for i in one) < 3000
    assert sum(r.kept for r in quality.sampled(docs, labels, keep=7).collect()) == 7


def test_nulls_repeats_and_empty(spark):
    good, bad = "a calm and useful sentence about rivers", "BUY $$$ !!! NOW !!! $$$"
    rows = [(i, good if i % 2 else bad, "q", "r") for i in range(40)]
    rows += [(None, good, None, None), (None, None, None, None), (50, None, "", ""), (51, "", "", ""), (1, good, "q", "r"), (52, "neither one nor other kind " * 3000, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, None, 0)], LABELS)
    drawn = quality.sampled(docs, labels).collect()
    assert len(drawn) == len(rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    wanted = {(r.id, r.text_hash) for r in drawn if r.kept}
    both = kept.selectExpr("doc_id", "xxhash64(text) AS h").collect()
    assert {(r.doc_id, r.h) for r in both} == wanted
    likely = [r.kept for r in drawn if r.id is not None and r.id < 40 and r.id % 2]
    assert sum(likely) > sum(r.kept for r in drawn if r.id is not None and r.id < 40 and not r.id % 2)
    # without labels nothing is rejected
    assert quality.keep_good(docs, labels.filter("false")).count() == len(rows)
    assert quality.keep_good(docs.filter("false"), labels).count() == 0
