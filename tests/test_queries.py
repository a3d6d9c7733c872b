import pytest
from pyspark.sql import functions as F

from cadenza.operators import frames, splits
from cadenza.queries import ORACLES, QUERIES
from cadenza.shared import ranked, summed_before
from tests.oracle import compared

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    # hours of the smallest table have too few events for a topic that most of them have
    mine, theirs = compared(spark, QUERIES[name], ORACLES[name], "/root/testdata/sf0.01" if name == "missing_expected" else SF)
    assert mine == theirs and mine


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def greedy(times, fps):
    out, nxt = [], times[0]
    for t in times:
        if t >= nxt:
            out.append(t)
            nxt += 1 / fps
    return out


def test_subsample_is_greedy(spark):
    times = [0.0, 0.25, 0.5, 1.0, 1.25, 4.0, 4.25, 4.5, 4.75, 5.0, 9.0, 9.25]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "episode_index long, frame_index long, ts double")
    assert sorted(r.ts for r in frames.subsample(df, "ts", 2.0).collect()) == greedy(times, 2.0)


def test_ranks_and_sums_over_partitions(spark):
    rows = [(i % 3, (i * 7919) % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, x int, id int")
    got = {r.id: (r.k, r.w) for r in ranked(ranked(df, "k", F.col("x"), F.col("id")), "w", F.col("x"), F.col("id"), within="g").collect()}
    order = sorted((x, i) for _, x, i in rows)
    assert all(got[i][0] == k for k, (_, i) in enumerate(order, 1))
    for g in range(3):
        assert all(got[i][1] == k for k, (_, i) in enumerate((o for o in order if o[1] % 3 == g), 1))
    total, before = 0, {r.id: r.s for r in summed_before(df, "s", "x", F.col("x"), F.col("id")).collect()}
    for x, i in order:
        assert before[i] == total
        total += x
    assert ranked(df.filter("false"), "k", F.col("x")).count() == 0


def test_split_counts():
    assert splits.split_counts(33, (8, 1, 1)) == (27, 3, 3)
    for bad in ((0, (8, 1)), (3, (0, 0)), (3, (1,))):
        with pytest.raises(ValueError):
            splits.split_counts(*bad)
