"""Streaming operators against the batch ones, on files that arrive one by one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import coverage, deltas
from cadenza.streaming import monitor, ordered

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def streamed(spark, tmp_path):
    """Runs an operator over micro-batches of rows (a list of lists) and gives what it wrote."""

    def run(operator, batches, schema):
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        query = operator(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        return spark.read.parquet(f"{tmp_path}/out").collect()

    return run


@pytest.fixture
def ended(spark, tmp_path_factory):
    """Like streamed, for processors in order: each call by itself, and no state may be left at the end."""

    def run(operator, batches, schema):
        path = tmp_path_factory.mktemp("ordered")
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        ordered.state_store(spark)
        try:
            for i, rows in enumerate(batches):
                spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in/{i}")
            source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{path}/in")
            query = operator(source).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination(240)
            sizes = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
            assert max(sizes) > 0 and sizes[-1] == 0, sizes
            return spark.read.parquet(f"{path}/out").collect()
        finally:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)

    return run


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_rates_equal_those_of_the_batch(spark, streamed):
    schema = "episode_index long, topic string, ts timestamp"
    batches = [[(1, "cam", at(10 * b + i / 5)) for i in range(50)] + [(1, "slow", at(10 * b + i)) for i in range(10)] for b in range(4)] + [[(1, "cam", at(500))], [(1, "cam", at(600))]]
    operator = lambda df: monitor.window_rates(df, seconds=10, expected={"cam": 5.0, "slow": 3.0})
    got = {tuple(r) for r in streamed(operator, batches, schema) if r.start < at(100)}
    whole = operator(spark.createDataFrame([r for b in batches for r in b], schema)).filter(F.col("start") < F.lit(at(100))).collect()
    assert got == {tuple(r) for r in whole} and len(got) == 8
    assert all(r.slow == (r.topic == "slow") for r in whole)


def test_episode_ends(streamed):
    schema = "episode_index long, side string, ts timestamp"
    batches = [[(1, "truth", at(i / 10)) for i in range(20)], [(1, "prediction", at(2 + i / 10)) for i in range(10)], [(1, "truth", at(20 + i / 10)) for i in range(5)], [(1, "truth", at(100))], [(1, "truth", at(200))]]
    got = sorted(tuple(r) for r in streamed(monitor.episode_ends, batches, schema))
    assert got[:2] == [(1, at(0), at(2.9 + 2.5), 30), (1, at(20), at(21.4), 5)]


def test_bottleneck_of_each_window(spark, streamed):
    schema = "episode_index long, topic string, ts timestamp"
    batches = [[(1, "a", at(10 * b + i / 5)) for i in range(50)] + [(1, "b", at(10 * b + i)) for i in range(10 if b else 0)] for b in range(3)] + [[(1, "z", at(600))], [(1, "z", at(700))]]
    expected = {"a": 5.0, "b": 3.0, "c": 0.1}
    operator = lambda df: monitor.bottlenecks(df, expected)
    got = sorted(tuple(r) for r in streamed(operator, batches, schema))
    whole = operator(spark.createDataFrame([r for b in batches for r in b], schema)).filter(F.col("start") < F.lit(at(100))).collect()
    assert got == sorted(tuple(r) for r in whole) == [(at(0), 1, 2, "b", 0.0), (at(10), 1, 2, "c", 0.0), (at(20), 1, 2, "c", 0.0)]
    some = operator(spark.createDataFrame([(1, t, at(i / 2)) for t in ("b", "c") for i in range(20)] + [(1, "a", at(i)) for i in range(9)], schema)).collect()
    assert [tuple(r)[2:] for r in some] == [(1, "a", 0.9)]


def shuffled(rows, n, seed, late=0.0):
    """Rows dealt to n micro-batches in an order that is wrong by `late` seconds at most, and then only the clock."""
    rng = random.Random(seed)
    times = sorted(rows, key=lambda r: r[-1] + dt.timedelta(seconds=rng.uniform(0, late)))
    parts = [times[i * len(times) // n : (i + 1) * len(times) // n] for i in range(n)]
    for p in parts:
        rng.shuffle(p)
    return parts


def clock(width):
    return [[(*(None,) * width, at(t))] for t in (5_000, 6_000, 7_000)]


def test_throttled_to_a_maximum(ended):
    schema = "episode_index long, camera string, name string, ts timestamp"
    rows = [(e, c, f"{c}{i}", at(100 * e + i / 30)) for e in (1, 2) for c in "ab" for i in range(300)]
    got = ended(lambda df: monitor.throttled(df, most=5, payload="name"), shuffled(rows, 6, 1, 1.0) + clock(3), schema)
    assert sorted((r.episode_index, r.camera, r.ts, r.payload) for r in got) == sorted((e, c, at(100 * e + i), f"{c}{30 * i}") for e in (1, 2) for c in "ab" for i in range(5))
    again = ended(monitor.throttled, [[(1, "a", None, at(t))] for t in (0.4, 1.1, 1.5, 2.3, 2.5, 9.0)] + clock(3), schema)
    assert sorted(r.ts for r in again) == [at(0.4), at(1.5), at(2.5), at(9.0)]


def test_a_topic_that_stops_alerts(spark, ended):
    schema = "episode_index long, topic string, ts timestamp"
    rng = random.Random(4)
    times = {(e, t): [0.1 * i + rng.uniform(0, 0.02) for i in range(120) if not (t == "gaps" and (30 <= i < 50 or i == 80)) and not (t == "stops" and i > 60)] for e in (1, 2) for t in ("gaps", "stops", "steady")}
    rows = [(e, t, at(x)) for (e, t), xs in times.items() for x in xs]
    got = ended(lambda df: monitor.gap_alerts(df, watermark="3 seconds"), shuffled(rows, 8, 5, 2.5) + [[(1, "steady", at(15))]] + clock(2), schema)
    gaps = {(r.episode_index, r.topic, r.start, r.end) for r in got if r.kind == "gap"}
    frames = spark.createDataFrame([(e, t, "stream", at(x).timestamp()) for (e, t), xs in times.items() for x in xs], "episode_index long, topic string, role string, ts double")
    batch = coverage.topic_coverage(frames).select("episode_index", "topic", F.explode("gaps").alias("g")).select("episode_index", "topic", "g.*").filter("kind = 'dropframe'").collect()
    first = frames.groupBy("episode_index").agg(F.min("ts").alias("t")).collect()
    begin = {r.episode_index: r.t for r in first}
    assert {(e, t, round((s - START).total_seconds(), 3), round((x - START).total_seconds(), 3)) for e, t, s, x in gaps if t != "steady"} == {(r.episode_index, r.topic, round(begin[r.episode_index] + r.start_s - START.timestamp(), 3), round(begin[r.episode_index] + r.end_s - START.timestamp(), 3)) for r in batch}
    silent = {(r.episode_index, r.topic, r.start): r for r in got if r.kind == "silent"}
    for e in (1, 2):
        stopped = silent[(e, "stops", max(r[2] for r in rows if r[:2] == (e, "stops")))]
        assert 0.4 < (stopped.end - stopped.start).total_seconds() < 0.7
    assert {(r.episode_index, r.topic, r.start) for r in got if r.kind == "gap"} <= silent.keys()


def test_latest_values(ended):
    schema = "episode_index long, side string, value double, ts timestamp"
    rows = [(1, "obs", 1.0, at(0)), (1, "raw", 2.0, at(0.1)), (1, "cmd", 3.0, at(0.2)), (1, "raw", 4.0, at(0.3)), (1, "cmd", 5.0, at(0.4)), (1, "obs", None, at(0.5)), (1, "raw", 6.0, at(0.6)), (1, "cmd", 7.0, at(0.7)), (1, "obs", 8.0, at(0.8)), (2, "raw", 6.0, at(0.6)), (1, "other", 1.0, at(0.9))]
    for seed in range(2):
        got = sorted((r.ts, r.obs, r.raw, r.cmd) for r in ended(monitor.latest_sync, shuffled(rows, 3, seed, 2.0) + clock(3), schema))
        assert got == [(at(0.2), 1.0, 2.0, 3.0), (at(0.4), 1.0, 4.0, 5.0), (at(0.8), 8.0, 6.0, 7.0)]
    got = ended(monitor.latest_sync, [[(1, s, [1.0, float(k)], at(k)) for k, s in enumerate(("obs", "raw", "cmd"))]] + clock(3), "episode_index long, side string, value array<double>, ts timestamp")
    assert [tuple(r)[2:] for r in got] == [([1.0, 0.0], [1.0, 1.0], [1.0, 2.0])]


def test_fresh_sets(ended):
    schema = "episode_index long, topic string, ts timestamp"
    rows = [(1, "a", at(0)), (1, "b", at(1)), (1, "c", at(1.5)), (1, "a", at(2)), (1, "a", at(3)), (1, "b", at(4))]
    got = ended(lambda df: monitor.fresh_sets(df, ("a", "b")), shuffled(rows, 3, 3, 4.0) + clock(2), schema)
    assert sorted(r.ts for r in got) == [at(1), at(4)]


def test_nearest_equals_the_batch_twin(spark, ended):
    schema = "episode_index long, side string, value double, ts timestamp"
    rng = random.Random(7)
    rows = [(e, "frame", float(i), at(i / 3)) for e in (1, 2) for i in range(60)] + [(e, "sample", 100.0 + i, at(rng.uniform(0, 20))) for e in (1, 2) for i in range(15)] + [(1, "sample", 50.0, at(2.0)), (1, "sample", 51.0, at(8 / 3))]
    got = sorted((r.episode_index, r.value, r.nearest) for r in ended(lambda df: monitor.nearest_match(df, tolerance=0.5), shuffled(rows, 7, 8, 3.0) + clock(3), schema))
    want = []
    for e, _, v, t in [r for r in rows if r[1] == "frame"]:
        near = sorted((abs((x[3] - t).total_seconds()), x[3], x[2]) for x in rows if x[0] == e and x[1] == "sample" and abs((x[3] - t).total_seconds()) <= 0.5)
        want.append((e, v, near[0][2] if near else None))
    assert got == sorted(want, key=lambda r: r[:2]) and any(r[2] is None for r in got)


def test_smoothness_equals_the_batch_twin(spark, ended):
    rng = random.Random(9)
    rows = [(e, [rng.random(), rng.random()], rng.random() < 0.2, at(i / 20)) for e in (1, 2) for i in range(150)]
    got = ended(monitor.rolling_smoothness, shuffled(rows, 5, 10, 2.0) + clock(3), "episode_index long, value array<double>, clamped boolean, ts timestamp")
    frames = spark.createDataFrame([(e, round((t - START).total_seconds() * 20), v, c) for e, v, c, t in rows], "episode_index long, frame_index long, action array<double>, clamped boolean")
    names = ["step_mean", "step_std", "step_max", "change_mean", "change_max", "step_count", "clamped_pct"]
    want = {(r.episode_index, r.frame_index): [r[n] for n in names] for r in deltas.smoothness(frames).filter("step_mean IS NOT NULL").collect()}
    found = {(r.episode_index, round((r.ts - START).total_seconds() * 20)): [r[n] for n in names] for r in got}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12) for k in want)


def test_convert_new(spark, tmp_path):
    schema = "episode_index long, value double"
    source = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    for i in range(2):
        spark.createDataFrame([(i, 1.0)], schema).write.parquet(f"{tmp_path}/in/{i}")
        monitor.convert_new(source(), f"{tmp_path}/out", f"{tmp_path}/cp", lambda df: df.withColumn("twice", F.col("value") * 2)).awaitTermination(60)
    got = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out")
    assert sorted((r.episode_index, r.twice, r.batch) for r in got.collect()) == [(0, 2.0, 0), (1, 2.0, 1)]
