"""Episodes spread over many tasks give what whole ones give."""

import time

import pytest
from pyspark.sql import functions as F

from cadenza.operators import deltas, frames, motion
from cadenza.scan import Segments


@pytest.fixture(scope="module")
def long(spark):
    """One long episode, some short ones, one without an index; times with ties, nulls in values."""
    n = F.when(F.col("id") < 4000, 1).when(F.col("id") < 4010, 2).when(F.col("id") < 4011, 3).otherwise(F.lit(None)).cast("long")
    rows = spark.range(4100).withColumn("episode_index", n).withColumn("frame_index", F.col("id") - F.when(F.col("id") < 4000, 0).when(F.col("id") < 4010, 4000).when(F.col("id") < 4011, 4010).otherwise(4011))
    x = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    rows = rows.withColumn("ts", F.floor(F.col("frame_index") * 0.7 + 3 * x) / 10).withColumn("value", F.when(x > 0.2, x))
    rows = rows.withColumn("action", F.array(F.when(F.col("frame_index").between(500, 3000), x).otherwise(0.0), F.lit(0.5), x)).withColumn("clamped", x > 0.9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small as it is, it is to go over several tasks
    yield rows.repartition(7).cache()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def same(a, b):
    rows = lambda df: sorted(map(repr, df.select(*sorted(df.columns)).collect()))
    assert rows(a) == rows(b)


def test_running_values(spark, long):
    want = {}
    rows = sorted(long.collect(), key=lambda r: (r.episode_index is not None, r.episode_index or 0, r.frame_index))
    for r in rows:
        before = want.get(r.episode_index, [])
        want.setdefault(r.episode_index, []).append((r.frame_index, r.value, before))
    scan = Segments(long.select("episode_index", "frame_index", "value"), "episode_index", F.col("frame_index"))
    v = F.col("value")
    got = scan.running(s=("sum", F.lit(1)), lo=("min", v), hi=("max", v, 1), prev=("last", v), nxt=("next", v, 1)).rows
    assert scan.kept.select(scan.pid).distinct().count() > 2
    assert len(got.columns) == 8
    by_key = {}
    for r in got.collect():
        by_key.setdefault(r.episode_index, {})[r.frame_index] = r
    for key, listed in want.items():
        values = [x[1] for x in listed]
        for i, (f, _, _) in enumerate(listed):
            r, some = by_key[key][f], [x for x in values[: i + 1] if x is not None]
            earlier, later = [x for x in values[:i] if x is not None], [x for x in values[i + 1 :] if x is not None]
            assert (r.s, r.lo, r.hi) == (i + 1, min(some, default=None), max(earlier, default=None))
            assert (r.prev, r.nxt) == (some[-1] if some else None, later[0] if later else None)


def test_nearest(long):
    left = long.select("episode_index", "ts", "frame_index").filter("frame_index % 3 = 0")
    right = long.filter("frame_index % 7 = 1").select("episode_index", (F.col("ts") + 0.05).alias("ts"), "value")
    for tolerance in (None, 0.2):
        same(frames.nearest_asof(left, right, tolerance=tolerance, last=True, segmented=True), frames.nearest_asof(left, right, tolerance=tolerance, last=True))


def test_runs_subsample_motion_smoothness(long):
    mask = F.coalesce(F.col("value") > 0.3, F.lit(False))
    some = long.filter("episode_index IS NOT NULL")
    same(frames.sustained_runs(some, mask, 3, segmented=True), frames.sustained_runs(some, mask, 3))
    same(frames.subsample(some, "ts", 2.0, segmented=True), frames.subsample(some, "ts", 2.0))
    names = ["joint1", "joint2", "gripper"]
    same(motion.detect_motion_window(some, names, segmented=True), motion.detect_motion_window(some, names))
    rounded = lambda df: df.select("episode_index", "frame_index", "step_count", *(F.round(c, 9).alias(c) for c in ("step", "step_mean", "step_std", "step_max", "change_mean", "change_max", "clamped_pct")))
    same(rounded(deltas.smoothness(some, segmented=True, block=256)), rounded(deltas.smoothness(some)))


def test_deadband_is_a_fold_in_order(spark, long):
    rows = long.select("episode_index", "frame_index", "action").unionByName(spark.createDataFrame([(9, 0, None), (9, 1, [1.0]), (9, 2, [None, 2.0]), (9, 3, [1.05, float("nan"), 4.0]), (9, 4, [1.2])], "episode_index long, frame_index long, action array<double>"))
    got = {(r.episode_index, r.frame_index, r.joint): r.published for r in deltas.deadband(rows, 0.1).collect()}
    want, last = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.episode_index or 0, r.frame_index)):
        for j, x in enumerate(r.action or []):
            was = last.get((r.episode_index, j))
            if x is not None and (was is None or abs(x - was) >= 0.1):
                last[(r.episode_index, j)] = x
            want[(r.episode_index, r.frame_index, j)] = last.get((r.episode_index, j))
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}


def test_deadband_takes_linear_time(spark):
    def took(n):
        rows = spark.range(n).select(F.lit(1).alias("episode_index"), F.col("id").alias("frame_index"), F.array((F.col("id") % 100) / 10).alias("action"))
        began = time.perf_counter()
        deltas.deadband(rows, 0.5).agg(F.sum("published")).collect()
        return time.perf_counter() - began

    took(20_000)
    assert took(160_000) < 8 * took(20_000) + 2


def test_smoothness_costs_the_same_at_any_window(spark):
    """Before, each row went through all rows of its window again."""
    rows = spark.range(20_000).select(F.lit(1).alias("episode_index"), F.col("id").alias("frame_index"), F.array(F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("action")).repartition(1).cache()
    rows.count()

    def took(window):
        began = time.perf_counter()
        deltas.smoothness(rows, window=window).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    took(10)
    assert took(8000) < 5 * took(10) + 1


@pytest.mark.parametrize("window", [1, 2, 3, 7, 40])
def test_smoothness_windows_against_brute_force(spark, window):
    at = [None if k % 11 == 5 else [float(k * k % 17), k / 3] for k in range(30)]
    rows = spark.createDataFrame([(e, k, a) for e, n in ((1, 30), (2, 8), (3, 1)) for k, a in enumerate(at[:n])], "episode_index long, frame_index long, action array<double>")
    got = {(r.episode_index, r.frame_index): r for r in deltas.smoothness(rows, window=window).collect()}
    assert len(got) == 39
    for e, n in ((1, 30), (2, 8), (3, 1)):
        step = [None if k == 0 or at[k] is None or at[k - 1] is None else sum((x - y) ** 2 for x, y in zip(at[k], at[k - 1], strict=True)) ** 0.5 for k in range(n)]
        change = [None if k == 0 or step[k] is None or step[k - 1] is None else abs(step[k] - step[k - 1]) for k in range(n)]
        for k in range(n):
            last, moved = ([x for x in v[max(0, k - window + 1) : k + 1] if x is not None] for v in (step, change))
            r = got[e, k]
            mean = sum(last) / len(last) if last else 0
            want = [mean, (sum((x - mean) ** 2 for x in last) / len(last)) ** 0.5, max(last)] if len(last) >= 2 else [None] * 3
            want += [sum(moved) / len(moved), max(moved)] if len(last) >= 2 and moved else [None] * 2
            assert [r.step_mean, r.step_std, r.step_max, r.change_mean, r.change_max] == [x if x is None else pytest.approx(x, abs=1e-9) for x in want]
