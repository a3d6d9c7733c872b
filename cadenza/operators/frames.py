"""Frames: alignment by nearest time, runs, chunks, deltas and renumbering within episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.scan import Segments
from cadenza.shared import summed_before


def nearest_asof(left: DataFrame, right: DataFrame, *, by: str = "episode_index", ts: str = "ts", value: str = "value", tolerance: float | None = None, last: bool = False, segmented: bool = False) -> DataFrame:
    """left with nearest_ts and nearest_value of the right row nearest in time, the earlier of two equally near; with last
    also last_value, of the latest row that isn't later.

    Both sides are merged and sorted once by key and time; the neighbours on either side are running values, so there
    is no join of all pairs. Of right rows at one time the one with the smallest value counts. segmented: a key's rows are
    spread over many tasks, for keys too long for one.
    """
    once = right.filter(F.col(ts).isNotNull()).groupBy(by, ts).agg(F.min(value).alias("r_value"))
    cols = left.columns
    rows = left.withColumn("r_ts", F.lit(None).cast(right.schema[ts].dataType)).withColumn("r_value", F.lit(None).cast(right.schema[value].dataType)).withColumn("side", F.lit(1))
    other = once.select(by, ts, F.col(ts).alias("r_ts"), "r_value", F.lit(0).alias("side"))
    merged = rows.unionByName(other, allowMissingColumns=True).withColumn("r", F.when(F.col("side") == 0, F.struct("r_ts", "r_value")))
    if segmented:
        merged = Segments(merged, by, F.col(ts), F.col("side")).running(before=("last", F.col("r")), after=("next", F.col("r"))).rows
    else:
        upto = lambda *order: Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        merged = merged.withColumn("before", F.last("r", ignorenulls=True).over(upto(ts, "side")))
        merged = merged.withColumn("after", F.last("r", ignorenulls=True).over(upto(F.col(ts).desc(), F.col("side").desc())))
    back, ahead = F.col(ts) - F.col("before.r_ts"), F.col("after.r_ts") - F.col(ts)
    near = F.when(ahead.isNull() | (back <= ahead), F.col("before")).otherwise(F.col("after"))
    out = merged.filter("side = 1").withColumn("near", near)
    if tolerance is not None:
        out = out.withColumn("near", F.when(F.abs(F.col(ts) - F.col("near.r_ts")) <= tolerance, F.col("near")))
    return out.select(*cols, F.col("near.r_ts").alias("nearest_ts"), F.col("near.r_value").alias("nearest_value"), *([F.col("before.r_value").alias("last_value")] if last else []))


def ordered(*order: str) -> Window:
    return Window.partitionBy("episode_index").orderBy(*order)


def episode_starts(sizes: DataFrame) -> DataFrame:
    """(episode_index, episode_start) from sizes (episode_index, n): how many frames the episodes before have."""
    return summed_before(sizes, "episode_start", "n", F.col("episode_index")).select("episode_index", "episode_start")


def relative_index(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """frames (episode_index, frame_index) of the given episodes with relative_index, their place among these frames."""
    some = frames.join(episodes.select("episode_index"), "episode_index", "left_semi")
    starts = episode_starts(some.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n")))
    return some.join(starts, "episode_index").withColumn("relative_index", F.col("episode_start") + F.col("frame_index")).drop("episode_start")


def reindex(frames: DataFrame, order: list[str], fps: float) -> DataFrame:
    """frames with frame_index from 0 in each episode, index over all episodes, and timestamp. The index comes from the
    number of frames before each episode, so frames of different episodes are never sorted together."""
    starts = episode_starts(frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n")))
    rows = frames.withColumn("frame_index", (F.row_number().over(ordered(*order)) - 1).cast("long")).join(starts, "episode_index")
    return rows.withColumn("index", F.col("episode_start") + F.col("frame_index")).withColumn("timestamp", F.col("frame_index") / F.lit(float(fps))).drop("episode_start")


def sustained_runs(frames: DataFrame, mask: Column, at_least: int, *, segmented: bool = False) -> DataFrame:
    """(episode_index, start_frame, run_length): runs of frames where mask holds, of at_least frames. segmented: for episodes
    too long for one task."""
    rows = frames.filter(mask)
    if segmented:
        rows = Segments(rows.select("episode_index", "frame_index"), "episode_index", F.col("frame_index")).running(n=("sum", F.lit(1))).rows
    else:
        rows = rows.withColumn("n", F.row_number().over(ordered("frame_index")))
    runs = rows.withColumn("island", F.col("frame_index") - F.col("n")).groupBy("episode_index", "island").agg(F.min("frame_index").alias("start_frame"), F.count(F.lit(1)).alias("run_length"))
    return runs.filter(F.col("run_length") >= at_least).drop("island")


def assign_chunks(frames: DataFrame, size: int, value: str) -> DataFrame:
    """frames with chunk_id and the reference held through the chunk: the value at its first frame."""
    rows = frames.withColumn("chunk_id", F.floor(F.col("frame_index") / size))
    return rows.withColumn("reference", F.first(value).over(Window.partitionBy("episode_index", "chunk_id").orderBy("frame_index")))


def subsample(frames: DataFrame, ts: str, fps: float, *, segmented: bool = False) -> DataFrame:
    """Frames that a greedy sampler at fps takes: one whose time has reached the next target, which then moves on by one
    period. In closed form: with m the periods since the start, i + min(1, running min of m_j + 1 - j) counts them.
    segmented: for episodes too long for one task."""
    order, slack = ordered(ts, "frame_index"), F.col("m") + 2 - F.col("i")
    if segmented:
        scan = Segments(frames, "episode_index", F.col(ts), F.col("frame_index"))
        scan = scan.running(i=("sum", F.lit(1)), start=("min", F.col(ts)))
        scan.kept = scan.kept.withColumn("m", F.floor((F.col(ts) - F.col("start")) * fps)).drop("start")
        rows = scan.running(least=("min", slack), least_before=("min", slack, 1)).rows
    else:
        rows = frames.withColumn("i", F.row_number().over(order)).withColumn("m", F.floor((F.col(ts) - F.first(ts).over(order)) * fps))
        rows = rows.withColumn("least", F.min(slack).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("least_before", F.lag("least").over(order))
    taken = lambda i, least: i + F.least(F.lit(1), least) - 1
    before = F.when(F.col("i") > 1, taken(F.col("i") - 1, F.col("least_before"))).otherwise(0)
    return rows.filter(taken(F.col("i"), F.col("least")) > before).drop("i", "m", "least", "least_before")


def stride_downsample(frames: DataFrame, ts: str, fps: float) -> DataFrame:
    """Every stride-th frame of an episode, the stride being its rate, by the upper median of the first 20 intervals, over
    fps, rounded half to even; all frames below four or for a stride of one. ts in seconds."""
    order = ordered(ts, "frame_index")
    rows = frames.withColumn("i", F.row_number().over(order) - 1).withColumn("dt", F.col(ts) - F.lag(ts).over(order))
    early = F.when(F.col("i").between(1, 20), F.col("dt"))
    whole = Window.partitionBy("episode_index")
    rows = rows.withColumn("n", F.count(F.lit(1)).over(whole)).withColumn("early", F.array_sort(F.collect_list(early).over(whole)))  # 20 at most
    median = F.element_at("early", (F.size("early") / 2).cast("int") + 1)
    stride = F.when((F.col("n") >= 4) & (median > 0), F.bround(1 / median / fps, 0).cast("int")).otherwise(1)
    return rows.withColumn("stride", F.greatest(F.lit(1), stride)).filter("i % stride = 0").drop("i", "dt", "n", "early", "stride")


def stride_samples(frames: DataFrame, k: int) -> DataFrame:
    """Every k-th frame of each episode."""
    return frames.filter(F.col("frame_index") % k == 0)


def resolve_timestamp(messages: DataFrame) -> DataFrame:
    """messages with ts_ns: the header's stamp (header_sec, header_nanosec), else the log time."""
    return messages.withColumn("ts_ns", F.coalesce(F.col("header_sec").cast("long") * 1_000_000_000 + F.coalesce("header_nanosec", F.lit(0)), "log_time_ns"))


def relative_time(messages: DataFrame, *, ts: str = "ts", seq: str = "seq", topic: str = "topic") -> DataFrame:
    """messages with rel: the time since the episode's origin, the least over its topics of the time that arrived first."""
    first = messages.groupBy("episode_index", topic).agg(F.min_by(ts, seq).alias("t")).groupBy("episode_index").agg(F.min("t").alias("origin"))
    return messages.join(first, "episode_index").withColumn("rel", F.col(ts) - F.col("origin")).drop("origin")


def lookahead_action(frames: DataFrame, observations: DataFrame, n: int, fps: float, *, by: str = "episode_index", ts: str = "ts", value: str = "value") -> DataFrame:
    """frames with the observation nearest to n frames later as action; at the end of an episode the last one repeats."""
    later = frames.withColumn("_ts", F.col(ts)).withColumn(ts, F.col(ts) + F.lit(n / fps).cast(frames.schema[ts].dataType))
    found = nearest_asof(later, observations, by=by, ts=ts, value=value)
    return found.withColumn(ts, F.col("_ts")).withColumnRenamed("nearest_value", "lookahead").drop("_ts", "nearest_ts")


def fill_action(frames: DataFrame, commands: DataFrame, *, tolerance: float, by: str = "episode_index", ts: str = "ts", value: str = "value", observation: str = "observation") -> DataFrame:
    """frames with filled and fill_kind: the nearest command within the tolerance (exact), else the last one before
    (hold_last), else the observation (fallback_to_observation), else nothing (dropped).

    One sort of both sides: nearest and last come from the same merged rows."""
    found = nearest_asof(frames, commands, by=by, ts=ts, value=value, last=True)
    near = F.when(F.abs(F.col(ts) - F.col("nearest_ts")) <= tolerance, F.col("nearest_value"))
    kind = F.when(near.isNotNull(), "exact").when(F.col("last_value").isNotNull(), "hold_last").when(F.col(observation).isNotNull(), "fallback_to_observation").otherwise("dropped")
    out = found.withColumn("fill_kind", kind).withColumn("filled", F.coalesce(near, "last_value", observation))
    return out.drop("nearest_ts", "nearest_value", "last_value")


FILL_KINDS = ("exact", "hold_last", "fallback_to_observation", "dropped")


def fill_stats(filled: DataFrame, by: list[str]) -> DataFrame:
    """Per group the frames of each fill_kind."""
    return filled.groupBy(*by).agg(*(F.count_if(F.col("fill_kind") == k).alias(k) for k in FILL_KINDS))


def complete_frames(frames: DataFrame, required: list[str]) -> DataFrame:
    """Frames in which no required stream is empty (null)."""
    return frames.dropna(subset=required)


def merge_arms(first: DataFrame, others: list[DataFrame], *, by: str = "episode_index", ts: str = "ts", value: str = "value", width: int | None = None) -> DataFrame:
    """first (by, ts, value array) with each other arm's nearest values behind its own, cut to width."""
    out = first
    for other in others:
        out = nearest_asof(out, other, by=by, ts=ts, value=value)
        out = out.withColumn(value, F.concat(value, F.coalesce("nearest_value", F.array().cast(first.schema[value].dataType)))).drop("nearest_ts", "nearest_value")
    return out if width is None else out.withColumn(value, F.slice(value, 1, width))
