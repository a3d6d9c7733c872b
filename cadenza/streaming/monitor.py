"""Streaming operators. Inputs are streaming DataFrames with an event time column `ts`; late rows are dropped behind the
watermark. Windows and sessions are Spark's own and work on static tables, too; what needs order within a key (nearest
match, latest values, gaps, smoothness, throttling) are the processors of `ordered`. Their state ends when a key has been
silent for `idle` seconds, and they need `ordered.state_store(spark)`."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.streaming import ordered

EPISODE = {"episode_index": "long"}


def window_rates(messages: DataFrame, *, seconds: int = 10, watermark: str = "10 seconds", expected: dict[str, float] | None = None) -> DataFrame:
    """(window, start, episode_index, topic, messages, fps, slow): the rate in each window; slow if it is below two thirds of the
    topic's expected one."""
    out = messages.withWatermark("ts", watermark).groupBy(F.window("ts", f"{seconds} seconds").alias("w"), "episode_index", "topic").agg(F.count(F.lit(1)).alias("messages"))
    rate = F.col("messages") / seconds
    due = F.coalesce(*(F.when(F.col("topic") == t, F.lit(float(f))) for t, f in (expected or {}).items()), F.lit(None).cast("double"))
    return out.select(F.col("w").alias("window"), F.col("w.start").alias("start"), "episode_index", "topic", "messages", rate.alias("fps"), F.coalesce(rate < due * 2 / 3, F.lit(False)).alias("slow"))


def episode_ends(messages: DataFrame, *, truth_gap: float = 1.0, grace: float = 1.5, watermark: str = "5 seconds") -> DataFrame:
    """(episode_index, start, end, messages): an episode ends when its truth has been silent for truth_gap and its
    predictions for truth_gap + grace. Messages: (episode_index, side, ts)."""
    gap = F.when(F.col("side") == "truth", f"{truth_gap} seconds").otherwise(f"{truth_gap + grace} seconds")
    return (
        messages.withWatermark("ts", watermark).groupBy(F.session_window("ts", gap).alias("w"), "episode_index").agg(F.count(F.lit(1)).alias("messages"))
        .select("episode_index", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "messages")
    )


def bottlenecks(messages: DataFrame, expected: dict[str, float], *, seconds: int = 10, watermark: str = "10 seconds") -> DataFrame:
    """(start, episode_index, slow_cameras, bottleneck, fps): of each window in which an episode has messages of any of the
    expected topics, how many of them are below two thirds of their expected rate, and the slowest of these; one without
    messages has rate 0. Nulls where none is slow. Equal rates go by name."""
    rates = window_rates(messages, seconds=seconds, watermark=watermark, expected=expected)
    # other topics are left out here, not before: they move the watermark, too
    seen = F.collect_list(F.when(F.col("topic").isin(*expected), F.struct("fps", "topic", "slow")))
    per_window = rates.groupBy("window", "episode_index").agg(seen.alias("seen")).filter(F.size("seen") > 0)
    silent = F.filter(F.array(*map(F.lit, sorted(expected))), lambda t: ~F.array_contains(F.transform("seen", lambda s: s["topic"]), t))
    slow = F.concat(F.transform(silent, lambda t: F.struct(F.lit(0.0).alias("fps"), t.alias("topic"))), F.transform(F.filter("seen", lambda s: s["slow"]), lambda s: F.struct(s["fps"].alias("fps"), s["topic"].alias("topic"))))
    worst = F.array_min("slow")
    return per_window.withColumn("slow", slow).select(F.col("window.start").alias("start"), "episode_index", F.size("slow").alias("slow_cameras"), worst["topic"].alias("bottleneck"), worst["fps"].alias("fps"))


def throttled(frames: DataFrame, *, every: float = 1.0, most: int | None = None, payload: str | None = None, idle: float = 60.0, watermark: str = "5 seconds") -> DataFrame:
    """(episode_index, camera, ts, payload): frames that come `every` seconds or more after the last one kept, `most` of each
    camera of an episode at most. payload: a string column that goes with them."""
    keys = EPISODE | {"camera": "string"}
    side = F.lit("") if payload is None else F.col(payload).cast("string")
    found = ordered.processed(frames, ordered.Throttle([*keys, "at", "payload"], idle, every, most), keys, "at long, payload string", side=side, value=F.array().cast("array<double>"), watermark=watermark)
    found = found.select(*keys, F.timestamp_micros("at").alias("ts"), "payload")
    return found if payload else found.drop("payload")


def gap_alerts(messages: DataFrame, *, least: float = 0.5, factor: float = 5.0, idle: float = 60.0, watermark: str = "5 seconds") -> DataFrame:
    """(episode_index, topic, kind, start, end, gap): kind 'silent' as soon as the watermark tells that a topic has been silent
    for longer than the larger of `least` and `factor` times the median interval so far, whether it speaks again or not;
    kind 'gap' when it does, with the whole gap. messages: (episode_index, topic, ts)."""
    keys = EPISODE | {"topic": "string"}
    processor = ordered.Gaps([*keys, "kind", "start", "end", "gap"], idle, least, factor)
    found = ordered.processed(messages, processor, keys, "kind string, start long, end long, gap double", side=F.lit(""), value=F.array().cast("array<double>"), watermark=watermark)
    return found.select(*keys, "kind", F.timestamp_micros("start").alias("start"), F.timestamp_micros("end").alias("end"), "gap")


def latest_sync(messages: DataFrame, *, sides: tuple[str, ...] = ("obs", "raw", "cmd"), idle: float = 60.0, watermark: str = "5 seconds", keep_first: bool = True) -> DataFrame:
    """(episode_index, ts, one column a side): a row whenever all sides have a value; it takes the latest of each, which
    are used up by it, but for the first side's with keep_first. messages: (episode_index, side, ts, value), values numbers
    or vectors; a null or NaN takes a side's value away."""
    single = messages.schema["value"].dataType.typeName() != "array"
    processor = ordered.Latest(["episode_index", "at", *sides], idle, sides, keep_first)
    columns = ", ".join(["at long", *(f"`{s}` array<double>" for s in sides)])
    found = ordered.processed(messages, processor, EPISODE, columns, side=F.col("side"), value=ordered.vector(messages, "value"), watermark=watermark)
    return found.select("episode_index", F.timestamp_micros("at").alias("ts"), *((F.get(F.col(f"`{s}`"), F.lit(0)) if single else F.col(f"`{s}`")).alias(s) for s in sides))


def fresh_sets(messages: DataFrame, sensors: tuple[str, ...], *, idle: float = 60.0, watermark: str = "5 seconds") -> DataFrame:
    """(episode_index, ts): the times at which every required sensor has a newer message than at the time before."""
    some = messages.select("episode_index", F.when(F.col("topic").isin(*sensors), F.col("topic")).alias("side"), "ts", F.lit(1.0).alias("value"))
    return latest_sync(some, sides=sensors, idle=idle, watermark=watermark, keep_first=False).select("episode_index", "ts")


def nearest_match(messages: DataFrame, *, tolerance: float = 2.5, idle: float = 60.0, watermark: str = "5 seconds") -> DataFrame:
    """(episode_index, ts, value, nearest): for each message of side 'frame' the value of side 'sample' nearest in time within
    the tolerance (seconds), the earlier of two, null if there is none. messages: (episode_index, side, ts, value)."""
    processor = ordered.Nearest(["episode_index", "at", "value", "nearest"], idle, tolerance)
    found = ordered.processed(messages, processor, EPISODE, "at long, value double, nearest double", side=F.col("side"), value=ordered.vector(messages, "value"), watermark=watermark)
    return found.select("episode_index", F.timestamp_micros("at").alias("ts"), "value", F.nanvl("nearest", F.lit(None).cast("double")).alias("nearest"))


SMOOTHNESS = ["step_mean double", "step_std double", "step_max double", "change_mean double", "change_max double", "step_count long", "clamped_pct double"]


def rolling_smoothness(actions: DataFrame, *, window: int = 100, idle: float = 60.0, watermark: str = "5 seconds") -> DataFrame:
    """(episode_index, ts, step_mean, step_std, step_max, change_mean, change_max, step_count, clamped_pct): over the last
    `window` steps of each episode's actions (episode_index, ts, value: a number or vector; clamped: boolean, if there is
    one), from the second step on; the batch twin is deltas.smoothness."""
    names = [c.split()[0] for c in SMOOTHNESS]
    processor = ordered.Smoothness(["episode_index", "at", *names], idle, window)
    side = F.when(F.col("clamped"), "clamped").otherwise("") if "clamped" in actions.columns else F.lit("")
    found = ordered.processed(actions, processor, EPISODE, ", ".join(["at long", *SMOOTHNESS]), side=side, value=ordered.vector(actions, "value"), watermark=watermark)
    return found.select("episode_index", F.timestamp_micros("at").alias("ts"), *names)


def convert_new(messages: DataFrame, path: str, checkpoint: str, convert: Any) -> Any:
    """Starts a query that converts each micro-batch of new recordings and appends the result under path, once; the
    checkpoint remembers what was read, and a batch that is run again replaces its own folder."""

    def batch(df: DataFrame, number: int) -> None:
        convert(df).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return messages.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
