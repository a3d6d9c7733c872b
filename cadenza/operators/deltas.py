"""Actions as differences, chunks of them, and limits on them. Vectors are arrays; excluded joints stay absolute."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.vectors import clip, minus, norm, plus
from cadenza.scan import BLOCK, Segments, overlapping
from cadenza.shared import fresh

#: Fixed value: the least deviation that statistics give.
LEAST_STD = 1e-6


def of_episode() -> Window:
    return Window.partitionBy("episode_index").orderBy("frame_index")


def mapped_minus(a: Column, reference: Column, state_of: Sequence[int | None] | None = None, excluded: Sequence[int] = ()) -> Column:
    """a minus the reference's value for each joint, by the map from action to state places; excluded joints as they are."""
    if state_of is None:
        keep = F.array(*map(F.lit, excluded)) if excluded else None
        return F.transform(F.arrays_zip(a.alias("a"), reference.alias("r")), lambda x, i: F.when(F.array_contains(keep, i), x["a"].cast("double")).otherwise(x["a"].cast("double") - x["r"].cast("double")) if excluded else x["a"].cast("double") - x["r"].cast("double"))
    at = lambda v, i: F.element_at(v, i + 1).cast("double")
    return F.array(*(at(a, i) if i in set(excluded) or s is None else at(a, i) - at(reference, s) for i, s in enumerate(state_of)))


def delta_obs_t(frames: DataFrame, *, state_of: Sequence[int | None] | None = None, excluded: Sequence[int] = (), stacked: bool = False) -> DataFrame:
    """frames with delta: the action minus the state, of stacked states the last."""
    state = F.element_at("state", -1) if stacked else F.col("state")
    return frames.withColumn("delta", mapped_minus(F.col("action"), state, state_of, excluded))


def delta_sequential(frames: DataFrame, *, chunk: str = "chunk_id", excluded: Sequence[int] = ()) -> DataFrame:
    """frames with delta: the action minus the one before it in its chunk, a chunk's first minus the state."""
    order = Window.partitionBy("episode_index", chunk).orderBy("frame_index")
    return frames.withColumn("delta", mapped_minus(F.col("action"), F.coalesce(F.lag("action").over(order), F.col("state")), None, excluded))


def delta_chunk(chunk: Column, state: Column) -> Column:
    """delta_sequential of a chunk held as an array of actions."""
    return F.transform(chunk, lambda a, k: minus(a, F.when(k == 0, state).otherwise(F.element_at(chunk, F.greatest(k, F.lit(1))))))


def restore_delta(frames: DataFrame, action_type: str, *, chunk: str = "chunk_id", excluded: Sequence[int] = (), width: int | None = None) -> DataFrame:
    """frames (delta, and state: the observation at the chunk's start) with restored: the state plus the delta, or plus the
    sum of the chunk's deltas so far. The joints' sums share one window over the chunk; width is the number of joints, which
    is looked up where it isn't given."""
    if action_type == "absolute":
        return frames.withColumn("restored", F.col("delta"))
    if action_type not in ("delta_obs_t", "delta_sequential"):
        raise ValueError(f"unknown action type {action_type}")
    order = Window.partitionBy("episode_index", chunk).orderBy("frame_index")
    state = F.first("state").over(order)
    if action_type == "delta_obs_t":
        whole = plus("delta", state)
        return frames.withColumn("restored", F.transform(F.arrays_zip(whole.alias("w"), F.col("delta").alias("d")), lambda x, i: F.when(i.isin(list(excluded)), x["d"].cast("double")).otherwise(x["w"])) if excluded else whole)
    width = width or frames.select(F.max(F.size("delta"))).first()[0] or 1
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = F.array(*(F.sum(F.get("delta", F.lit(j)).cast("double")).over(running) for j in range(width)))
    rows = frames.withColumns({"_state": state, "_sums": F.slice(sums, 1, F.size("delta"))})
    summed = F.zip_with("_state", "_sums", lambda s, x: s.cast("double") + x)
    own = F.transform("delta", lambda d, j: F.when(j.isin(list(excluded)), d.cast("double")).otherwise(F.get(summed, j))) if excluded else F.slice(summed, 1, F.size("delta"))
    return rows.withColumn("restored", own).drop("_state", "_sums")


def delta_action_stats(frames: DataFrame, *, n_steps: int = 1, state_of: Sequence[int | None] | None = None, excluded: Sequence[int] = ()) -> DataFrame:
    """(joint, count, mean, std, min, max) of action[t + k] - state[t] for k < n_steps within episodes, std at least 1e-6;
    excluded joints have the statistics of the absolute action."""
    order = of_episode()
    steps = [F.when(F.lead("action", k).over(order).isNotNull(), mapped_minus(F.lead("action", k).over(order), F.col("state"), state_of, ())) for k in range(max(1, n_steps))]
    rows = frames.select("episode_index", "action", F.array_compact(F.array(*steps)).alias("deltas"))
    deltas = rows.select(F.explode("deltas").alias("d")).select(F.posexplode("d").alias("joint", "x"))
    plain = rows.select(F.posexplode("action").alias("joint", "x")).select("joint", F.col("x").cast("double").alias("x"))
    if excluded:
        deltas = deltas.filter(~F.col("joint").isin(list(excluded))).union(plain.filter(F.col("joint").isin(list(excluded))))
    out = deltas.groupBy("joint").agg(F.count(F.lit(1)).alias("count"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    return out.withColumn("std", F.greatest("std", F.lit(LEAST_STD)))


def target_chunk(frames: DataFrame, size: int) -> DataFrame:
    """frames with chunk: this and the next actions, `size` of them; behind the episode's end the last one is repeated."""
    own = F.collect_list("action").over(of_episode().rowsBetween(0, size - 1))  # at most `size`
    rows = frames.withColumn("chunk", own)
    return rows.withColumn("chunk", F.concat("chunk", F.array_repeat(F.element_at("chunk", -1), F.lit(size) - F.size("chunk"))))


def relative_chunk(chunk: Column, reference: Column, mask: Sequence[bool]) -> Column:
    """The chunk's actions minus the reference in the masked joints."""
    keep = F.array(*map(F.lit, mask))
    return F.transform(chunk, lambda a: F.transform(F.arrays_zip(a.alias("a"), reference.alias("r"), keep.alias("m")), lambda x: x["a"].cast("double") - F.when(x["m"], x["r"].cast("double")).otherwise(0.0)))


def delta_command(frames: DataFrame, *, sequential: bool = True) -> DataFrame:
    """frames (command, state) with delta: the command minus the state, or minus the command before it, the first minus
    the state."""
    before = F.coalesce(F.lag("command").over(of_episode()), F.col("state")) if sequential else F.col("state")
    return frames.withColumn("delta", minus("command", before))


def limit_delta(action: Column, observed: Column, most: float | None) -> Column:
    """struct(limited, clamped): the observed position plus the action's difference from it cut to the limit, and the places
    of the joints that were cut. Without a limit or an observation of the same size: the action as it is."""
    plain = F.struct(F.transform(action, lambda x: x.cast("double")).alias("limited"), F.array().cast("array<int>").alias("clamped"))
    if most is None:
        return plain
    cut = F.zip_with(action, observed, lambda x, o: o.cast("double") + clip(x.cast("double") - o.cast("double"), -most, most))
    over = F.filter(F.transform(minus(action, observed), lambda d, i: F.when(F.abs(d) > most, i)), lambda i: i.isNotNull())
    return F.when(observed.isNotNull() & (F.size(observed) == F.size(action)), F.struct(cut.alias("limited"), over.alias("clamped"))).otherwise(plain)


def deadband(frames: DataFrame, threshold: float, value: str = "action") -> DataFrame:
    """(episode_index, frame_index, joint, published): per joint the value last published, until the command has moved from it
    by the threshold. Each value depends on what was published before, so an episode passes by in order, in one task, and
    one value a joint is held. A null or NaN command moves nothing."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, []
        for batch in batches:
            out = []
            for episode, command in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if episode != now:
                    now, last = episode, []
                command = command or []
                last += [None] * (len(command) - len(last))
                for j, x in enumerate(command):
                    if x is not None and (last[j] is None or abs(x - last[j]) >= threshold):
                        last[j] = x
                out.append(last[: len(command)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], names=["episode_index", "frame_index", "out"])

    rows = frames.select(F.col("episode_index").cast("long"), F.col("frame_index").cast("long"), F.col(value).cast("array<double>").alias("x"))
    rows = rows.repartition("episode_index").sortWithinPartitions("episode_index", "frame_index")
    return rows.mapInArrow(fold, "episode_index long, frame_index long, out array<double>").select("episode_index", "frame_index", F.posexplode("out").alias("joint", "published"))


def recent_stats(rows: DataFrame, keys: Sequence[str], window: int) -> DataFrame:
    """rows (step, step_change, step_count: the place) with their statistics over the last `window` rows of the keys. Places are
    cut into chunks of `window`: the last rows are the end of one chunk and the beginning of the next, each of which a frame
    that only grows adds up, so that a row costs the same however wide the window is, and nothing is subtracted."""
    part, ends, begins, place = (fresh(rows, c) for c in ("chunk", "ends", "begins", "place"))
    sums = lambda over: F.struct(*(a.over(over).alias(n) for n, a in {"n": F.count("step"), "sum": F.sum("step"), "var": F.var_pop("step"), "max": F.max("step"), "changes": F.count("step_change"), "change": F.sum("step_change"), "most": F.max("step_change")}.items()))
    within, ordered = Window.partitionBy(*keys, part), Window.partitionBy(*keys).orderBy(part, "frame_index")
    upto = lambda *by: within.orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(place, (F.col("step_count") - 1) % window).withColumn(part, F.floor((F.col("step_count") - 1) / window))
    rows = rows.withColumn(ends, sums(upto(F.desc("frame_index")))).withColumn(begins, sums(upto("frame_index")))
    # the last row of a chunk has all of it before itself
    rows = rows.withColumn(ends, F.when(F.col(place) < window - 1, F.lag(ends, window - 1).over(ordered)))
    x, y = (lambda c, f=f: F.coalesce(F.col(f"{f}.{c}"), F.lit(0)) for f in (ends, begins))
    n, changes = x("n") + y("n"), x("changes") + y("changes")
    apart = F.when((x("n") > 0) & (y("n") > 0), y("sum") / y("n") - x("sum") / x("n")).otherwise(0.0)
    stats = {
        "step_mean": (x("sum") + y("sum")) / n,
        "step_std": F.sqrt((x("n") * x("var") + y("n") * y("var") + apart * apart * (x("n") / n) * y("n")) / n),
        "step_max": F.greatest(f"{ends}.max", f"{begins}.max"),
        "change_mean": F.when(changes > 0, (x("change") + y("change")) / changes),
        "change_max": F.greatest(f"{ends}.most", f"{begins}.most"),
    }
    return rows.withColumns({c: F.when(n >= 2, a) for c, a in stats.items()}).drop(part, ends, begins, place)


def smoothness(frames: DataFrame, *, window: int = 100, value: str = "action", segmented: bool = False, block: int = BLOCK) -> DataFrame:
    """frames with step (distance from the frame before), and over the last `window` steps their mean, population deviation
    and maximum, the mean and maximum of step_change (the change of the step), nulls until there are two steps; step_count,
    the frames so far; with a column clamped (boolean) also clamped_pct so far. segmented: for episodes too long for one
    task, blocks of them that overlap by a window."""
    clamped = "clamped" in frames.columns
    if segmented:
        sums = {"step_count": ("sum", F.lit(1).cast("long"))} | ({"clamped_count": ("sum", F.coalesce(F.col("clamped"), F.lit(False)).cast("int"))} if clamped else {})
        rows = Segments(frames, "episode_index", F.col("frame_index")).running(**sums).rows
        rows = overlapping(rows, "step_count", window + 1, block=block)
        order = Window.partitionBy("episode_index", "block").orderBy("frame_index")
    else:
        order = of_episode()
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        rows = frames.withColumn("step_count", F.row_number().over(order).cast("long"))
        rows = rows.withColumn("clamped_count", F.sum(F.coalesce(F.col("clamped"), F.lit(False)).cast("int")).over(upto)) if clamped else rows
    rows = rows.withColumn("step", norm(minus(value, F.lag(value).over(order)))).withColumn("step_change", F.abs(F.col("step") - F.lag("step").over(order)))
    rows = recent_stats(rows, ["episode_index", "block"] if segmented else ["episode_index"], window)
    if segmented:
        rows = rows.filter("NOT ghost").drop("block", "ghost")
    return rows.withColumn("clamped_pct", 100 * F.col("clamped_count") / F.col("step_count")).drop("clamped_count") if clamped else rows


def synthesize_commands(frames: DataFrame, names: Sequence[str]) -> DataFrame:
    """frames (joints map<string, double>) with command: the joint state before, by names, 0 for a joint that it lacks; null
    for the first."""
    before = F.lag("joints").over(of_episode())
    return frames.withColumn("command", F.when(before.isNotNull(), F.array(*(F.coalesce(F.try_element_at(before, F.lit(n)), F.lit(0.0)) for n in names))))


def delta_ground_truth(frames: DataFrame, action_type: str, *, excluded: Sequence[int] = ()) -> DataFrame:
    """frames (truth, observed) with raw_truth, the truth as a model would give it: minus the observation, or minus the truth
    before it, the first minus the observation."""
    before = F.coalesce(F.lag("truth").over(of_episode()), F.col("observed")) if action_type == "delta_sequential" else F.col("observed")
    return frames.withColumn("raw_truth", mapped_minus(F.col("truth"), before, None, excluded))


def recorded_ground_truth(frames: DataFrame, action_type: str) -> DataFrame:
    """delta_ground_truth of a recording (predicted, truth, raw_output), whose observation is the prediction minus the raw
    output."""
    return delta_ground_truth(frames.withColumn("observed", minus("predicted", "raw_output")), action_type)
