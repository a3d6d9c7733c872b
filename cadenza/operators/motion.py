"""Motion trim: the frames of an episode in which something moves, and datasets cut to them.

Frames are rows (episode_index, frame_index from 0, action array); names are the action's joints.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.frames import reindex
from cadenza.operators.joints import joint_groups
from cadenza.scan import Segments
from cadenza.shared import stash

#: The start's usual offset from its event, by mode.
OFFSETS = {"motion": -10, "displacement": 0, "gripper": -15}


@dataclass(frozen=True)
class MotionTrimConfig:
    """The usual settings of a motion trim."""

    start_mode: str = "motion"
    baseline_frames: int = 15
    sustain_frames: int = 5
    arm_threshold: float = 0.02
    displacement_threshold: float = 0.10
    gripper_threshold: float = 0.01
    start_offset_frames: int | None = None
    end_arm_threshold: float = 0.02
    end_gripper_threshold: float = 0.005
    end_postroll_frames: int = 10
    min_frames: int = 30

    def __post_init__(self) -> None:
        if self.start_mode not in OFFSETS:
            raise ValueError(f"unknown start mode {self.start_mode}")
        if self.baseline_frames < 1 or self.sustain_frames < 1 or self.min_frames < 1:
            raise ValueError("frame counts must be positive")

    @property
    def offset(self) -> int:
        return OFFSETS[self.start_mode] if self.start_offset_frames is None else self.start_offset_frames


def edge_baseline(frames: DataFrame, k: int, vector: str = "action") -> DataFrame:
    """(episode_index, frames, initial, final): per joint the median of the first and of the last k frames, or of all if
    there are fewer. Only these frames are exploded."""
    size = frames.groupBy("episode_index").agg((F.max("frame_index") + 1).alias("frames"))
    edge = frames.select("episode_index", "frame_index", vector).join(size, "episode_index")
    first, last = F.col("frame_index") < k, F.col("frame_index") >= F.col("frames") - k
    edge = edge.filter(first | last).select("episode_index", "frames", first.alias("is_first"), last.alias("is_last"), F.posexplode(vector).alias("joint", "x"))
    median = lambda c: F.percentile(F.when(F.col(c), F.col("x").cast("double")), 0.5)
    joints = edge.groupBy("episode_index", "frames", "joint").agg(median("is_first").alias("i"), median("is_last").alias("f"))
    out = joints.groupBy("episode_index", "frames").agg(F.array_sort(F.collect_list(F.struct("joint", "i", "f"))).alias("s"))  # one entry a joint
    return out.select("episode_index", "frames", F.transform("s", lambda s: s["i"]).alias("initial"), F.transform("s", lambda s: s["f"]).alias("final"))


def farthest(v: Column, base: Column, joints: Sequence[int]) -> Column:
    """The largest distance of the given joints from their base."""
    at = lambda a, j: F.element_at(a, j + 1).cast("double")
    far = [F.abs(at(v, j) - at(base, j)) for j in joints]
    return F.greatest(*far) if len(far) > 1 else far[0]


def detect_motion_window(frames: DataFrame, names: Sequence[str], config: MotionTrimConfig = MotionTrimConfig(), *, segmented: bool = False) -> DataFrame:  # noqa: B008
    """(episode_index, frames, start, end, start_event, final_settle_event, start_event_found, final_settle_found).

    Start: the first frame of the first sustained departure from the initial position, moved by the offset; 0 if there
    is none. End, exclusive: behind the last sustained frame away from the final position, plus the postroll; the last
    frame if there is none. A window shorter than min_frames grows at its end, then at its start. segmented: for
    episodes too long for one task.
    """
    arm, gripper = joint_groups(names)
    if config.start_mode == "gripper" and not gripper:
        raise ValueError("mode gripper needs a gripper joint")
    rows = frames.select("episode_index", "frame_index", "action").join(edge_baseline(frames, config.baseline_frames), "episode_index")
    a = F.col("action")
    departed = {
        "motion": lambda: farthest(a, F.col("initial"), arm) > config.arm_threshold,
        "displacement": lambda: farthest(a, F.col("initial"), arm) > config.displacement_threshold,
        "gripper": lambda: farthest(a, F.col("initial"), gripper) > config.gripper_threshold,
    }[config.start_mode]()
    unsettled = farthest(a, F.col("final"), arm) > config.end_arm_threshold
    if gripper:
        unsettled |= farthest(a, F.col("final"), gripper) > config.end_gripper_threshold
    rows = rows.select("episode_index", "frame_index", "frames", departed.alias("departed"), unsettled.alias("unsettled"))
    outside = {f"{c}_gap": F.when(~F.col(c), F.col("frame_index")) for c in ("departed", "unsettled")}
    if segmented:
        rows = Segments(rows, "episode_index", F.col("frame_index")).running(**{c: ("max", v) for c, v in outside.items()}).rows
    else:
        upto = Window.partitionBy("episode_index").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumns({c: F.max(v).over(upto) for c, v in outside.items()})
    for c in ("departed", "unsettled"):  # how long the run is that a frame ends, by the last frame that isn't in one
        rows = rows.withColumn(f"{c}_run", F.when(F.col(c), F.col("frame_index") - F.coalesce(f"{c}_gap", F.lit(-1))))
    k = config.sustain_frames
    found = rows.groupBy("episode_index", "frames").agg(
        F.min(F.when(F.col("departed_run") == k, F.col("frame_index") - k + 1)).alias("first"), F.max(F.when(F.col("unsettled_run") >= k, F.col("frame_index") + 1)).alias("last")
    )
    n = F.col("frames")
    event, settle = F.coalesce("first", F.lit(0)), F.coalesce("last", n)
    start = F.least(F.greatest(event + config.offset, F.lit(0)), n - 1)
    end = F.least(n, settle + config.end_postroll_frames)
    found = found.withColumns({"start_event": event, "final_settle_event": settle, "start": start, "end": end})
    found = found.withColumn("end", F.when(F.col("end") - F.col("start") < config.min_frames, F.least(n, F.col("start") + config.min_frames)).otherwise(F.col("end")))
    found = found.withColumn("start", F.when(F.col("end") - F.col("start") < config.min_frames, F.greatest(F.lit(0), F.col("end") - config.min_frames)).otherwise(F.col("start")))
    return found.select("episode_index", "frames", "start", "end", "start_event", "final_settle_event", F.col("first").isNotNull().alias("start_event_found"), F.col("last").isNotNull().alias("final_settle_found"))


def apply_overrides(windows: DataFrame, overrides: DataFrame) -> DataFrame:
    """windows with start and end replaced where overrides (episode_index, start, end) give them, and manual_override.
    A window that isn't 0 <= start < end <= frames is an error when it is read."""
    other = overrides.select("episode_index", F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.lit(True).alias("manual_override"))
    rows = windows.join(other, "episode_index", "left").withColumn("manual_override", F.coalesce("manual_override", F.lit(False)))
    rows = rows.withColumn("start", F.coalesce("o_start", "start")).withColumn("end", F.coalesce("o_end", "end")).drop("o_start", "o_end")
    fine = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("frames"))
    return rows.withColumn("start", F.when(F.assert_true(fine, "a window lies outside its episode").isNull(), F.col("start")))


def build_trim_plan(frames: DataFrame, names: Sequence[str], config: MotionTrimConfig = MotionTrimConfig(), overrides: DataFrame | None = None, tasks: DataFrame | None = None) -> DataFrame:  # noqa: B008
    """One row per episode: its window, kept_frames, removed_start_frames, removed_end_frames, and state, action and task at
    the window's start. frames: with state and task_index; tasks: (task_index, task)."""
    windows = detect_motion_window(frames, names, config)
    none = frames.sparkSession.createDataFrame([], "episode_index long, start long, end long")
    plan = apply_overrides(windows, none if overrides is None else overrides)
    plan = plan.withColumns({"kept_frames": F.col("end") - F.col("start"), "removed_start_frames": F.col("start"), "removed_end_frames": F.col("frames") - F.col("end")})
    at_start = frames.select("episode_index", F.col("frame_index").alias("start"), F.col("state").alias("start_state"), F.col("action").alias("start_action"), *(["task_index"] if "task_index" in frames.columns else []))
    plan = plan.join(at_start, ["episode_index", "start"])
    return plan if tasks is None else plan.join(tasks, "task_index", "left").withColumn("task", F.coalesce("task", F.col("task_index").cast("string")))


def apply_trim(frames: DataFrame, plan: DataFrame, *, fps: float = 30.0) -> DataFrame:
    """frames within their plan's window (episode_index, start, end), renumbered; episodes without a plan go."""
    window = plan.select("episode_index", "start", "end")
    rows = frames.join(window, "episode_index").filter((F.col("frame_index") >= F.col("start")) & (F.col("frame_index") < F.col("end")))
    rows = rows.withColumn("source_frame_index", F.col("frame_index")).drop("start", "end", "index", "timestamp", "frame_index")
    return reindex(rows, ["source_frame_index"], fps)


def trim_summary(plan: DataFrame, names: Sequence[str], config: MotionTrimConfig = MotionTrimConfig(), *, fps: float = 30.0) -> DataFrame:  # noqa: B008
    """One row: frames in, out and removed, seconds removed, the episode whose arm starts nearest to the median start (the
    first of equals), the population deviation of each arm joint's start, and whether a start must be staged."""
    arm, _ = joint_groups(names)
    plan = stash(plan.select("episode_index", "frames", "kept_frames", "start_state"), "plan")  # read four times
    starts = plan.select("episode_index", *(F.element_at("start_state", j + 1).cast("double").alias(f"j{j}") for j in arm))
    centre = starts.agg(F.array(*(F.percentile(f"j{j}", 0.5) for j in arm)).alias("m")).scalar()
    starts = starts.withColumn("m", centre)
    far = sum(((F.col(f"j{j}") - F.col("m")[k]) ** 2 for k, j in enumerate(arm)), F.lit(0.0))
    medoid = starts.agg(F.min_by("episode_index", F.struct(F.sqrt(far), "episode_index")).alias("representative_start_episode"))
    spread = starts.agg(F.array(*(F.stddev_pop(f"j{j}") for j in arm)).alias("arm_start_std"))
    sums = plan.agg(F.sum("frames").alias("input_frames"), F.sum("kept_frames").alias("output_frames"))
    sums = sums.withColumn("removed_frames", F.col("input_frames") - F.col("output_frames")).withColumn("removed_seconds", F.col("removed_frames") / F.lit(float(fps)))
    staged = config.start_mode != "motion" or config.offset > 0
    return sums.withColumn("representative_start_episode", medoid.scalar()).withColumn("arm_start_std", spread.scalar()).withColumn("requires_staged_start", F.lit(staged))


def reference_preroll(plan: DataFrame) -> int:
    """Frames before the event: the median of the events that were found, half rounded up. None found: an error."""
    median = plan.filter("start_event_found").agg(F.percentile("start_event", 0.5)).first()[0]
    if median is None:
        raise ValueError("no start event was found")
    return int((median + 0.5) // 1)
