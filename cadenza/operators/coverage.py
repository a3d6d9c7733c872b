"""Recording quality: what each topic of an episode has, where it has gaps, and what other episodes lead one to expect.

Messages are rows (episode_index, topic, role, ts in seconds); role is stream, action or unclassified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.shared import ranked

TOPIC = ["episode_index", "topic", "role"]
SEVERITIES = ("pass", "warning", "critical")
#: Message types by role, the arms by the side letter of a command topic, and usual frame rates.
STREAM_TYPES = ("sensor_msgs/JointState", "sensor_msgs/CompressedImage", "sensor_msgs/Image")
ACTION_TYPE = "std_msgs/Float64MultiArray"
ARMS = {"l": "left", "r": "right"}
USUAL_RATES = (15, 20, 24, 25, 30, 50, 60)


def classify_topic(topics: DataFrame) -> DataFrame:
    """topics (topic, schema_name) with role, label and message_type, by the type alone: joint states and images are
    streams, float arrays actions, anything else is unclassified."""
    kind = F.replace(F.replace("schema_name", F.lit("ros2msg://"), F.lit("")), F.lit("/msg/"), F.lit("/"))
    plain = F.replace(F.regexp_replace("topic", "^/+", ""), F.lit("/"), F.lit("_"))
    camera = F.regexp_extract("topic", r"^/cam_([^/]+)/image_raw", 1)
    side = F.regexp_extract("topic", r"^/follower_([lr])_.*controller/commands$", 1)
    arm = F.element_at(F.create_map(*(F.lit(x) for kv in ARMS.items() for x in kv)), side)
    role = F.when(kind.isin(*STREAM_TYPES), "stream").when(kind == ACTION_TYPE, "action").otherwise("unclassified")
    label = F.when(kind == STREAM_TYPES[0], "joint_states").when(kind.isin(*STREAM_TYPES[1:]), F.when(camera != "", camera).otherwise(plain))
    label = label.when(kind == ACTION_TYPE, F.concat(F.lit("action["), F.coalesce(F.when(side != "", arm), plain), F.lit("]"))).otherwise(plain)
    return topics.withColumns({"role": role, "label": label, "message_type": kind})


def topic_inventory(messages: DataFrame, declared: DataFrame | None = None) -> DataFrame:
    """Messages of each topic of an episode, with the first and last time and, if messages have schema_name, the first
    one given. declared (episode_index, topic, role): topics that stay with a count of 0 if they are silent."""
    more = [F.min_by("schema_name", F.when(F.col("schema_name").isNotNull(), F.col("ts"))).alias("schema_name")] if "schema_name" in messages.columns else []
    own = messages.groupBy(*TOPIC).agg(F.count(F.lit(1)).alias("message_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), *more)
    if declared is None:
        return own
    return own.join(declared.select(*TOPIC).distinct(), TOPIC, "full").withColumn("message_count", F.coalesce("message_count", F.lit(0)))


def estimate_fps(inventory: DataFrame, *, whole_file: bool = False) -> DataFrame:
    """inventory with fps: (count - 1) / (last - first), null for fewer than two messages or no time between them.
    whole_file: the times are those of the episode's file, not of the topic."""
    of_file = Window.partitionBy("episode_index")
    first, last = (F.min("first_ts").over(of_file), F.max("last_ts").over(of_file)) if whole_file else (F.col("first_ts"), F.col("last_ts"))
    span = last - first
    return inventory.withColumn("fps", F.when((F.col("message_count") >= 2) & (span > 0), (F.col("message_count") - 1) / span))


def recording_duration(messages: DataFrame) -> DataFrame:
    """(episode_index, message_count, duration): seconds between the first and the last message, 0 below two of them."""
    out = messages.groupBy("episode_index").agg(F.count(F.lit(1)).alias("message_count"), (F.max("ts") - F.min("ts")).alias("duration"))
    return out.withColumn("duration", F.when(F.col("message_count") < 2, 0.0).otherwise(F.col("duration")))


def time_drift(messages: DataFrame) -> DataFrame:
    """(episode_index, drift): between the newest messages of an episode's topics; null with one topic."""
    newest = messages.groupBy("episode_index", "topic").agg(F.max("ts").alias("newest"))
    return newest.groupBy("episode_index").agg(F.when(F.count(F.lit(1)) > 1, F.max("newest") - F.min("newest")).alias("drift"))


def session_bounds(messages: DataFrame) -> DataFrame:
    """First and last time of an episode over its streams and actions."""
    return messages.filter(F.col("role").isin("stream", "action")).groupBy("episode_index").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))


def topic_coverage(
    messages: DataFrame, declared: DataFrame | None = None, *, gap_factor: float = 5.0, min_gap_s: float = 0.5, action_gap_s: float = 1.0, action_from_observation: bool = False
) -> DataFrame:
    """Rate, gaps, coverage, severity and reason of each topic of an episode.

    A stream's gap is longer than the larger of min_gap_s and gap_factor median intervals, at its ends too; any makes it
    critical, as do one message or none. An action that idles for longer than action_gap_s, or is silent though declared,
    is a warning; silence passes with action_from_observation. gaps are sorted by their start, in seconds of the session.
    """
    whole = Window.partitionBy(*TOPIC)
    steps = messages.select(*TOPIC, "ts").withColumn("dt", F.col("ts") - F.lag("ts").over(whole.orderBy("ts")))
    median = F.coalesce(F.percentile("dt", 0.5).over(whole), F.lit(0.0))
    limit = F.when(F.col("role") == "stream", F.greatest(F.lit(min_gap_s), gap_factor * median)).otherwise(action_gap_s)
    steps = steps.withColumn("gap_limit", limit)
    wide = (F.col("dt") > F.col("gap_limit")) & (F.col("role") != "unclassified")
    kind = F.when(F.col("role") == "stream", "dropframe").otherwise("idle")
    own = steps.groupBy(*TOPIC).agg(
        F.count(F.lit(1)).alias("message_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.first("gap_limit").alias("gap_limit"),
        F.collect_list(F.when(wide, F.struct((F.col("ts") - F.col("dt")).alias("from_ts"), F.col("ts").alias("to_ts"), F.col("dt").alias("duration_s"), kind.alias("kind")))).alias("inner"),
    )
    if declared is not None:
        own = own.join(declared.select(*TOPIC).distinct(), TOPIC, "full").withColumn("message_count", F.coalesce("message_count", F.lit(0)))
    rows = own.join(session_bounds(messages), "episode_index", "left")
    stream, action, n = F.col("role") == "stream", F.col("role") == "action", F.col("message_count")
    gap = lambda a, b, k: F.struct((a - F.col("start_ts")).alias("start_s"), (b - F.col("start_ts")).alias("end_s"), (b - a).alias("duration_s"), F.lit(k).alias("kind") if isinstance(k, str) else k.alias("kind"))
    at_end = lambda a, b, k: F.when(stream & (n > 1) & (b - a > F.col("gap_limit")), gap(a, b, k))
    inner = F.transform(F.coalesce("inner", F.array()), lambda g: F.struct((g["from_ts"] - F.col("start_ts")).alias("start_s"), (g["to_ts"] - F.col("start_ts")).alias("end_s"), g["duration_s"].alias("duration_s"), g["kind"].alias("kind")))
    ends = F.array(at_end(F.col("start_ts"), F.col("first_ts"), "leading"), at_end(F.col("last_ts"), F.col("end_ts"), "trailing"))
    rows = rows.withColumn("gaps", F.array_sort(F.array_compact(F.concat(inner, ends))))
    rows = rows.withColumn("span", F.greatest(F.coalesce(F.col("end_ts") - F.col("start_ts"), F.lit(0.0)), F.lit(1e-9)))
    none = (stream & (n < 2)) | (action & (n == 0))
    total = F.when(none, F.col("span")).otherwise(F.aggregate("gaps", F.lit(0.0), lambda s, g: s + g["duration_s"]))
    longest = F.when(none, F.col("span")).otherwise(F.coalesce(F.array_max(F.transform("gaps", lambda g: g["duration_s"])), F.lit(0.0)))
    rows = rows.withColumns({"total_gap": total, "longest_gap": longest})
    some = F.size("gaps") > 0
    severity = F.when(stream & ((n < 2) | some), "critical").when(action & (n == 0), "pass" if action_from_observation else "warning").when(action & some, "warning").otherwise("pass")
    reason = F.when(n == 0, "no messages").when(stream & (n == 1), "one message").when(some, F.format_string("%d gaps, longest %.2f s", F.size("gaps"), "longest_gap")).otherwise("PASS")
    length = F.col("last_ts") - F.col("first_ts")
    return rows.select(
        *TOPIC, "message_count", F.when(~action, (n - 1) / F.when(length > 0, length)).alias("avg_fps"),
        "total_gap", "longest_gap", F.greatest(F.lit(0.0), 1 - F.col("total_gap") / F.col("span")).alias("coverage"), severity.alias("severity"), reason.alias("reason"), "gaps",
    )


def longest_gap(topics: DataFrame) -> DataFrame:
    """topics with longest (start_s, end_s, duration_s, kind): the longest of gaps, of equal ones the earliest."""
    better = lambda best, g: F.when(best.isNull() | (g["duration_s"] > best["duration_s"]), g).otherwise(best)
    none = F.lit(None).cast(topics.schema["gaps"].dataType.elementType)
    return topics.withColumn("longest", F.aggregate("gaps", none, better))


def worst_severity(rows: DataFrame) -> DataFrame:
    """The worst severity of an episode, and whether it passes."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    worst = rows.groupBy("episode_index").agg(F.max(rank).cast("int").alias("rank"))
    return worst.select("episode_index", F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col("rank")).alias("severity"), (F.col("rank") < 3).alias("passed"))


def others_median(rates: DataFrame) -> DataFrame:
    """rates (episode_index, topic, avg_fps), without nulls, with the median of the topic's other episodes. Of a topic's
    sorted rates only the two to three in the middle matter, whichever row is left out; topics are ranked in range
    partitions, so that no task sorts all episodes of a topic."""
    own = ranked(rates.filter("avg_fps IS NOT NULL").select("episode_index", "topic", "avg_fps"), "i", F.col("avg_fps"), F.col("episode_index"), within="topic")
    sizes = own.groupBy("topic").agg(F.max("i").alias("n"))
    own = own.join(sizes, "topic")
    half = F.floor(F.col("n") / 2)
    at = lambda k: F.max(F.when(F.col("i") == half + k, F.col("avg_fps"))).alias(f"v{k}")
    middle = own.filter(F.col("i").between(half, half + 2)).groupBy("topic").agg(at(0), at(1), at(2))
    rows = own.join(middle, "topic")
    low = F.when(F.col("i") > half, F.col("v0")).otherwise(F.col("v1"))  # of the others, the floor(n/2)-th
    high = F.when(F.col("i") > half + 1, F.col("v1")).otherwise(F.col("v2"))  # and the next
    median = F.when(F.col("n") < 2, None).when(F.col("n") % 2 == 0, low).otherwise((low + high) / 2)
    return rows.select("episode_index", "topic", "avg_fps", median.alias("others_fps"))


def fps_degradation(topics: DataFrame, *, tolerance: float = 0.15) -> DataFrame:
    """topics (episode_index, topic, role, avg_fps, severity, ...) with others_fps, degraded and the severity after it: a
    stream whose rate falls short of the other episodes' median by more than the tolerance turns from pass to warning."""
    found = others_median(topics.filter("role = 'stream'")).select("episode_index", "topic", "others_fps")
    rows = topics.join(found, ["episode_index", "topic"], "left")
    degraded = F.coalesce((F.col("role") == "stream") & (F.col("avg_fps") < (1 - tolerance) * F.col("others_fps")), F.lit(False))
    rows = rows.withColumn("degraded", degraded)
    return rows.withColumn("severity", F.when(F.col("degraded") & (F.col("severity") == "pass"), "warning").otherwise(F.col("severity")))


def missing_expected(topics: DataFrame) -> DataFrame:
    """(episode_index, topic, role, present_in, episodes, severity, reason): a critical row for each stream or action that
    a strict majority of the episodes in topics (episode_index, topic, role) has and this one hasn't. None for one episode.

    The expected topics, as many as are configured on a robot, are one array."""
    present = topics.select(*TOPIC).distinct()
    episodes = present.select("episode_index").distinct()
    n = episodes.agg(F.count(F.lit(1))).scalar()
    usual = present.filter(F.col("role").isin("stream", "action")).groupBy("topic", "role").agg(F.count(F.lit(1)).alias("present_in")).withColumn("episodes", n)
    usual = usual.filter("episodes > 1 AND present_in >= floor(episodes / 2) + 1 AND present_in < episodes")
    lists = usual.agg(F.collect_list(F.struct("topic", "role", "present_in", "episodes"))).scalar()
    rows = episodes.withColumn("u", F.explode(lists)).select("episode_index", "u.*")
    reason = F.format_string("topic completely absent (present in %d/%d sibling episodes)", "present_in", "episodes")
    return rows.join(present, TOPIC, "left_anti").select(*TOPIC, "present_in", "episodes", F.lit("critical").alias("severity"), reason.alias("reason"))


def snap_fps(rate: Column, tolerance: float = 0.15) -> Column:
    """The first usual rate within the tolerance, else the nearest multiple of five, at least five."""
    near = F.coalesce(*(F.when(F.abs(rate - r) / r <= tolerance, F.lit(r)) for r in USUAL_RATES))
    return F.coalesce(near, F.greatest(F.lit(5), 5 * F.bround(rate / 5, 0).cast("int")))


def session_fps(episodes: DataFrame, output_fps: int | None = None) -> DataFrame:
    """(fps, allowed): the snapped least fps of the episodes (fps), and whether output_fps doesn't exceed it."""
    out = episodes.agg(F.min("fps").alias("least")).select(snap_fps(F.col("least")).alias("fps"))
    return out.withColumn("allowed", F.lit(True) if output_fps is None else F.lit(output_fps) <= F.col("fps"))


def missing_topics(topics: DataFrame, configured: DataFrame) -> DataFrame:
    """(episode_index, topic, has_commands): configured topics (topic) that an episode's inventory lacks, and whether the
    episode has any command topic. configured is as short as a robot's list of topics."""
    of_episode = topics.groupBy("episode_index").agg(F.bool_or(F.endswith("topic", F.lit("/commands"))).alias("has_commands"))
    wanted = configured.agg(F.collect_set("topic")).scalar()
    rows = of_episode.withColumn("topic", F.explode(wanted))
    return rows.join(topics.select("episode_index", "topic"), ["episode_index", "topic"], "left_anti").select("episode_index", "topic", "has_commands")
