"""Reports on a session, from topics: rows (episode_index, topic, label, role, severity, reason, avg_fps)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The order of roles in a report, and names that a list shows before it is cut.
ROLES = ("stream", "action", "unclassified")
SHOWN = 20


def role_rank(role: Column) -> Column:
    position = F.array_position(F.array(*map(F.lit, ROLES)), role)
    return F.when(position > 0, position).otherwise(99)


def report_order(topics: DataFrame) -> DataFrame:
    """(label, role) of all topics: streams, then actions, then the rest, each by label."""
    labels = topics.groupBy("label").agg(F.min_by("role", F.struct(role_rank(F.col("role")), "role")).alias("role"))
    return labels.orderBy(role_rank(F.col("role")), "label")


def topic_health(topics: DataFrame) -> DataFrame:
    """Per label the topics that pass, warn and fail, and the least, median and greatest rate."""
    count = lambda s: F.count_if(F.col("severity") == s)
    rate = F.col("avg_fps")
    return topics.groupBy("label").agg(
        count("pass").alias("n_pass"), count("warning").alias("n_warning"), count("critical").alias("n_critical"), F.min(rate).alias("min_fps"), F.percentile(rate, 0.5).alias("median_fps"), F.max(rate).alias("max_fps")
    )


def flagged_topics(topics: DataFrame, *, shown: int = SHOWN) -> DataFrame:
    """Per label and severity other than pass: in how many of the episodes, the first `shown` of these, and the first
    one's reason; critical ones first."""
    total = topics.agg(F.count_distinct("episode_index")).scalar()
    each = topics.filter("severity <> 'pass'").groupBy("label", "severity", "episode_index").agg(F.min_by("reason", "topic").alias("reason"))
    order = Window.partitionBy("label", "severity").orderBy("episode_index")
    first = each.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= shown)
    first = first.groupBy("label", "severity").agg(F.array_sort(F.collect_list("episode_index")).alias("shown"), F.min_by("reason", "episode_index").alias("reason"))
    counts = each.groupBy("label", "severity").agg(F.count(F.lit(1)).alias("episodes"))
    out = counts.join(first, ["label", "severity"]).withColumn("of_episodes", total)
    return out.orderBy("severity", "label")  # critical comes before warning


def session_verdict(episodes: DataFrame) -> DataFrame:
    """One row from episodes (severity, and null or a read_error): counts, and not-ready if any is critical or unreadable,
    ready-with-warnings if any warns, clean, or empty without episodes."""
    bad = F.col("read_error").isNotNull()
    count = lambda s: F.count_if(~bad & (F.col("severity") == s))
    out = episodes.agg(count("pass").alias("n_pass"), count("warning").alias("n_warning"), count("critical").alias("n_critical"), F.count_if(bad).alias("n_unreadable"), F.count(F.lit(1)).alias("episodes"))
    verdict = F.when(F.col("episodes") == 0, "empty").when(F.col("n_critical") + F.col("n_unreadable") > 0, "not-ready").when(F.col("n_warning") > 0, "ready-with-warnings").otherwise("clean")
    return out.withColumn("verdict", verdict)


def episode_overview(topics: DataFrame, bounds: DataFrame) -> DataFrame:
    """(episode_index, duration, severity, reasons): the topics that don't pass, in the report's order, in one text. bounds:
    (episode_index, start_ts, end_ts). An episode has as many topics as its robot, so these make one list."""
    bad = F.when(F.col("severity") != "pass", F.struct(role_rank(F.col("role")).alias("k"), "label", "topic", F.concat("label", F.lit(": "), "reason").alias("said")))
    rank = {"pass": 1, "warning": 2, "critical": 3}
    worst = F.max(F.element_at(F.create_map(*(F.lit(x) for kv in rank.items() for x in kv)), F.col("severity")))
    out = topics.groupBy("episode_index").agg(worst.alias("w"), F.array_sort(F.collect_list(bad)).alias("bad")).join(bounds, "episode_index", "left")
    names = F.array(*map(F.lit, rank))
    reasons = F.array_join(F.transform("bad", lambda b: b["said"]), "; ")
    return out.select("episode_index", (F.col("end_ts") - F.col("start_ts")).alias("duration"), F.element_at(names, F.col("w")).alias("severity"), F.when(F.size("bad") > 0, reasons).otherwise("-").alias("reasons"))
