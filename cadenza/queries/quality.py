"""Queries on recording quality and its reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import coverage, reports
from cadenza.queries.base import COVERAGE, DAY, HOURLY, LIMITS, MESSAGES, hourly, messages, query, rounded, topics
from cadenza.streaming import monitor

TYPES = ("view", "click", "purchase", "signup", "error")
ROLE = "CASE WHEN t IN ('view', 'click') THEN 'stream' WHEN t IN ('purchase', 'signup') THEN 'action' ELSE 'unclassified' END"
DECLARED = f"declared AS (SELECT e AS episode_index, t AS topic, {ROLE} AS role FROM (SELECT DISTINCT episode_index AS e FROM messages), (SELECT unnest(['view', 'click', 'purchase', 'signup', 'error']) AS t))"


def declared(rows):
    """Every topic for every episode."""
    out = rows.select("episode_index").distinct().withColumn("topic", F.explode(F.array(*map(F.lit, TYPES))))
    return out.withColumn("role", F.when(F.col("topic").isin("view", "click"), "stream").when(F.col("topic").isin("purchase", "signup"), "action").otherwise("unclassified"))


@query(f"WITH {HOURLY}, {DECLARED} SELECT d.episode_index, d.topic, d.role, count(m.event_id) AS message_count FROM declared d LEFT JOIN messages m ON d.episode_index = m.episode_index AND d.topic = m.topic GROUP BY ALL")
def topic_inventory_declared(spark, sf_dir):
    rows = hourly(spark, sf_dir)
    return coverage.topic_inventory(rows, declared(rows)).select("episode_index", "topic", "role", "message_count")


@query(f"""WITH {COVERAGE.replace(MESSAGES, HOURLY)}, {DECLARED} SELECT d.episode_index, d.topic, d.role, coalesce(message_count, 0) AS message_count,
  CASE WHEN severity IS NOT NULL THEN severity WHEN d.role = 'stream' THEN 'critical' WHEN d.role = 'action' THEN 'warning' ELSE 'pass' END AS severity,
  round(CASE WHEN severity IS NULL AND d.role <> 'unclassified' THEN 0 ELSE coalesce(coverage, 1) END, 6) AS coverage
FROM declared d LEFT JOIN covered c ON d.episode_index = c.episode_index AND d.topic = c.topic""")
def topic_coverage_declared(spark, sf_dir):
    """Silent topics stay, as critical streams and warned actions."""
    rows = hourly(spark, sf_dir)
    return rounded(coverage.topic_coverage(rows, declared(rows), **LIMITS), "coverage").select("episode_index", "topic", "role", "message_count", "severity", "coverage")


GAPS = f"""{COVERAGE}, g AS (
  SELECT s.episode_index, s.topic, s.ts - dt AS a, s.ts AS b, dt AS d, CASE WHEN s.role = 'stream' THEN 'dropframe' ELSE 'idle' END AS kind FROM steps s JOIN own o ON s.episode_index = o.episode_index AND s.topic = o.topic WHERE dt > lim AND s.role <> 'unclassified'
  UNION ALL SELECT episode_index, topic, s, a, a - s, 'leading' FROM own JOIN bounds USING (episode_index) WHERE role = 'stream' AND message_count > 1 AND a - s > lim
  UNION ALL SELECT episode_index, topic, b, e, e - b, 'trailing' FROM own JOIN bounds USING (episode_index) WHERE role = 'stream' AND message_count > 1 AND e - b > lim
), gs AS (SELECT g.*, a - s AS start_s, b - s AS end_s FROM g JOIN bounds USING (episode_index))"""


@query(f"WITH {GAPS} SELECT episode_index, topic, round(start_s, 3) AS start_s, round(end_s, 3) AS end_s, round(d, 3) AS duration_s, kind FROM gs")
def topic_gaps(spark, sf_dir):
    rows = coverage.topic_coverage(messages(spark, sf_dir), **LIMITS).select("episode_index", "topic", F.explode("gaps").alias("g"))
    return rows.select("episode_index", "topic", *(F.round(f"g.{c}", 3).alias(c) for c in ("start_s", "end_s", "duration_s")), "g.kind")


@query(f"WITH {GAPS} SELECT episode_index, topic, round(arg_max(start_s, (d, -start_s)), 3) AS start_s, round(max(d), 3) AS duration_s FROM gs GROUP BY episode_index, topic")
def longest_gap(spark, sf_dir):
    rows = coverage.longest_gap(coverage.topic_coverage(messages(spark, sf_dir), **LIMITS)).filter("longest IS NOT NULL")
    return rows.select("episode_index", "topic", F.round("longest.start_s", 3).alias("start_s"), F.round("longest.duration_s", 3).alias("duration_s"))


@query(f"""WITH {COVERAGE} SELECT topic AS label, count(*) FILTER (severity = 'pass') AS n_pass, count(*) FILTER (severity = 'warning') AS n_warning, count(*) FILTER (severity = 'critical') AS n_critical,
round(min(round(avg_fps * 86400, 6)), 5) AS min_fps, round(quantile_cont(round(avg_fps * 86400, 6), 0.5), 5) AS median_fps, round(max(round(avg_fps * 86400, 6)), 5) AS max_fps FROM covered GROUP BY topic""")
def topic_health(spark, sf_dir):
    found = reports.topic_health(topics(spark, sf_dir))
    return found.withColumns({c: F.round(c, 5) for c in ("min_fps", "median_fps", "max_fps")})


@query(f"""WITH {COVERAGE}, b AS (SELECT *, row_number() OVER (PARTITION BY topic, severity ORDER BY episode_index) AS k FROM covered WHERE severity <> 'pass')
SELECT topic AS label, severity, count(*) AS episodes, (SELECT count(DISTINCT episode_index) FROM covered) AS of_episodes, string_agg(episode_index::VARCHAR, ',' ORDER BY episode_index) FILTER (k <= 20) AS shown FROM b GROUP BY topic, severity""")
def flagged_topics(spark, sf_dir):
    found = reports.flagged_topics(topics(spark, sf_dir))
    return found.withColumn("shown", F.array_join(F.transform("shown", lambda e: e.cast("string")), ",")).drop("reason")


WORST = f"{COVERAGE}, r AS (SELECT episode_index, max(CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END) AS k FROM covered GROUP BY episode_index)"


@query(f"""WITH {WORST}, v AS (SELECT k, episode_index % 10 = 0 AS bad FROM r)
SELECT count(*) FILTER (k = 1 AND NOT bad) AS n_pass, count(*) FILTER (k = 2 AND NOT bad) AS n_warning, count(*) FILTER (k = 3 AND NOT bad) AS n_critical, count(*) FILTER (bad) AS n_unreadable, count(*) AS episodes,
CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) FILTER (k = 3 OR bad) > 0 THEN 'not-ready' WHEN count(*) FILTER (k = 2) > 0 THEN 'ready-with-warnings' ELSE 'clean' END AS verdict FROM v""")
def session_verdict(spark, sf_dir):
    """Every tenth episode counts as unreadable."""
    rows = coverage.worst_severity(topics(spark, sf_dir))
    return reports.session_verdict(rows.withColumn("read_error", F.when(F.col("episode_index") % 10 == 0, "broken")))


@query(f"""WITH {WORST}, said AS (
  SELECT episode_index, string_agg(topic, ';' ORDER BY CASE role WHEN 'stream' THEN 1 WHEN 'action' THEN 2 ELSE 3 END, topic) AS named FROM covered WHERE severity <> 'pass' GROUP BY episode_index
) SELECT r.episode_index, round(e - s, 3) AS duration, CASE k WHEN 3 THEN 'critical' WHEN 2 THEN 'warning' ELSE 'pass' END AS severity, coalesce(named, '-') AS named FROM r LEFT JOIN said USING (episode_index) LEFT JOIN bounds USING (episode_index)""")
def episode_overview(spark, sf_dir):
    found = reports.episode_overview(topics(spark, sf_dir), coverage.session_bounds(messages(spark, sf_dir)))
    named = F.regexp_replace(F.regexp_replace("reasons", ": [^;]*", ""), "; ", ";")
    return found.select("episode_index", F.round("duration", 3).alias("duration"), "severity", named.alias("named"))


@query("SELECT t AS label, " + ROLE + " AS role, row_number() OVER (ORDER BY CASE WHEN t IN ('view', 'click') THEN 1 WHEN t IN ('purchase', 'signup') THEN 2 ELSE 3 END, t) AS position FROM (SELECT DISTINCT event_type AS t FROM events)")
def report_order(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.orderBy(reports.role_rank(F.col("role")), "label")  # a row per label
    return reports.report_order(topics(spark, sf_dir)).withColumn("position", F.row_number().over(order))


@query(f"WITH {MESSAGES} SELECT episode_index, count(*) AS message_count, round(CASE WHEN count(*) < 2 THEN 0 ELSE max(ts) - min(ts) END, 3) AS duration FROM messages GROUP BY episode_index")
def recording_duration(spark, sf_dir):
    return coverage.recording_duration(messages(spark, sf_dir)).withColumn("duration", F.round("duration", 3))


@query(f"WITH {MESSAGES}, n AS (SELECT episode_index, topic, max(ts) AS t FROM messages GROUP BY ALL) SELECT episode_index, round(CASE WHEN count(*) > 1 THEN max(t) - min(t) END, 3) AS drift FROM n GROUP BY episode_index")
def time_drift(spark, sf_dir):
    return coverage.time_drift(messages(spark, sf_dir)).withColumn("drift", F.round("drift", 3))


@query(f"""WITH {MESSAGES}, i AS (SELECT episode_index, topic, count(*) AS n, min(ts) AS a, max(ts) AS b FROM messages GROUP BY ALL), f AS (SELECT *, max(b) OVER w - min(a) OVER w AS span FROM i WINDOW w AS (PARTITION BY episode_index))
SELECT episode_index, topic, round(CASE WHEN n >= 2 AND span > 0 THEN (n - 1) / span END * 86400, 6) AS fps FROM f""")
def estimate_fps(spark, sf_dir):
    found = coverage.estimate_fps(coverage.topic_inventory(messages(spark, sf_dir)), whole_file=True)
    return found.select("episode_index", "topic", F.round(F.col("fps") * DAY, 6).alias("fps"))


SNAP = "CASE " + " ".join(f"WHEN abs(x - {r}) / {r} <= 0.15 THEN {r}" for r in coverage.USUAL_RATES) + " ELSE greatest(5, 5 * round_even(x / 5, 0)::INTEGER) END::INTEGER"


@query(f"WITH m AS (SELECT min(n) AS x FROM (SELECT count(*) AS n FROM events GROUP BY user_id)) SELECT {SNAP} AS fps, 30 <= {SNAP} AS allowed FROM m")
def session_fps(spark, sf_dir):
    rates = messages(spark, sf_dir).groupBy("episode_index").agg(F.count(F.lit(1)).alias("fps"))
    return coverage.session_fps(rates, 30)


@query(f"""WITH {HOURLY}, have AS (SELECT DISTINCT episode_index, topic FROM messages) SELECT e.episode_index, t.topic, e.has_commands FROM
(SELECT episode_index, bool_or(ends_with(topic, '/commands')) AS has_commands FROM have GROUP BY episode_index) e, (SELECT unnest(['view', 'click', 'signup']) AS topic) t ANTI JOIN have h ON h.episode_index = e.episode_index AND h.topic = t.topic""")
def missing_topics(spark, sf_dir):
    configured = spark.createDataFrame([("view",), ("click",), ("signup",)], "topic string")
    return coverage.missing_topics(hourly(spark, sf_dir).select("episode_index", "topic").distinct(), configured)


KINDS = """k AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '/cam_' || event_type || '/image_raw/compressed' WHEN 1 THEN '/follower_l_' || event_type || '_controller/commands' WHEN 2 THEN '/joint_states' WHEN 3 THEN '/' || event_type || '/image' ELSE '/log/' || event_type END AS topic,
CASE event_id % 5 WHEN 0 THEN 'ros2msg://sensor_msgs/msg/CompressedImage' WHEN 1 THEN 'std_msgs/msg/Float64MultiArray' WHEN 2 THEN 'sensor_msgs/JointState' WHEN 3 THEN 'sensor_msgs/Image' ELSE 'std_msgs/msg/String' END AS schema_name FROM events)"""


@query(f"""WITH {KINDS} SELECT topic, CASE WHEN schema_name LIKE '%Image' OR schema_name LIKE '%JointState' THEN 'stream' WHEN schema_name LIKE '%MultiArray' THEN 'action' ELSE 'unclassified' END AS role,
CASE WHEN topic = '/joint_states' THEN 'joint_states' WHEN topic LIKE '/cam_%' THEN regexp_extract(topic, '^/cam_([^/]+)/', 1) WHEN topic LIKE '/follower_l_%' THEN 'action[left]' ELSE replace(topic[2:], '/', '_') END AS label, count(*) AS n FROM k GROUP BY ALL""")
def classify_topic(spark, sf_dir):
    e = messages(spark, sf_dir).select("topic", (F.col("event_id") % 5).alias("k"))
    name = F.when(F.col("k") == 0, F.format_string("/cam_%s/image_raw/compressed", "topic")).when(F.col("k") == 1, F.format_string("/follower_l_%s_controller/commands", "topic")).when(F.col("k") == 2, "/joint_states")
    name = name.when(F.col("k") == 3, F.format_string("/%s/image", "topic")).otherwise(F.format_string("/log/%s", "topic"))
    kinds = ["ros2msg://sensor_msgs/msg/CompressedImage", "std_msgs/msg/Float64MultiArray", "sensor_msgs/JointState", "sensor_msgs/Image", "std_msgs/msg/String"]
    rows = e.select(name.alias("topic"), F.element_at(F.array(*map(F.lit, kinds)), (F.col("k") + 1).cast("int")).alias("schema_name"))
    return coverage.classify_topic(rows).groupBy("topic", "role", "label").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT time_bucket(INTERVAL 1 hour, ts) AS start, user_id AS episode_index, event_type AS topic, count(*) AS messages, round(count(*) / 3600.0, 9) AS fps, event_type = 'view' AND count(*) / 3600.0 < 0.0004 * 2 / 3 AS slow
FROM events GROUP BY 1, 2, 3""")
def window_rates(spark, sf_dir):
    """The streaming operator on the table as it stands."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", F.col("user_id").alias("episode_index"), F.col("event_type").alias("topic"))
    found = monitor.window_rates(rows, seconds=3600, expected={"view": 0.0004})
    return found.withColumn("fps", F.round("fps", 9)).drop("window")


@query("""WITH r AS (SELECT time_bucket(INTERVAL 6 hour, ts) AS start, user_id % 20 AS episode_index, event_type AS topic, count(*) / 21600.0 AS fps FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL),
w AS (SELECT DISTINCT start, episode_index FROM r), e AS (SELECT w.*, v.* FROM w, (VALUES ('click', 0.0004), ('view', 0.0005)) v(topic, due)), a AS (SELECT e.start, e.episode_index, e.topic, coalesce(r.fps, 0) AS fps, coalesce(r.fps, 0) < e.due * 2 / 3 AS slow FROM e LEFT JOIN r ON r.start = e.start AND r.episode_index = e.episode_index AND r.topic = e.topic)
SELECT start, episode_index, (count(*) FILTER (slow))::INT AS slow_cameras, (min_by(topic, (fps, topic)) FILTER (slow)) AS bottleneck, round((min(fps) FILTER (slow)), 9) AS fps FROM a GROUP BY ALL""")
def bottlenecks(spark, sf_dir):
    """The streaming operator on the table as it stands."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", (F.col("user_id") % 20).alias("episode_index"), F.col("event_type").alias("topic"))
    return monitor.bottlenecks(rows, {"click": 0.0004, "view": 0.0005}, seconds=21600).withColumn("fps", F.round("fps", 9))


@query("""WITH g AS (SELECT user_id AS episode_index, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS d FROM events), s AS (SELECT *, count(*) FILTER (d IS NULL OR d > INTERVAL 6 hour) OVER (PARTITION BY episode_index ORDER BY ts) AS k FROM g)
SELECT episode_index, min(ts) AS start, max(ts) + INTERVAL 6 hour AS ended, count(*) AS messages FROM s GROUP BY episode_index, k""")
def episode_ends(spark, sf_dir):
    """The streaming operator on the table as it stands; both sides fall silent for six hours."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", F.col("user_id").alias("episode_index"), F.lit("truth").alias("side"))
    return monitor.episode_ends(rows, truth_gap=6 * 3600, grace=0).withColumnRenamed("end", "ended")
