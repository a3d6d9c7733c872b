"""Tables that stand in for recordings, the registry of queries and their SQL twins, and the first of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators import coverage, frames, metrics, splits

DAY = 86_400.0
#: Events of a user are days apart, so gaps are measured in days here.
LIMITS = {"gap_factor": 5.0, "min_gap_s": DAY, "action_gap_s": 3 * DAY}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function as a query under its name, with its SQL twin."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("event_type").isin("view", "click"), "stream").when(F.col("event_type").isin("purchase", "signup"), "action").otherwise("unclassified")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("episode_index"), F.col("event_type").alias("topic"), role.alias("role"), (micros / 1e6).alias("ts"), micros.alias("us"), "value")


def supplier_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("episode_index"), *order, "l_discount", "l_tax")
    return rows.withColumn("frame_index", F.row_number().over(frames.ordered(*order)).cast("long") - 1)


#: Joints of the vectors below.
NAMES = ["right_joint_1.pos", "right_joint_2.pos", "right_gripper.pos", "left_joint_1.pos"]


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode_index, frame_index, action, state): four joints made of a line item's numbers."""
    d = lambda c: F.col(c).cast("double")
    action = F.array(d("l_quantity") / 10, d("l_discount"), d("l_tax"), d("l_extendedprice") / 1000)
    state = F.array(d("l_quantity") / 20, d("l_discount") + 0.01, d("l_tax"), d("l_extendedprice") / 2000)
    return supplier_frames(spark, sf_dir).select("episode_index", "frame_index", action.alias("action"), state.alias("state"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode_index, split_label, frame_index, chunk_id, predicted, truth, reference, observed): quarters of a vector."""
    e = F.col("embedding")
    parts = {c: F.slice(e, 16 * i + 1, 16) for i, c in enumerate(("predicted", "truth", "reference", "observed"))}
    label = F.when(F.col("label") % 3 == 0, "train").when(F.col("label") % 3 == 1, "val").otherwise("test")
    rows = read(spark, sf_dir, "embeddings").select(F.col("label").alias("episode_index"), label.alias("split_label"), F.col("vec_id").alias("frame_index"), *(v.alias(c) for c, v in parts.items()))
    return rows.withColumn("chunk_id", F.floor(F.col("frame_index") / 100))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """messages whose episodes are hours, so that some topics are missing."""
    return messages(spark, sf_dir).withColumn("episode_index", F.floor(F.col("us") / 3_600_000_000).cast("long"))


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def topic_inventory(spark, sf_dir):
    return coverage.topic_inventory(messages(spark, sf_dir)).select("episode_index", "topic", "message_count", F.round(F.col("last_ts") - F.col("first_ts"), 3).alias("duration"))


def topic_coverage(spark, sf_dir):
    found = coverage.topic_coverage(messages(spark, sf_dir), **LIMITS)
    found = found.withColumns({c: F.round(c, 3) for c in ("total_gap", "longest_gap")}).withColumn("avg_fps", F.round(F.col("avg_fps") * DAY, 6)).withColumn("coverage", F.round("coverage", 6))
    return found.drop("gaps", "reason")


def worst_severity(spark, sf_dir):
    return coverage.worst_severity(coverage.topic_coverage(messages(spark, sf_dir), **LIMITS))


def topics(spark, sf_dir):
    """topic_coverage with rates a day, rounded, so that comparisons of rates don't hang on the last digit."""
    rows = coverage.topic_coverage(messages(spark, sf_dir), **LIMITS)
    return rows.withColumn("avg_fps", F.round(F.col("avg_fps") * DAY, 6)).withColumn("label", F.col("topic"))


def fps_degradation(spark, sf_dir):
    return rounded(coverage.fps_degradation(topics(spark, sf_dir), tolerance=0.05), "others_fps").select("episode_index", "topic", "role", "avg_fps", "others_fps", "degraded", "severity")


def missing_expected(spark, sf_dir):
    return coverage.missing_expected(hourly(spark, sf_dir).select(*coverage.TOPIC)).drop("reason")


def snap_fps(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy(coverage.snap_fps(F.col("l_quantity")).alias("fps")).agg(F.count(F.lit(1)).alias("n"))


def nearest_asof(spark, sf_dir):
    rows = messages(spark, sf_dir)
    left = rows.filter("topic = 'click'").select("event_id", "episode_index", F.col("us").alias("ts"))
    right = rows.filter("topic = 'view'").select("episode_index", F.col("us").alias("ts"), F.col("event_id").alias("value"))
    return frames.nearest_asof(left, right).select("event_id", F.col("nearest_value").alias("nearest_id"), F.abs(F.col("ts") - F.col("nearest_ts")).alias("dt"))


def reindex(spark, sf_dir):
    rows = supplier_frames(spark, sf_dir).filter("l_quantity >= 10").drop("frame_index")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    return rounded(frames.reindex(rows, order, 30.0), "timestamp").select("episode_index", "frame_index", "index", "timestamp", "l_orderkey", "l_partkey")


def sustained_runs(spark, sf_dir):
    return frames.sustained_runs(supplier_frames(spark, sf_dir), F.col("l_quantity") > 20, 4)


def hold_baseline(spark, sf_dir):
    rows = frames.assign_chunks(supplier_frames(spark, sf_dir), 30, "l_quantity")
    return rounded(rows.groupBy("episode_index", "chunk_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("l_quantity") - F.col("reference"))).alias("hold_mae")), "hold_mae")


def feature_stats(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.array("l_quantity", "l_discount", "l_tax", "l_extendedprice").alias("action"))
    return rounded(metrics.feature_stats(rows, "action"), "min", "max", "mean", "std", "q01", "q10", "q50", "q90", "q99")


def episode_metrics(spark, sf_dir):
    found = metrics.episode_metrics(predictions(spark, sf_dir))
    return rounded(found, "mse", "mae", "rmse", "max_abs_error", "cosine", *(f"{n}_smoothness_{k}" for n in ("pred", "truth") for k in ("mean", "std")))


def split_episodes(spark, sf_dir):
    return splits.split_episodes(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("episode_index")))


QUERIES |= {f.__name__: f for f in (topic_inventory, topic_coverage, worst_severity, fps_degradation, missing_expected, snap_fps, nearest_asof, reindex, sustained_runs, hold_baseline, feature_stats, episode_metrics, split_episodes)}

MESSAGES = """messages AS (
  SELECT event_id, user_id AS episode_index, event_type AS topic, epoch_us(ts) AS us, epoch_us(ts) / 1e6 AS ts,
    CASE WHEN event_type IN ('view', 'click') THEN 'stream' WHEN event_type IN ('purchase', 'signup') THEN 'action' ELSE 'unclassified' END AS role
  FROM events
)"""
FRAMES = """frames AS (
  SELECT *, l_suppkey AS episode_index,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS frame_index
  FROM lineitem
)"""
VECTORS = f"""{FRAMES}, vectors AS (
  SELECT episode_index, frame_index, [l_quantity::DOUBLE / 10, l_discount::DOUBLE, l_tax::DOUBLE, l_extendedprice::DOUBLE / 1000] AS action,
    [l_quantity::DOUBLE / 20, l_discount::DOUBLE + 0.01, l_tax::DOUBLE, l_extendedprice::DOUBLE / 2000] AS state FROM frames
), joints AS (
  SELECT episode_index, frame_index, unnest([0, 1, 2, 3]) AS joint, unnest(action) AS a, unnest(state) AS s FROM vectors
)"""
#: A frame's and the three next values of each joint, the last one held beyond the end, added up by their place; chunk_digest
#: is the same for chunks of four, so that an order that is wrong shows.
CHUNK_STEPS = f"""WITH {VECTORS}, l AS (SELECT *, last_value(a) OVER (PARTITION BY episode_index, joint ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM joints), k AS (SELECT episode_index, frame_index, joint, s, a + 2 * coalesce(lead(a, 1) OVER w, z) + 3 * coalesce(lead(a, 2) OVER w, z) + 4 * coalesce(lead(a, 3) OVER w, z) AS c FROM l WINDOW w AS (PARTITION BY episode_index, joint ORDER BY frame_index))"""


def chunk_digest(chunk: Column) -> Column:
    own = lambda v: F.aggregate(F.transform(v, lambda x, j: (j + 1) * x.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(F.transform(chunk, lambda v, k: (k + 1) * own(v)), F.lit(0.0), lambda s, x: s + x)

PREDICTIONS = """predictions AS (
  SELECT label AS episode_index, CASE label % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split_label, vec_id AS frame_index, vec_id // 100 AS chunk_id, embedding AS e FROM embeddings
), pj AS (
  SELECT episode_index, split_label, frame_index, chunk_id, unnest(range(16)) AS joint, unnest(e[1:16])::DOUBLE AS p, unnest(e[17:32])::DOUBLE AS t,
    unnest(e[33:48])::DOUBLE AS h, unnest(e[49:64])::DOUBLE AS o FROM predictions
)"""
HOURLY = MESSAGES.replace("user_id AS episode_index", "epoch_us(ts) // 3600000000 AS episode_index")
COVERAGE = f"""{MESSAGES}, steps AS (
  SELECT *, ts - lag(ts) OVER (PARTITION BY episode_index, topic ORDER BY ts) AS dt FROM messages
), own AS (
  SELECT episode_index, topic, role, count(*) AS message_count, min(ts) AS a, max(ts) AS b,
    CASE WHEN role = 'stream' THEN greatest(86400.0, 5 * coalesce(quantile_cont(dt, 0.5), 0)) ELSE 259200.0 END AS lim
  FROM steps GROUP BY episode_index, topic, role
), gaps AS (
  SELECT s.episode_index, s.topic, sum(dt) AS g, max(dt) AS l FROM steps s JOIN own o ON s.episode_index = o.episode_index AND s.topic = o.topic
  WHERE dt > lim AND s.role <> 'unclassified' GROUP BY ALL
), bounds AS (
  SELECT episode_index, min(ts) AS s, max(ts) AS e FROM messages WHERE role <> 'unclassified' GROUP BY ALL
), ends AS (
  SELECT o.*, coalesce(g, 0) AS g, coalesce(l, 0) AS l, greatest(coalesce(e - s, 0), 1e-9) AS span,
    CASE WHEN role = 'stream' AND a - s > lim THEN a - s ELSE 0 END AS lead_gap, CASE WHEN role = 'stream' AND e - b > lim THEN e - b ELSE 0 END AS trail_gap
  FROM own o LEFT JOIN gaps x ON o.episode_index = x.episode_index AND o.topic = x.topic LEFT JOIN bounds y ON o.episode_index = y.episode_index
), totals AS (
  SELECT *, CASE WHEN role = 'stream' AND message_count < 2 THEN span ELSE g + lead_gap + trail_gap END AS total_gap,
    CASE WHEN role = 'stream' AND message_count < 2 THEN span ELSE greatest(l, lead_gap, trail_gap) END AS longest_gap FROM ends
), covered AS (
  SELECT episode_index, topic, role, message_count, CASE WHEN role <> 'action' AND b > a THEN (message_count - 1) / (b - a) END AS avg_fps, total_gap, longest_gap,
    greatest(0, 1 - total_gap / span) AS coverage, CASE WHEN total_gap > 0 AND role = 'stream' THEN 'critical' WHEN total_gap > 0 AND role = 'action' THEN 'warning' ELSE 'pass' END AS severity
  FROM totals
)"""
Q = ", ".join(f"round(quantile_cont(x, {q}), 6) AS {n}" for n, q in (("q01", 0.01), ("q10", 0.1), ("q50", 0.5), ("q90", 0.9), ("q99", 0.99)))

ORACLES |= {
    "topic_inventory": f"WITH {MESSAGES} SELECT episode_index, topic, count(*) AS message_count, round(max(ts) - min(ts), 3) AS duration FROM messages GROUP BY episode_index, topic",
    "topic_coverage": f"WITH {COVERAGE} SELECT episode_index, topic, role, message_count, round(avg_fps * 86400, 6) AS avg_fps, round(total_gap, 3) AS total_gap, round(longest_gap, 3) AS longest_gap, round(coverage, 6) AS coverage, severity FROM covered",
    "worst_severity": f"""WITH {COVERAGE}, r AS (SELECT episode_index, max(CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END) AS k FROM covered GROUP BY episode_index)
SELECT episode_index, CASE k WHEN 3 THEN 'critical' WHEN 2 THEN 'warning' ELSE 'pass' END AS severity, k < 3 AS passed FROM r""",
    "fps_degradation": f"""WITH {COVERAGE}, r AS (SELECT *, round(avg_fps * 86400, 6) AS f FROM covered), others AS (
  SELECT a.episode_index, a.topic, quantile_cont(b.f, 0.5) AS m FROM r a LEFT JOIN r b ON a.topic = b.topic AND a.episode_index <> b.episode_index WHERE a.role = 'stream' AND a.f IS NOT NULL GROUP BY ALL
), d AS (SELECT r.*, m, coalesce(r.role = 'stream' AND f < 0.95 * m, false) AS degraded FROM r LEFT JOIN others o ON r.episode_index = o.episode_index AND r.topic = o.topic)
SELECT episode_index, topic, role, f AS avg_fps, round(m, 6) AS others_fps, degraded, CASE WHEN degraded AND severity = 'pass' THEN 'warning' ELSE severity END AS severity FROM d""",
    "missing_expected": f"""WITH {HOURLY}, present AS (SELECT DISTINCT episode_index, topic, role FROM messages), n AS (SELECT count(DISTINCT episode_index) AS episodes FROM present),
usual AS (SELECT topic, role, count(*) AS present_in, any_value(episodes) AS episodes FROM present, n WHERE role IN ('stream', 'action') GROUP BY topic, role HAVING count(*) >= any_value(episodes) // 2 + 1 AND any_value(episodes) > 1)
SELECT e.episode_index, u.topic, u.role, u.present_in, u.episodes, 'critical' AS severity FROM (SELECT DISTINCT episode_index FROM present) e, usual u
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.episode_index = e.episode_index AND p.topic = u.topic AND p.role = u.role)""",
    "snap_fps": "SELECT CASE " + " ".join(f"WHEN abs(l_quantity - {r}) / {r} <= 0.15 THEN {r}" for r in (15, 20, 24, 25, 30, 50, 60)) + " ELSE greatest(5, 5 * round_even(l_quantity / 5, 0)::INTEGER) END::INTEGER AS fps, count(*) AS n FROM lineitem GROUP BY 1",
    "nearest_asof": f"""WITH {MESSAGES}, r AS (SELECT episode_index, us, min(event_id) AS id FROM messages WHERE topic = 'view' GROUP BY ALL), pairs AS (
  SELECT l.event_id, r.id, abs(l.us - r.us) AS dt, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.us - r.us), r.us) AS k
  FROM messages l LEFT JOIN r ON l.episode_index = r.episode_index WHERE l.topic = 'click'
) SELECT event_id, id AS nearest_id, dt FROM pairs WHERE k = 1""",
    "reindex": """WITH k AS (SELECT *, l_suppkey AS episode_index FROM lineitem WHERE l_quantity >= 10), o AS (
  SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS frame_index,
    row_number() OVER (ORDER BY episode_index, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS index FROM k
) SELECT episode_index, frame_index, index, round(frame_index / 30.0::DOUBLE, 6) AS timestamp, l_orderkey, l_partkey FROM o""",
    "sustained_runs": f"""WITH {FRAMES}, i AS (SELECT *, frame_index - row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS island FROM frames WHERE l_quantity > 20)
SELECT episode_index, min(frame_index) AS start_frame, count(*) AS run_length FROM i GROUP BY episode_index, island HAVING count(*) >= 4""",
    "hold_baseline": f"""WITH {FRAMES}, c AS (SELECT *, frame_index // 30 AS chunk_id, first_value(l_quantity) OVER (PARTITION BY episode_index, frame_index // 30 ORDER BY frame_index) AS r FROM frames)
SELECT episode_index, chunk_id, count(*) AS n, round(avg(abs(l_quantity - r)), 6) AS hold_mae FROM c GROUP BY episode_index, chunk_id""",
    "feature_stats": f"""WITH x AS (SELECT 0 AS dim, l_quantity AS x FROM lineitem UNION ALL SELECT 1, l_discount FROM lineitem UNION ALL SELECT 2, l_tax FROM lineitem UNION ALL SELECT 3, l_extendedprice FROM lineitem)
SELECT dim, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, count(x) AS count, {Q} FROM x GROUP BY dim""",
    "episode_metrics": f"""WITH {PREDICTIONS}, f AS (
  SELECT episode_index, split_label, frame_index, sum(p * t) AS d, sqrt(sum(p * p)) * sqrt(sum(t * t)) AS n FROM pj GROUP BY ALL
), c AS (SELECT episode_index, split_label, count(*) AS frames, avg(CASE WHEN n > 1e-8 THEN d / n ELSE 0 END) AS cosine FROM f GROUP BY ALL
), s AS (
  SELECT episode_index, frame_index, p - lag(p) OVER w AS dp, t - lag(t) OVER w AS dt FROM pj WINDOW w AS (PARTITION BY episode_index, joint ORDER BY frame_index)
), l AS (SELECT episode_index, sqrt(sum(dp * dp)) AS dp, sqrt(sum(dt * dt)) AS dt FROM s WHERE dp IS NOT NULL GROUP BY episode_index, frame_index
), m AS (SELECT episode_index, avg(dp) AS a, stddev_pop(dp) AS b, avg(dt) AS c, stddev_pop(dt) AS d FROM l GROUP BY ALL
), w AS (
  SELECT episode_index, avg((p - t) ** 2) AS mse, avg(abs(p - t)) AS mae, max(abs(p - t)) AS m, arg_max(joint, (abs(p - t), -frame_index, -joint)) AS k FROM pj GROUP BY ALL
) SELECT c.episode_index, split_label, frames, round(cosine, 6) AS cosine, round(mse, 6) AS mse, round(mae, 6) AS mae, round(sqrt(mse), 6) AS rmse, round(w.m, 6) AS max_abs_error, k::INTEGER AS max_error_joint,
  round(coalesce(a, 0), 6) AS pred_smoothness_mean, round(coalesce(b, 0), 6) AS pred_smoothness_std, round(coalesce(m.c, 0), 6) AS truth_smoothness_mean, round(coalesce(m.d, 0), 6) AS truth_smoothness_std
FROM c JOIN w ON c.episode_index = w.episode_index LEFT JOIN m ON c.episode_index = m.episode_index""",
    "split_episodes": """WITH r AS (SELECT s_suppkey AS episode_index, row_number() OVER (ORDER BY md5('42:' || s_suppkey::VARCHAR), s_suppkey) AS k, count(*) OVER () AS n FROM supplier), c AS (SELECT *, round_even(n / 10.0, 0) AS v FROM r)
SELECT episode_index, CASE WHEN k <= n - 2 * v THEN 'train' WHEN k <= n - v THEN 'val' ELSE 'test' END AS split FROM c""",
}
