"""Queries on trimming, splits, merging, catalogs and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import audit, coverage, joints, motion, splits
from cadenza.operators.metrics import feature_stats as stats_of
from cadenza.operators.vectors import quantile_scaled, standardized
from cadenza.queries.base import CHUNK_STEPS, COVERAGE, FRAMES, LIMITS, MESSAGES, NAMES, VECTORS, chunk_digest, messages, query, read, rounded, supplier_frames, vector_frames
from cadenza.shared import shared_path, stash
from cadenza.sources import datasets

K, SUSTAIN = 15, 3
CONFIG = motion.MotionTrimConfig(baseline_frames=K, sustain_frames=SUSTAIN, arm_threshold=30.0, gripper_threshold=0.02, end_arm_threshold=30.0, end_gripper_threshold=0.02, start_offset_frames=-2, end_postroll_frames=3, min_frames=20)
EDGES = f"""{VECTORS}, size AS (SELECT episode_index, max(frame_index) + 1 AS n FROM vectors GROUP BY ALL), e AS (
  SELECT episode_index, any_value(n) AS n, joint, quantile_cont(a, 0.5) FILTER (frame_index < {K}) AS i, quantile_cont(a, 0.5) FILTER (frame_index >= n - {K}) AS f FROM joints JOIN size USING (episode_index) GROUP BY episode_index, joint
)"""
#: The third joint is the gripper.
MOTION = f"""{EDGES}, m AS (
  SELECT j.episode_index, frame_index, n, bool_or(joint <> 2 AND abs(a - i) > 30) AS departed, bool_or(CASE WHEN joint = 2 THEN abs(a - f) > 0.02 ELSE abs(a - f) > 30 END) AS unsettled FROM joints j JOIN e USING (episode_index, joint) GROUP BY ALL
), runs AS (
  SELECT *, frame_index - row_number() OVER (PARTITION BY episode_index, departed ORDER BY frame_index) AS di, frame_index - row_number() OVER (PARTITION BY episode_index, unsettled ORDER BY frame_index) AS ui FROM m
), d AS (SELECT episode_index, min(frame_index) AS f FROM runs WHERE departed GROUP BY episode_index, di HAVING count(*) >= {SUSTAIN}
), u AS (SELECT episode_index, max(frame_index) + 1 AS f FROM runs WHERE unsettled GROUP BY episode_index, ui HAVING count(*) >= {SUSTAIN}
), ev AS (SELECT episode_index, n, (SELECT min(f) FROM d WHERE d.episode_index = size.episode_index) AS first, (SELECT max(f) FROM u WHERE u.episode_index = size.episode_index) AS last FROM size
), w0 AS (SELECT *, greatest(0, least(n - 1, coalesce(first, 0) - 2)) AS s, least(n, coalesce(last, n) + 3) AS e FROM ev
), w1 AS (SELECT * REPLACE (CASE WHEN e - s < 20 THEN least(n, s + 20) ELSE e END AS e) FROM w0
), w AS (SELECT * REPLACE (CASE WHEN e - s < 20 THEN greatest(0, e - 20) ELSE s END AS s) FROM w1)"""
#: Every fifth episode is cut by hand to frames 5 to 25.
PLAN = f"{MOTION}, plan AS (SELECT episode_index, n, first, CASE WHEN episode_index % 5 = 0 THEN 5 ELSE s END AS s, CASE WHEN episode_index % 5 = 0 THEN 25 ELSE e END AS e FROM w)"


def overrides(spark, sf_dir):
    return vector_frames(spark, sf_dir).filter("episode_index % 5 = 0").select("episode_index").distinct().withColumns({"start": F.lit(5).cast("long"), "end": F.lit(25).cast("long")})


def plan_of(spark, sf_dir):
    """Written once: frames are ranked for it, and those who use a plan read it more than once."""
    return stash(motion.build_trim_plan(vector_frames(spark, sf_dir), NAMES, CONFIG, overrides(spark, sf_dir)), "plan")


@query(f"WITH {EDGES} SELECT episode_index, n AS frames, joint, round(i, 6) AS initial, round(f, 6) AS final FROM e")
def edge_baseline(spark, sf_dir):
    rows = motion.edge_baseline(vector_frames(spark, sf_dir), K)
    rows = rows.select("episode_index", "frames", F.posexplode(F.arrays_zip("initial", "final")).alias("joint", "b"))
    return rows.select("episode_index", "frames", "joint", F.round("b.initial", 6).alias("initial"), F.round("b.final", 6).alias("final"))


@query(f"""WITH {MOTION} SELECT episode_index, n AS frames, s AS start, e AS stop, coalesce(first, 0) AS start_event, coalesce(last, n) AS final_settle_event, first IS NOT NULL AS start_event_found, last IS NOT NULL AS final_settle_found FROM w""")
def detect_motion_window(spark, sf_dir):
    return motion.detect_motion_window(vector_frames(spark, sf_dir), NAMES, CONFIG).withColumnRenamed("end", "stop")


@query(f"""WITH {PLAN} SELECT p.episode_index, p.s AS start, p.e AS stop, p.e - p.s AS kept_frames, p.s AS removed_start_frames, p.n - p.e AS removed_end_frames, p.episode_index % 5 = 0 AS manual_override, round(v.state[1] + 2 * v.state[2] + 3 * v.state[3] + 4 * v.state[4], 7) AS start_state, round(v.action[1] + 2 * v.action[2] + 3 * v.action[3] + 4 * v.action[4], 7) AS start_action
FROM plan p JOIN vectors v ON v.episode_index = p.episode_index AND v.frame_index = p.s""")
def build_trim_plan(spark, sf_dir):
    found = plan_of(spark, sf_dir).withColumnRenamed("end", "stop")
    return found.select("episode_index", "start", "stop", "kept_frames", "removed_start_frames", "removed_end_frames", "manual_override", *(F.round(sum((F.lit(j + 1) * F.col(c)[j] for j in range(4)), F.lit(0.0)), 7).alias(c) for c in ("start_state", "start_action")))


@query(f"""WITH {PLAN}, k AS (SELECT v.episode_index, v.frame_index AS source_frame_index, v.frame_index - s AS frame_index FROM vectors v JOIN plan p ON v.episode_index = p.episode_index AND v.frame_index >= s AND v.frame_index < e)
SELECT *, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS index, round(frame_index / 30.0::DOUBLE, 6) AS timestamp FROM k""")
def apply_trim(spark, sf_dir):
    found = motion.apply_trim(vector_frames(spark, sf_dir), plan_of(spark, sf_dir))
    return rounded(found, "timestamp").select("episode_index", "source_frame_index", "frame_index", "index", "timestamp")


@query(f"""WITH {PLAN}, st AS (SELECT p.*, v.state FROM plan p JOIN vectors v ON v.episode_index = p.episode_index AND v.frame_index = p.s), c AS (SELECT quantile_cont(state[1], 0.5) AS a, quantile_cont(state[2], 0.5) AS b, quantile_cont(state[4], 0.5) AS d FROM st)
SELECT sum(n)::BIGINT AS input_frames, sum(st.e - s)::BIGINT AS output_frames, (sum(n) - sum(st.e - s))::BIGINT AS removed_frames, round((sum(n) - sum(st.e - s)) / 30.0::DOUBLE, 6) AS removed_seconds,
arg_min(episode_index, (sqrt((state[1] - a) ** 2 + (state[2] - b) ** 2 + (state[4] - d) ** 2), episode_index)) AS representative_start_episode, round(stddev_pop(state[1]) + 2 * stddev_pop(state[2]) + 3 * stddev_pop(state[4]), 6) AS arm_std, false AS requires_staged_start FROM st, c""")
def trim_summary(spark, sf_dir):
    found = motion.trim_summary(plan_of(spark, sf_dir), NAMES, CONFIG)
    found = rounded(found, "removed_seconds").withColumn("arm_std", F.round(sum((F.lit(k + 1) * F.col("arm_start_std")[k] for k in range(3)), F.lit(0.0)), 6))
    return found.drop("arm_start_std")


@query(f"WITH {PLAN} SELECT floor(quantile_cont(first, 0.5) + 0.5)::BIGINT AS preroll FROM plan WHERE first IS NOT NULL")
def reference_preroll(spark, sf_dir):
    plan = plan_of(spark, sf_dir)
    return plan.limit(1).select(F.lit(motion.reference_preroll(plan)).cast("long").alias("preroll"))


SUPPLIERS = "r AS (SELECT s_suppkey AS episode_index, row_number() OVER (ORDER BY md5('42:' || s_suppkey::VARCHAR), s_suppkey) AS k, count(*) OVER () AS n FROM supplier)"
CUT = "CASE WHEN k <= n - 2 * v THEN 'train' WHEN k <= n - v THEN 'val' ELSE 'test' END"


def suppliers(spark, sf_dir):
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("episode_index"))


@query(f"WITH {SUPPLIERS} SELECT episode_index, CASE WHEN k <= 6 - 2 * 1 THEN 'train' WHEN k <= 6 - 1 THEN 'val' ELSE 'test' END AS split FROM r WHERE k <= 6")
def split_of_some(spark, sf_dir):
    """Six episodes at most, split 8:1:1."""
    return splits.split_episodes(suppliers(spark, sf_dir), max_episodes=6)


@query(f"WITH {SUPPLIERS}, c AS (SELECT *, greatest(1, round_even(n * 0.1, 0))::BIGINT AS v FROM r) SELECT episode_index, {CUT} AS split FROM c")
def default_split(spark, sf_dir):
    return splits.default_split(suppliers(spark, sf_dir))


@query(f"WITH c AS (SELECT s_suppkey AS episode_index, row_number() OVER (ORDER BY s_suppkey) AS k, count(*) OVER () AS n, greatest(1, round_even(count(*) OVER () * 0.1, 0))::BIGINT AS v FROM supplier) SELECT episode_index, {CUT} AS split FROM c")
def contiguous_split(spark, sf_dir):
    return splits.contiguous_split(suppliers(spark, sf_dir))


@query(f"WITH {SUPPLIERS} SELECT episode_index FROM r WHERE k <= 7")
def subsample_episodes(spark, sf_dir):
    return splits.subsample_episodes(suppliers(spark, sf_dir), 7)


DEFAULT = f"{SUPPLIERS}, c AS (SELECT *, greatest(1, round_even(n * 0.1, 0))::BIGINT AS v FROM r), s AS (SELECT episode_index, k, {CUT} AS split FROM c)"


@query(f"WITH {DEFAULT}, o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY k) AS i FROM s) SELECT episode_index, split FROM o WHERE i <= 3")
def sample_per_split(spark, sf_dir):
    return splits.sample_per_split(splits.default_split(suppliers(spark, sf_dir)), 3)


@query(f"WITH {DEFAULT}, i AS (SELECT *, episode_index - row_number() OVER (PARTITION BY split ORDER BY episode_index) AS g FROM s) SELECT split, min(episode_index) AS first, max(episode_index) AS last FROM i GROUP BY split, g")
def split_ranges(spark, sf_dir):
    return splits.split_ranges(splits.default_split(suppliers(spark, sf_dir)))


@query(f"WITH {DEFAULT} SELECT episode_index, split FROM s")
def expand_ranges(spark, sf_dir):
    """Ranges of a split, and the split again."""
    return splits.expand_ranges(splits.split_ranges(splits.default_split(suppliers(spark, sf_dir))))


@query("""SELECT s_suppkey AS episode_index, CASE WHEN s_suppkey % 5 = 0 THEN 'unassigned' ELSE 'repeated' END AS problem FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0
UNION ALL SELECT -1, 'unknown'""")
def split_problems(spark, sf_dir):
    """Every fifth supplier left out, every seventh of the others twice, and one that doesn't exist."""
    rows = suppliers(spark, sf_dir)
    some = rows.filter("episode_index % 5 <> 0")
    twice = some.union(some.filter("episode_index % 7 = 0")).union(rows.agg(F.lit(-1).cast("long").alias("episode_index")))
    return splits.split_problems(twice.withColumn("split", F.lit("train")), rows)


@query(f"WITH {FRAMES}, {DEFAULT.replace('WITH ', '')}, f AS (SELECT f.episode_index, CASE WHEN f.episode_index % 4 = 0 THEN 'manual' ELSE split END AS split FROM frames f JOIN s USING (episode_index)) SELECT split, count(*) AS frames FROM f GROUP BY split")
def attach_split(spark, sf_dir):
    """Every fourth episode is given by hand."""
    rows = suppliers(spark, sf_dir)
    split = splits.default_split(rows).filter("episode_index % 4 <> 0")
    found = splits.attach_split(supplier_frames(spark, sf_dir), split, manual=rows.filter("episode_index % 4 = 0"))
    return found.groupBy("split").agg(F.count(F.lit(1)).alias("frames"))


@query(f"WITH {FRAMES} SELECT episode_index, count(*) AS frames FROM frames WHERE episode_index IN (1, 3, 4, 8) GROUP BY episode_index")
def select_episodes(spark, sf_dir):
    rows = splits.select_episodes(supplier_frames(spark, sf_dir), "1,3:5,8", 10)
    return rows.groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"))


@query(f"WITH {FRAMES} SELECT count(*) AS frames FROM frames WHERE episode_index < 5")
def limit_episodes(spark, sf_dir):
    return splits.limit_episodes(supplier_frames(spark, sf_dir), 5).agg(F.count(F.lit(1)).alias("frames"))


@query(f"WITH {COVERAGE} SELECT episode_index, count(*) AS messages FROM messages WHERE episode_index NOT IN (SELECT episode_index FROM covered WHERE severity = 'critical') GROUP BY episode_index")
def filter_by_quality(spark, sf_dir):
    rows = messages(spark, sf_dir)
    report = coverage.worst_severity(coverage.topic_coverage(rows, **LIMITS))
    return splits.filter_by_quality(rows, report).groupBy("episode_index").agg(F.count(F.lit(1)).alias("messages"))


@query("SELECT s_suppkey AS episode_index FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 45)")
def available_episodes(spark, sf_dir):
    recordings = read(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.col("l_suppkey").alias("episode_index"))
    return splits.available_episodes(suppliers(spark, sf_dir), recordings)[0]


@query(f"""WITH {FRAMES}, a AS (SELECT episode_index AS e, 0 AS part, frame_index AS f FROM frames UNION ALL SELECT episode_index, 1, frame_index FROM frames WHERE episode_index % 3 = 0),
k AS (SELECT *, dense_rank() OVER (ORDER BY part, e) - 1 AS episode_index FROM a) SELECT episode_index, count(*) AS frames, min(f) AS first, max(f) AS last FROM k GROUP BY episode_index""")
def merge_datasets(spark, sf_dir):
    """A dataset and, behind it, every third episode of it."""
    rows = vector_frames(spark, sf_dir)
    merged = datasets.merge_datasets([rows, rows.filter("episode_index % 3 = 0")], drop=["state"])
    return merged.groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"), F.min("frame_index").alias("first"), F.max("frame_index").alias("last"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0)")
def append_new_episodes(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return datasets.append_new_episodes(rows, rows.filter("o_orderkey % 2 = 0"), by="o_custkey").select("o_orderkey")


@query(f"""WITH {VECTORS}, x AS (SELECT episode_index, frame_index - (frame_index % 3 = 2)::INTEGER * 0 AS frame_index FROM vectors WHERE frame_index % 11 <> 5), d AS (SELECT *, coalesce(lag(frame_index) OVER (PARTITION BY episode_index ORDER BY frame_index) + 1, 0) AS due FROM x)
SELECT episode_index, count(*) AS frames, count(*) FILTER (frame_index <> due) AS index_skips, 0 AS action_null, count(*) FILTER (frame_index % 13 = 4) AS action_size, count(*) FILTER (frame_index <> due) + count(*) FILTER (frame_index % 13 = 4) = 0 AS valid FROM d GROUP BY episode_index""")
def validate_frames(spark, sf_dir):
    """Every eleventh frame is missing, every thirteenth is short."""
    rows = vector_frames(spark, sf_dir).filter("frame_index % 11 <> 5")
    rows = rows.withColumn("action", F.when(F.col("frame_index") % 13 == 4, F.slice("action", 1, 3)).otherwise(F.col("action")))
    return audit.validate_frames(rows, {"action": 4}).drop("action_not_finite")


@query("""WITH s AS (SELECT event_type AS topic, event_id, epoch(ts)::DOUBLE AS t, '{"own": ' || props || ', "list": [' || props || ', 1], "n": ' || CASE WHEN event_id % 3 = 0 THEN '1.5' WHEN event_id % 3 = 1 THEN '7' ELSE '"x"' END || ', "none": [], "deep": [[true]]}' AS j, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events),
f AS (SELECT topic, event_id, t, unnest(['own', 'own.k', 'list', 'list[0].k', 'n', 'none', 'deep']) AS field, unnest(['object', CASE json_type(j, '$.own.k') WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' ELSE 'int' END, 'List[object]', CASE json_type(j, '$.list[0].k') WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' ELSE 'int' END,
CASE event_id % 3 WHEN 0 THEN 'float' WHEN 1 THEN 'int' ELSE 'str' END, 'List[empty]', 'List[list]']) AS type, unnest([NULL, NULL, 2, NULL, NULL, 0, 1]) AS length FROM s WHERE k <= 5), o AS (SELECT topic, field, type, min(event_id) AS first FROM f GROUP BY ALL)
SELECT topic, field, (SELECT string_agg(type, ' | ' ORDER BY first) FROM o WHERE o.topic = f.topic AND o.field = f.field) AS type, count(*) AS samples, min(length) AS length, round(arg_min(t, event_id), 3) AS first_ts, round(arg_max(t, event_id), 3) AS last_ts FROM f GROUP BY topic, field""")
def message_structure(spark, sf_dir):
    """Events' properties, within an object, in a list, and beside a field whose type changes."""
    number = F.when(F.col("event_id") % 3 == 0, "1.5").when(F.col("event_id") % 3 == 1, "7").otherwise('"x"')
    payload = F.concat(F.lit('{"own": '), "props", F.lit(', "list": ['), "props", F.lit(', 1], "n": '), number, F.lit(', "none": [], "deep": [[true]]}'))
    rows = read(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), F.col("event_id").alias("seq"), payload.alias("payload_json"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("ts"))
    return audit.message_structure(rows).withColumns({c: F.round(c, 3) for c in ("first_ts", "last_ts")})


@query("""WITH n AS (SELECT DISTINCT p_partkey % 500 AS i FROM part), x AS (SELECT i, ((i % 4 = 1)::INT * 2 + (i % 10 = 6)::INT + (i % 5 = 2 AND i % 12 <> 9)::INT + (i % 8 = 5)::INT + (i % 9 = 7)::INT + (i % 6 = 4)::INT + (i % 12 = 9)::INT * 2)::INT AS errors, ((i % 7 = 3)::INT + (i % 7 = 4)::INT * 2 + (i % 11 = 0)::INT)::INT AS warnings FROM n)
SELECT i AS pair_id, CASE WHEN errors > 0 THEN 'error' WHEN warnings > 0 THEN 'pass_with_warnings' ELSE 'pass' END AS status, errors, warnings, i % 10 = 6 AS cameras FROM x""")
def contract_audit(spark, sf_dir):
    """Contracts: every fourth with swapped names, every third with cameras in another order (which is fine), some with a gap
    between slices, an arm without one, odd dimensions or shapes, and without absolute actions."""
    ids = read(spark, sf_dir, "part").select((F.col("p_partkey") % 500).alias("pair_id")).distinct()
    i, text = F.col("pair_id"), lambda *v: F.array(*map(F.lit, v))
    fact = lambda side, kind, v: ids.select("pair_id", F.lit(side).alias("side"), F.lit(kind).alias("kind"), v.alias("names"))
    n, cameras = text("r_a", "l_a"), text("top", "wrist")
    facts = fact("dataset", "action", n).union(fact("dataset", "state", n)).union(fact("processor", "action", n)).union(fact("checkpoint", "action", F.when(i % 4 == 1, F.reverse(n)).otherwise(n)))
    facts = facts.union(fact("runtime", "arms", text("r", "l"))).union(fact("runtime", "joints", F.when(i % 9 == 7, text("a", "b")).otherwise(text("a")))).union(fact("dataset", "cameras", cameras))
    facts = facts.union(fact("checkpoint", "cameras", F.when(i % 3 == 0, F.reverse(cameras)).otherwise(cameras))).union(fact("runtime", "cameras", F.when(i % 10 == 6, text("top")).otherwise(F.reverse(cameras))))
    numbers = ids.select("pair_id", F.lit("action_dim").alias("name"), F.lit(2).alias("value")).union(ids.select("pair_id", F.lit("state_dim"), F.when(i % 8 == 5, 3).otherwise(2)))
    slices = ids.select("pair_id", F.lit("r").alias("arm"), F.lit(0).alias("start"), F.lit(1).alias("end")).union(ids.filter(i % 12 != 9).select("pair_id", F.lit("l"), F.when(i % 5 == 2, 0).otherwise(1), F.lit(2)))
    flag = lambda name, v: ids.select("pair_id", F.lit(name).alias("name"), v.alias("value"))
    flags = flag("use_relative_actions", F.lit(True)).union(flag("relative_enabled", F.lit(True))).union(flag("absolute_enabled", i % 6 != 4)).union(flag("async_prefetch", i % 11 != 0))
    shape = F.when(i % 7 == 3, F.array(F.lit(3), F.lit(240), F.lit(320))).when(i % 7 == 4, F.array(F.lit(3), F.lit(480), F.lit(480))).otherwise(F.array(F.lit(3), F.lit(480), F.lit(640)))
    shapes = ids.select("pair_id", F.lit("dataset").alias("side"), F.lit("top").alias("camera"), F.array(F.lit(3), F.lit(480), F.lit(640)).alias("shape")).union(ids.select("pair_id", F.lit("checkpoint"), F.lit("top"), shape))
    found = audit.contract_audit(facts, numbers=numbers, slices=slices, flags=flags, shapes=shapes)
    return found.select("pair_id", "status", F.size("errors").alias("errors"), F.size("warnings").alias("warnings"), F.exists("errors", lambda e: F.contains(e, F.lit("camera roles"))).alias("cameras"))


@query("""WITH i AS (SELECT user_id % 8 AS r, event_id, ts FROM events WHERE user_id % 8 < 6), n AS (SELECT r, arg_max(event_id, (ts, printf('%012d', event_id))) AS id FROM i GROUP BY r)
SELECT 'cam' || r.r AS role, CASE WHEN id IS NULL THEN 'missing' ELSE 'found' END AS status, printf('%012d', id) AS path, CASE WHEN id IS NOT NULL THEN 2.0::DOUBLE END AS aspect FROM (SELECT unnest(range(8)) AS r) r LEFT JOIN n ON n.r = r.r""")
def latest_image_per_camera(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("r", F.col("user_id") % 8)
    images = rows.filter("r < 6").select(F.concat(F.lit("cam"), F.col("r").cast("string")).alias("role"), F.format_string("%012d", "event_id").alias("path"), F.col("ts").alias("modified"), F.lit(640).alias("width"), F.lit(320).alias("height"))
    roles = spark.range(8).select(F.concat(F.lit("cam"), F.col("id").cast("string")).alias("role"))
    return audit.latest_image_per_camera(images, roles).select("role", "status", "path", "aspect")


@query("""WITH n AS (SELECT s_suppkey AS i, CASE WHEN s_suppkey % 3 = 0 THEN 'left_finger_joint1_' ELSE 'right_joint_' || (s_suppkey % 10 + 1) || '.pos_' END || printf('%06d', s_suppkey) AS name FROM supplier)
SELECT i AS episode_index, i % 3 <> 0 AND i % 10 < 3 AS shoulder, row_number() OVER (ORDER BY (i % 3 = 0), name) - 1 AS position FROM n""")
def joint_masks(spark, sf_dir):
    """Shoulder joints are 1 to 3; finger joints are displayed last."""
    i = F.col("episode_index")
    name = F.when(i % 3 == 0, "left_finger_joint1_").otherwise(F.concat(F.lit("right_joint_"), (i % 10 + 1).cast("string"), F.lit(".pos_")))
    rows = suppliers(spark, sf_dir).select("episode_index", F.concat(name, F.format_string("%06d", i)).alias("name"))
    return joints.display_joint_order(rows).select("episode_index", joints.shoulder_mask(F.col("name")).alias("shoulder"), "position")


@query(f"WITH {MESSAGES} SELECT episode_index, topic, event_id FROM (SELECT *, row_number() OVER (PARTITION BY episode_index, topic ORDER BY us, event_id) AS k FROM messages) WHERE k <= 3")
def first_messages(spark, sf_dir):
    return joints.first_rows(messages(spark, sf_dir), ["episode_index", "topic"], ["us", "event_id"], 3).select("episode_index", "topic", "event_id")


@query("""WITH j AS MATERIALIZED (SELECT l_suppkey AS episode_index, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) - 1 AS frame_index, l_quantity::DOUBLE / 10 AS a FROM lineitem),
st AS (SELECT avg(a) AS m, stddev_pop(a) AS sd, quantile_cont(a, 0.01) AS lo, quantile_cont(a, 0.99) AS hi FROM j)
SELECT episode_index, frame_index, round((a - m) / sd, 5) + 0.0 AS standard, round(2 * (a - lo) / (hi - lo) - 1, 5) + 0.0 AS scaled FROM j, st""")
def normalised_features(spark, sf_dir):
    """The first joint by the statistics of the whole table."""
    rows = vector_frames(spark, sf_dir)
    s = stats_of(rows.select(F.slice("action", 1, 1).alias("action")), "action").select(F.struct("mean", "std", "q01", "q99")).scalar()
    x = F.col("action")[0]
    rows = rows.withColumn("s", s)
    out = {"standard": standardized(x, F.col("s.mean"), F.col("s.std")), "scaled": quantile_scaled(x, F.col("s.q01"), F.col("s.q99"))}
    return rows.select("episode_index", "frame_index", *((F.round(v, 5) + 0.0).alias(c) for c, v in out.items()))


@query(f"WITH {VECTORS} SELECT episode_index, frame_index, round(action[1] + 2 * action[2] + 3 * action[3] + 4 * action[4], 7) AS action, round(state[1] + 2 * state[2] + 3 * state[3] + 4 * state[4], 7) AS state, 2 * frame_index AS twice FROM vectors")
def dataset_round_trip(spark, sf_dir):
    """Frames and features written as a dataset and read back, through steps that drop a column and add one."""
    rows = vector_frames(spark, sf_dir).withColumn("spare", F.lit(1))
    features = datasets.define_features({"right": NAMES[:3], "left": NAMES[3:]})
    steps = [datasets.DropFeatures(["spare"]), datasets.Derive("twice", lambda df: df.withColumn("twice", F.col("frame_index") * 2))]
    kept, features = datasets.run_steps(rows, features, steps)
    root = shared_path(spark, "dataset")
    datasets.write_frames(kept, root)
    datasets.write_metadata(spark, root, features, fps=30)
    back, _ = datasets.read_dataset(spark, root)
    return back.select("episode_index", "frame_index", *(F.round(sum((F.lit(j + 1) * F.col(c)[j] for j in range(4)), F.lit(0.0)), 7).alias(c) for c in ("action", "state")), "twice")


@query(f"{CHUNK_STEPS} SELECT episode_index, frame_index, round(sum((joint + 1) * c), 6) AS digest FROM k WHERE frame_index % 5 = 0 GROUP BY ALL")
def chunk_samples(spark, sf_dir):
    """Chunks of every fifth frame, with their shape checked."""
    cache = datasets.chunk_samples(vector_frames(spark, sf_dir), stride=5, size=4)
    cache = datasets.checked_chunks(cache, ["current_state", "target_chunk"], size=4, width=4)
    return cache.select("episode_index", "frame_index", F.round(chunk_digest(F.col("target_chunk")), 6).alias("digest"))
