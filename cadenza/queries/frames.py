"""Queries on alignment, filling, names and vectors of frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import frames, joints, vectors
from cadenza.queries.base import FRAMES, MESSAGES, NAMES, VECTORS, messages, query, read, rounded, supplier_frames, vector_frames

HOUR = 3_600_000_000


def clicks_and(spark, sf_dir, topic):
    rows = messages(spark, sf_dir)
    left = rows.filter("topic = 'click'").select("event_id", "episode_index", F.col("us").alias("ts"), (F.col("event_id") % 3 == 0).alias("seen"))
    right = rows.filter(F.col("topic") == topic).select("episode_index", F.col("us").alias("ts"), F.col("event_id").alias("value"))
    return left, right


def nearest(at: str, topic: str) -> str:
    return f"""r AS (SELECT episode_index, us, min(event_id) AS id FROM messages WHERE topic = '{topic}' GROUP BY ALL), l AS (SELECT *, {at} AS aim FROM messages WHERE topic = 'click'), pairs AS (
  SELECT l.event_id, r.id, abs(aim - r.us) AS d, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(aim - r.us), r.us) AS k FROM l LEFT JOIN r ON l.episode_index = r.episode_index), n AS (SELECT * FROM pairs WHERE k = 1)"""


@query(f"WITH {MESSAGES}, {nearest('us', 'view')} SELECT event_id, CASE WHEN d <= {6 * HOUR} THEN id END AS nearest_id FROM n")
def nearest_within(spark, sf_dir):
    left, right = clicks_and(spark, sf_dir, "view")
    return frames.nearest_asof(left, right, tolerance=6 * HOUR).select("event_id", F.col("nearest_value").alias("nearest_id"))


@query(f"WITH {MESSAGES}, {nearest(f'us + {20 * HOUR}', 'view')} SELECT event_id, id AS lookahead FROM n")
def lookahead_action(spark, sf_dir):
    """Ten frames at half a frame an hour: twenty hours on."""
    left, right = clicks_and(spark, sf_dir, "view")
    return frames.lookahead_action(left, right, 10, 0.5 / HOUR).select("event_id", "lookahead")


FILL = f"""{MESSAGES}, {nearest('us', 'purchase')}, held AS (
  SELECT l.event_id, arg_max(r.id, r.us) AS id FROM l JOIN r ON l.episode_index = r.episode_index AND r.us <= l.us GROUP BY ALL
), filled AS (SELECT l.event_id, l.episode_index, CASE WHEN n.d <= {12 * HOUR} THEN n.id END AS e, h.id AS h, CASE WHEN l.event_id % 3 = 0 THEN l.event_id END AS o FROM l LEFT JOIN n USING (event_id) LEFT JOIN held h USING (event_id)
), f AS (SELECT event_id, episode_index, coalesce(e, h, o) AS filled, CASE WHEN e IS NOT NULL THEN 'exact' WHEN h IS NOT NULL THEN 'hold_last' WHEN o IS NOT NULL THEN 'fallback_to_observation' ELSE 'dropped' END AS fill_kind FROM filled)"""


def filled(spark, sf_dir):
    left, right = clicks_and(spark, sf_dir, "purchase")
    left = left.withColumn("observation", F.when(F.col("seen"), F.col("event_id")))
    return frames.fill_action(left, right, tolerance=12 * HOUR)


@query(f"WITH {FILL} SELECT event_id, filled, fill_kind FROM f")
def fill_action(spark, sf_dir):
    """The nearest purchase within half a day, else the last one, else every third click's own observation."""
    return filled(spark, sf_dir).select("event_id", "filled", "fill_kind")


@query(f"""WITH {FILL} SELECT episode_index, count(*) FILTER (fill_kind = 'exact') AS "exact", count(*) FILTER (fill_kind = 'hold_last') AS hold_last,
count(*) FILTER (fill_kind = 'fallback_to_observation') AS fallback_to_observation, count(*) FILTER (fill_kind = 'dropped') AS dropped FROM f GROUP BY episode_index""")
def fill_stats(spark, sf_dir):
    return frames.fill_stats(filled(spark, sf_dir), ["episode_index"])


@query(f"WITH {FILL} SELECT episode_index, count(*) AS frames FROM f WHERE filled IS NOT NULL GROUP BY episode_index")
def complete_frames(spark, sf_dir):
    return frames.complete_frames(filled(spark, sf_dir), ["filled"]).groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"))


@query(f"""WITH {MESSAGES}, a AS (SELECT event_id, episode_index, us, [event_id, 1] AS v FROM messages WHERE topic = 'click'), r AS (SELECT episode_index, us, min(event_id) AS id FROM messages WHERE topic = 'view' GROUP BY ALL),
p AS (SELECT a.event_id, a.v, r.id, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.us - r.us), r.us) AS k FROM a LEFT JOIN r ON a.episode_index = r.episode_index)
SELECT event_id, CASE WHEN id IS NULL THEN concat_ws(',', v[1], v[2]) ELSE concat_ws(',', v[1], v[2], id) END AS merged FROM p WHERE k = 1""")
def merge_arms(spark, sf_dir):
    rows = messages(spark, sf_dir)
    arm = lambda topic, *v: rows.filter(F.col("topic") == topic).select("event_id", "episode_index", F.col("us").alias("ts"), F.array(*v).alias("value"))
    first = arm("click", F.col("event_id"), F.lit(1).cast("long"))
    merged = frames.merge_arms(first, [arm("view", F.col("event_id"), F.lit(2).cast("long")).drop("event_id")], width=3)
    return merged.select("event_id", F.array_join(F.transform("value", lambda x: x.cast("string")), ",").alias("merged"))


@query(f"""WITH {MESSAGES}, f AS (SELECT episode_index, topic, arg_min(us, event_id) AS t FROM messages GROUP BY ALL), o AS (SELECT episode_index, min(t) AS t FROM f GROUP BY ALL)
SELECT event_id, us - t AS rel FROM messages JOIN o USING (episode_index)""")
def relative_time(spark, sf_dir):
    return frames.relative_time(messages(spark, sf_dir), ts="us", seq="event_id").select("event_id", "rel")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN epoch_us(ts) * 1000 ELSE user_id * 1000000000 + event_id END AS ts_ns FROM events""")
def resolve_timestamp(spark, sf_dir):
    """Every fourth event has no header and falls back to its log time."""
    stamped = F.when(F.col("event_id") % 4 != 0, F.col("episode_index"))
    rows = messages(spark, sf_dir).select("event_id", (F.col("us") * 1000).alias("log_time_ns"), stamped.alias("header_sec"), F.col("event_id").alias("header_nanosec"))
    return frames.resolve_timestamp(rows).select("event_id", "ts_ns")


RUNS = f"""WITH RECURSIVE {MESSAGES}, s AS (SELECT episode_index, event_id, us, row_number() OVER (PARTITION BY episode_index ORDER BY us, event_id) AS i, min(us) OVER (PARTITION BY episode_index) AS t0 FROM messages),
g AS (SELECT episode_index, event_id, i, 1::BIGINT AS taken, true AS emit, t0 FROM s WHERE i = 1 UNION ALL
  SELECT s.episode_index, s.event_id, s.i, g.taken + CASE WHEN s.us - g.t0 >= g.taken * {24 * HOUR} THEN 1 ELSE 0 END, s.us - g.t0 >= g.taken * {24 * HOUR}, g.t0 FROM g JOIN s ON s.episode_index = g.episode_index AND s.i = g.i + 1)"""


@query(f"{RUNS} SELECT event_id FROM g WHERE emit")
def subsample(spark, sf_dir):
    """At most one event a day and user, greedily; the twin walks through them one by one."""
    rows = messages(spark, sf_dir).withColumnRenamed("event_id", "frame_index")
    return frames.subsample(rows, "us", 1 / (24 * HOUR)).select(F.col("frame_index").alias("event_id"))


@query(f"""WITH {MESSAGES}, s AS (SELECT episode_index, event_id, ts, row_number() OVER w - 1 AS i, ts - lag(ts) OVER w AS dt, count(*) OVER (PARTITION BY episode_index) AS n FROM messages WINDOW w AS (PARTITION BY episode_index ORDER BY ts, event_id)),
m AS (SELECT episode_index, list_sort(list(dt) FILTER (i BETWEEN 1 AND 20)) AS e, any_value(n) AS n FROM s GROUP BY episode_index),
k AS (SELECT episode_index, greatest(1, CASE WHEN n >= 4 AND e[len(e) // 2 + 1] > 0 THEN round_even(1 / e[len(e) // 2 + 1] / 1e-5, 0)::INTEGER ELSE 1 END) AS stride FROM m)
SELECT event_id FROM s JOIN k USING (episode_index) WHERE i % stride = 0""")
def stride_downsample(spark, sf_dir):
    rows = messages(spark, sf_dir).withColumnRenamed("event_id", "frame_index")
    return frames.stride_downsample(rows, "ts", 1e-5).select(F.col("frame_index").alias("event_id"))


@query(f"WITH {FRAMES}, s AS (SELECT * FROM frames WHERE episode_index % 2 = 1) SELECT episode_index, frame_index, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS relative_index FROM s")
def relative_index(spark, sf_dir):
    rows = supplier_frames(spark, sf_dir).select("episode_index", "frame_index")
    return frames.relative_index(rows, rows.select("episode_index").filter("episode_index % 2 = 1").distinct())


@query(f"WITH {FRAMES} SELECT episode_index, count(*) AS frames FROM frames WHERE frame_index % 7 = 0 GROUP BY episode_index")
def stride_samples(spark, sf_dir):
    return frames.stride_samples(supplier_frames(spark, sf_dir), 7).groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"))


PARTS = """part_names AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'follower_l_joint' WHEN 1 THEN 'follower_r_joint' WHEN 2 THEN 'leader_r_finger_joint' WHEN 3 THEN 'follower_x_joint' ELSE 'other_joint' END || p_partkey AS name FROM part)"""
ROLES, ARMS = {"follower": "observation", "leader": "action"}, {"l": "left", "r": "right"}


def part_names(spark, sf_dir):
    kinds = ("follower_l_joint", "follower_r_joint", "leader_r_finger_joint", "follower_x_joint", "other_joint")
    stem = F.element_at(F.array(*map(F.lit, kinds)), (F.col("p_partkey") % 5 + 1).cast("int"))
    return read(spark, sf_dir, "part").select("p_partkey", F.concat(stem, F.col("p_partkey").cast("string")).alias("name"))


@query(f"""WITH {PARTS} SELECT p_partkey, CASE WHEN name LIKE 'follower_x%' THEN NULL WHEN name LIKE 'follower%' THEN 'observation' WHEN name LIKE 'leader%' THEN 'action' END AS role,
CASE WHEN name LIKE 'follower_x%' THEN NULL WHEN name LIKE '%\\_l\\_%' ESCAPE '\\' THEN 'left' WHEN name LIKE '%\\_r\\_%' ESCAPE '\\' THEN 'right' ELSE '' END AS robot,
CASE WHEN name LIKE 'follower_x%' THEN NULL WHEN name LIKE 'other%' THEN NULL ELSE regexp_replace(name, '^(follower|leader)_[lr]_', '') END AS joint_id FROM part_names""")
def parse_joint_name(spark, sf_dir):
    return part_names(spark, sf_dir).select("p_partkey", joints.parse_joint_name(F.col("name"), ROLES, ARMS).alias("k")).select("p_partkey", "k.role", "k.robot", "k.joint_id")


MESSAGE_JOINTS = """j AS (SELECT l_suppkey AS episode_index, l_orderkey AS ts, CASE WHEN l_linenumber % 2 = 0 THEN 'left' ELSE 'right' END AS robot, 'joint' || l_linenumber AS id, max(l_quantity)::DOUBLE AS p FROM lineitem GROUP BY ALL)"""


@query(f"""WITH {MESSAGE_JOINTS} SELECT episode_index, ts, 'observation' AS role, robot, string_agg(id, ',' ORDER BY id) AS joint_ids, round(sum(p), 6) AS total FROM j GROUP BY ALL""")
def group_joints(spark, sf_dir):
    """An order's lines with one supplier as the joints of a message."""
    side = F.when(F.col("l_linenumber") % 2 == 0, "l").otherwise("r")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("episode_index"), F.col("l_orderkey").alias("ts"), F.concat(F.lit("follower_"), side, F.lit("_joint"), F.col("l_linenumber").cast("string")).alias("name"), F.col("l_quantity").cast("double").alias("p"))
    rows = rows.groupBy("episode_index", "ts", "name").agg(F.max("p").alias("p")).groupBy("episode_index", "ts").agg(F.collect_list(F.struct("name", "p")).alias("s"))
    rows = rows.select("episode_index", "ts", F.transform("s", lambda x: x["name"]).alias("name"), F.transform("s", lambda x: x["p"]).alias("position"), F.array(F.lit(1.0)).alias("velocity"), F.array().cast("array<double>").alias("effort"))
    found = joints.group_joints(rows, ROLES, ARMS)
    return found.select("episode_index", "ts", "role", "robot", F.array_join("joint_ids", ",").alias("joint_ids"), F.round(vectors.total(F.col("pos")), 6).alias("total"))


@query(f"""WITH {MESSAGE_JOINTS}, arms AS (SELECT episode_index, ts, robot, sum(p) AS p FROM j GROUP BY ALL) SELECT episode_index, ts AS frame_index, concat_ws(',', max(p) FILTER (robot = 'left')::BIGINT, max(p) FILTER (robot = 'right')::BIGINT) AS observation
FROM arms GROUP BY ALL HAVING count(*) = 2""")
def concat_arms(spark, sf_dir):
    """Orders with lines of both parities."""
    robot = F.when(F.col("l_linenumber") % 2 == 0, "left").otherwise("right")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("episode_index"), F.col("l_orderkey").alias("frame_index"), robot.alias("robot"), "l_linenumber", F.col("l_quantity").cast("double").alias("p"))
    rows = rows.groupBy("episode_index", "frame_index", "robot", "l_linenumber").agg(F.max("p").alias("p")).groupBy("episode_index", "frame_index", "robot").agg(F.array(F.sum("p")).alias("observation"))
    found = joints.concat_arms(rows, ["left", "right"], ["observation"])
    return found.select("episode_index", "frame_index", F.array_join(F.transform("observation", lambda x: x.cast("long").cast("string")), ",").alias("observation"))


@query(f"WITH {VECTORS} SELECT episode_index, frame_index, round(action[4], 6) AS first, round(action[3], 6) AS last FROM vectors")
def reorder_command(spark, sf_dir):
    """The command's order is that of NAMES; sorted, the left joint comes first and the second right joint last but one."""
    v = joints.reorder_command(F.col("action"), ["b", "c", "d", "a"])
    return vector_frames(spark, sf_dir).select("episode_index", "frame_index", F.round(v[0], 6).alias("first"), F.round(v[3], 6).alias("last"))


@query(f"WITH {VECTORS} SELECT episode_index, frame_index, round(action[4], 6) AS first, round(action[1], 6) AS last FROM vectors")
def reorder_joints(spark, sf_dir):
    v = joints.reorder_joints(F.col("action"), NAMES, NAMES[::-1])
    return vector_frames(spark, sf_dir).select("episode_index", "frame_index", F.round(v[0], 6).alias("first"), F.round(v[3], 6).alias("last"))


@query("""WITH d AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '/usb_cam_' || p_partkey || '/image_raw/compressed' WHEN 1 THEN '/camera/image_raw' WHEN 2 THEN '/wrist_' || p_partkey || '/image' WHEN 3 THEN '/image' WHEN 4 THEN '/a/b' || p_partkey ELSE '/x/compressed' END AS t FROM part)
SELECT p_partkey, coalesce(nullif(rtrim(replace(CASE WHEN t LIKE '%image_raw/compressed' THEN t[2:-21] WHEN t LIKE '%image_raw' THEN t[2:-10] WHEN t LIKE '%compressed' THEN t[2:-11] WHEN t LIKE '%image' THEN t[2:-6] ELSE t[2:] END, '/', '_'), '_'), ''), 'camera') AS camera FROM d""")
def camera_name(spark, sf_dir):
    k, text = F.col("p_partkey") % 6, F.col("p_partkey").cast("string")
    topic = F.when(k == 0, F.concat(F.lit("/usb_cam_"), text, F.lit("/image_raw/compressed"))).when(k == 1, "/camera/image_raw").when(k == 2, F.concat(F.lit("/wrist_"), text, F.lit("/image"))).when(k == 3, "/image")
    topic = topic.when(k == 4, F.concat(F.lit("/a/b"), text)).otherwise("/x/compressed")
    return read(spark, sf_dir, "part").select("p_partkey", joints.camera_name(topic).alias("camera"))


@query("""WITH g AS (SELECT event_id, 100 + event_id % 1900 AS w, 100 + user_id * 7 % 1000 AS h FROM events), s AS (SELECT *, least(640.0::DOUBLE / w, 480.0::DOUBLE / h) AS scale FROM g), n AS (SELECT *, floor(w * scale)::INTEGER AS nw, floor(h * scale)::INTEGER AS nh FROM s)
SELECT event_id, nw AS new_width, nh AS new_height, (640 - nw) // 2 AS offset_x, (480 - nh) // 2 AS offset_y, round(1 - nw * nh / 307200.0::DOUBLE, 9) AS wasted FROM n""")
def letterbox(spark, sf_dir):
    g = joints.letterbox_geometry(100 + F.col("event_id") % 1900, 100 + F.col("episode_index") * 7 % 1000, 640, 480)
    return messages(spark, sf_dir).select("event_id", g.alias("g")).select("event_id", "g.new_width", "g.new_height", "g.offset_x", "g.offset_y", F.round("g.wasted", 9).alias("wasted"))


@query(f"""WITH {VECTORS} SELECT episode_index, count(*) AS "rows", round(avg(CASE WHEN frame_index % 5 > 0 AND frame_index % 7 > 0 THEN 1 ELSE 0 END), 6) AS accepted FROM vectors GROUP BY episode_index""")
def acceptance(spark, sf_dir):
    """Every fifth vector is short, and every seventh has a value that isn't finite."""
    v = F.when(F.col("frame_index") % 5 == 0, F.slice("action", 1, 3)).when(F.col("frame_index") % 7 == 0, F.transform("action", lambda x: F.lit(float("inf")))).otherwise(F.col("action"))
    return rounded(joints.acceptance(vector_frames(spark, sf_dir), vectors.rejection(v, 4), ["episode_index"]), "accepted")


@query(f"""WITH {VECTORS} SELECT episode_index, frame_index, round(greatest(-1, least(1, 2 * action[1] / 4 - 1)), 6) AS a, round(action[3], 6) AS b, round(5 + greatest(0, least(1, (action[1] - 1) / 2)) * 10, 6) AS gripper FROM vectors""")
def normalized(spark, sf_dir):
    v = vectors.normalize_from_limits(F.col("action"), [(0, 4), (0, 1), None, None])
    return vector_frames(spark, sf_dir).select("episode_index", "frame_index", F.round(v[0], 6).alias("a"), F.round(v[2], 6).alias("b"), F.round(vectors.remap_gripper(F.col("action")[0], 1, 3, 5, 15), 6).alias("gripper"))


@query(f"""WITH {VECTORS} SELECT episode_index, frame_index, round(greatest(0, least(5, action[1] + greatest(-0.5, least(0.5, state[1] - 1)))), 6) AS first, round(greatest(0, least(1, action[3])), 6) AS gripper FROM vectors""")
def corrected(spark, sf_dir):
    ranges = [(0, 5), (0, 1), (0, 1), (0, 100)]
    bounds = vectors.residual_bounds(ranges, 0.5, 0.25, [2])
    v = vectors.corrected(F.col("action"), F.transform("state", lambda x: x - 1), bounds, ranges)
    return vector_frames(spark, sf_dir).select("episode_index", "frame_index", F.round(v[0], 6).alias("first"), F.round(v[2], 6).alias("gripper"))


@query("""WITH t AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id * 1000000000 ELSE event_id END AS x FROM events), s AS (SELECT event_id, CASE WHEN abs(x) > 1000000 THEN x / 1e9 ELSE x END::DOUBLE AS s FROM t)
SELECT event_id, round(s, 6) AS seconds, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%dm %.1fs', floor(s / 60)::INTEGER, s % 60) ELSE printf('%dh %dm %.0fs', floor(s / 3600)::INTEGER, floor((s % 3600) / 60)::INTEGER, s % 60) END AS text FROM s""")
def durations(spark, sf_dir):
    x = F.when(F.col("event_id") % 2 == 0, F.col("event_id") * 1_000_000_000).otherwise(F.col("event_id"))
    s = vectors.to_seconds(x)
    return messages(spark, sf_dir).select("event_id", F.round(s, 6).alias("seconds"), vectors.duration_text(s).alias("text"))
