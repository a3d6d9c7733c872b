"""Queries on predictions: errors, baselines, latencies, gates, chunks of actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import deltas, metrics
from cadenza.operators.frames import assign_chunks
from cadenza.queries.base import CHUNK_STEPS, PREDICTIONS, VECTORS, chunk_digest, predictions, query, read, rounded, vector_frames

MOST, SHOULDERS = 0.5, [0, 1, 2]
ERRORS = f"{PREDICTIONS}, je AS (SELECT episode_index, split_label, joint, avg((p - t) ** 2) AS mse, avg(abs(p - t)) AS mae FROM pj GROUP BY ALL)"
EPISODES = f"""{PREDICTIONS}, f AS (SELECT episode_index, split_label, frame_index, sum(p * t) AS d, sqrt(sum(p * p)) * sqrt(sum(t * t)) AS n FROM pj GROUP BY ALL),
c AS (SELECT episode_index, split_label, avg(CASE WHEN n > 1e-8 THEN d / n ELSE 0 END) AS cosine FROM f GROUP BY ALL), w AS (SELECT episode_index, avg((p - t) ** 2) AS mse, avg(abs(p - t)) AS mae FROM pj GROUP BY ALL),
ep AS (SELECT c.*, mse, mae, sqrt(mse) AS rmse FROM c JOIN w USING (episode_index))"""


def splits_of(rows):
    return rows.select("episode_index", "split_label").distinct()


@query(f"WITH {ERRORS} SELECT episode_index, joint, round(mse, 6) AS mse, round(mae, 6) AS mae, round(sqrt(mse), 6) AS rmse FROM je")
def joint_errors(spark, sf_dir):
    return rounded(metrics.joint_errors(predictions(spark, sf_dir)), "mse", "mae", "rmse")


FOUR = ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std" for c in ("mse", "mae", "rmse", "cosine"))


@query(f"WITH {EPISODES} SELECT split_label, count(*) AS episodes, {FOUR} FROM ep GROUP BY split_label")
def split_summary(spark, sf_dir):
    return rounded(metrics.split_summary(metrics.episode_metrics(predictions(spark, sf_dir))), *(f"{c}_{k}" for c in ("mse", "mae", "rmse", "cosine") for k in ("mean", "std")))


@query(f"WITH {ERRORS} SELECT split_label, joint, round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std FROM je GROUP BY split_label, joint")
def joint_summary(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    return rounded(metrics.joint_summary(metrics.joint_errors(rows), splits_of(rows)), "mae_mean", "mae_std")


@query(f"WITH {EPISODES} SELECT coalesce(split_label, 'overall') AS split_label, count(*) AS episodes, {', '.join(f'round(avg({c}), 6) AS {c}_mean' for c in ('mse', 'mae', 'rmse', 'cosine'))} FROM ep GROUP BY GROUPING SETS ((), (split_label))")
def metrics_rollup(spark, sf_dir):
    return rounded(metrics.metrics_rollup(metrics.episode_metrics(predictions(spark, sf_dir))), *(f"{c}_mean" for c in ("mse", "mae", "rmse", "cosine")))


@query(f"WITH {ERRORS} SELECT split_label, joint, " + ", ".join(f"round(quantile_cont(mae, {q}), 6) AS {n}" for n, q in (("low", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1))) + " FROM je GROUP BY split_label, joint")
def box_stats(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    return rounded(metrics.box_stats(metrics.joint_errors(rows), splits_of(rows)), "low", "q1", "median", "q3", "high")


SANITY = f"""{PREDICTIONS}, s AS (SELECT *, abs(p - t) AS model, abs(h - t) AS hold, abs(o + greatest(-{MOST}, least({MOST}, p - o)) - t) AS limited, p - h AS moved, t - h AS target, abs(p - o) > {MOST} AS clamped FROM pj)"""
COLUMNS = """round(avg(model), 6) AS model_mae, round(avg(hold), 6) AS hold_mae, round(avg(limited), 6) AS limited_mae, avg(model) < avg(hold) AS model_beats_hold,
round(avg(model) FILTER (joint < 3), 6) AS shoulder_model_mae, round(avg(hold) FILTER (joint < 3), 6) AS shoulder_hold_mae, avg(model) FILTER (joint < 3) < avg(hold) FILTER (joint < 3) AS shoulders_beat_hold,
round(avg((sign(moved) = sign(target))::INTEGER) FILTER (abs(target) > 1e-4), 6) AS direction, round(avg((sign(moved) = sign(target))::INTEGER) FILTER (abs(target) > 1e-4 AND joint < 3), 6) AS shoulder_direction,
round(avg(clamped::INTEGER), 6) AS clamp_element_rate"""
ROUNDED = ["model_mae", "hold_mae", "limited_mae", "shoulder_model_mae", "shoulder_hold_mae", "direction", "shoulder_direction", "clamp_element_rate", "clamp_frame_rate"]


@query(f"""WITH {SANITY}, a AS (SELECT episode_index, {COLUMNS} FROM s GROUP BY episode_index), f AS (SELECT episode_index, frame_index, chunk_id, bool_or(clamped) AS c, avg(model) AS m FROM s GROUP BY ALL),
e AS (SELECT *, coalesce(lead(chunk_id) OVER (PARTITION BY episode_index ORDER BY frame_index) <> chunk_id, true) AS last FROM f), g AS (SELECT episode_index, round(avg(c::INTEGER), 6) AS clamp_frame_rate, round(avg(m) FILTER (last), 6) AS endpoint_mae FROM e GROUP BY episode_index)
SELECT * FROM a JOIN g USING (episode_index)""")
def baseline_sanity(spark, sf_dir):
    return rounded(metrics.baseline_sanity(predictions(spark, sf_dir), MOST, SHOULDERS), *ROUNDED, "endpoint_mae")


@query(f"""WITH {SANITY} SELECT episode_index, joint, round(avg(model), 6) AS model_mae, round(avg(hold), 6) AS hold_mae, round(avg(limited), 6) AS limited_mae,
round(CASE WHEN stddev_pop(moved) >= 1e-8 AND stddev_pop(target) >= 1e-8 THEN corr(moved, target) END, 6) AS correlation, round(avg((sign(moved) = sign(target))::INTEGER) FILTER (abs(target) > 1e-4), 6) AS direction, round(avg(clamped::INTEGER), 6) AS clamp_rate
FROM s GROUP BY episode_index, joint""")
def joint_sanity(spark, sf_dir):
    return rounded(metrics.joint_sanity(predictions(spark, sf_dir), MOST), "model_mae", "hold_mae", "limited_mae", "correlation", "direction", "clamp_rate")


@query(f"""WITH {SANITY}, a AS (SELECT coalesce(split_label, 'overall') AS split_label, count(DISTINCT episode_index) AS episodes, {COLUMNS} FROM s GROUP BY GROUPING SETS ((), (split_label))),
f AS (SELECT split_label, episode_index, frame_index, bool_or(clamped)::INTEGER AS c FROM s GROUP BY ALL), g AS (SELECT coalesce(split_label, 'overall') AS split_label, count(*) AS frames, round(avg(c), 6) AS clamp_frame_rate FROM f GROUP BY GROUPING SETS ((), (split_label)))
SELECT * FROM a JOIN g USING (split_label)""")
def sanity_rollup(spark, sf_dir):
    return rounded(metrics.sanity_rollup(predictions(spark, sf_dir), MOST, SHOULDERS), *ROUNDED)


def latencies(spark, sf_dir):
    """Events' values as milliseconds of the stage that their type names."""
    return read(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), (F.col("value") / 1000).alias("seconds"))


LATENCY = "SELECT event_type AS stage, count(value) AS n, avg(value / 1000 * 1000) AS mean_ms, " + ", ".join(f"quantile_cont(value / 1000 * 1000, {q}) AS p{p}_ms" for p, q in ((50, 0.5), (95, 0.95), (99, 0.99))) + " FROM events GROUP BY event_type"


@query(f"WITH l AS ({LATENCY}) SELECT stage, n, round(mean_ms, 6) AS mean_ms, round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms, round(p99_ms, 6) AS p99_ms, ceil(p95_ms * 30 / 1000)::BIGINT AS delay_steps FROM l")
def latency_summary(spark, sf_dir):
    return rounded(metrics.latency_summary(latencies(spark, sf_dir)), "mean_ms", "p50_ms", "p95_ms", "p99_ms")


@query(f"""WITH {SANITY}, l AS ({LATENCY}), p AS (SELECT min(p95_ms) AS ms FROM l), g AS (SELECT split_label, avg(model) < avg(hold) AS b, avg(model) FILTER (joint < 3) < avg(hold) FILTER (joint < 3) AS sb, avg(clamped::INTEGER) AS c FROM s GROUP BY split_label),
f AS (SELECT split_label, b, sb, concat_ws(',', CASE WHEN NOT b THEN 'policy_beats_hold' END, CASE WHEN NOT sb THEN 'shoulders_beat_hold' END, CASE WHEN ms > 1000 * 10.0 / 30 THEN 'p95_within_refill_budget' END, CASE WHEN c >= 0.05 THEN 'few_clamped' END) AS failed FROM g, p)
SELECT split_label, failed, CASE WHEN failed = '' THEN 'GO' ELSE 'NO_GO' END AS decision, NOT (b AND sb) AS retraining_recommended FROM f""")
def gate_decision(spark, sf_dir):
    p95 = metrics.latency_summary(latencies(spark, sf_dir)).agg(F.min("p95_ms")).scalar()
    rows = metrics.sanity_rollup(predictions(spark, sf_dir), MOST, SHOULDERS).filter("split_label <> 'overall'")
    rows = rows.withColumns({"p95_ms": p95, "contract_errors": F.lit(0), "starved_steps": F.lit(0)})
    return metrics.gate_decision(rows).select("split_label", F.array_join("failed_gates", ",").alias("failed"), "decision", "retraining_recommended")


def means(rows, column):
    """Per episode and joint the mean and the largest of an array column."""
    x = rows.select("episode_index", F.posexplode(column).alias("joint", "x"))
    found = x.groupBy("episode_index", "joint").agg(F.avg("x").alias("mean"), F.max("x").alias("most"))
    return found.withColumns({c: F.round(c, 9) + 0.0 for c in ("mean", "most")})


MEANS = "SELECT episode_index, joint, round(avg(x), 9) + 0.0 AS mean, round(max(x), 9) + 0.0 AS most FROM x GROUP BY episode_index, joint"
CHUNKED = f"{VECTORS}, j AS (SELECT *, frame_index // 30 AS chunk_id FROM joints)"


@query(f"WITH {VECTORS}, x AS (SELECT episode_index, joint, CASE WHEN joint = 2 THEN a ELSE a - s END AS x FROM joints) {MEANS}")
def delta_obs_t(spark, sf_dir):
    return means(deltas.delta_obs_t(vector_frames(spark, sf_dir), excluded=[2]), "delta")


@query(f"WITH {CHUNKED}, x AS (SELECT episode_index, joint, CASE WHEN joint = 2 THEN a ELSE a - coalesce(lag(a) OVER (PARTITION BY episode_index, chunk_id, joint ORDER BY frame_index), s) END AS x FROM j) {MEANS}")
def delta_sequential(spark, sf_dir):
    rows = assign_chunks(vector_frames(spark, sf_dir), 30, "state")
    return means(deltas.delta_sequential(rows, excluded=[2]), "delta")


@query(f"WITH {VECTORS}, x AS (SELECT episode_index, joint, a AS x FROM joints) {MEANS}")
def restore_delta(spark, sf_dir):
    """Deltas in chunks, restored: the actions themselves again."""
    rows = deltas.delta_sequential(assign_chunks(vector_frames(spark, sf_dir), 30, "state"), excluded=[2])
    return means(deltas.restore_delta(rows, "delta_sequential", excluded=[2]), "restored")


@query(f"WITH {VECTORS}, x AS (SELECT episode_index, joint, a - coalesce(lag(a) OVER (PARTITION BY episode_index, joint ORDER BY frame_index), s) AS x FROM joints) {MEANS}")
def delta_command(spark, sf_dir):
    return means(deltas.delta_command(vector_frames(spark, sf_dir).withColumnRenamed("action", "command")), "delta")


STEPS = ", ".join(f"lead(a, {k}) OVER w - s" for k in range(3))


@query(f"""WITH {VECTORS}, d AS (SELECT joint, unnest([{STEPS}]) AS x FROM joints WINDOW w AS (PARTITION BY episode_index, joint ORDER BY frame_index)), u AS (SELECT joint, x FROM d WHERE x IS NOT NULL AND joint <> 2 UNION ALL SELECT joint, a FROM joints WHERE joint = 2)
SELECT joint, count(*) AS count, round(avg(x), 6) AS mean, round(greatest(stddev_pop(x), 1e-6), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max FROM u GROUP BY joint""")
def delta_action_stats(spark, sf_dir):
    return rounded(deltas.delta_action_stats(vector_frames(spark, sf_dir), n_steps=3, excluded=[2]), "mean", "std", "min", "max")


@query(f"{CHUNK_STEPS} SELECT episode_index, frame_index, round(sum((joint + 1) * c), 6) AS digest FROM k GROUP BY ALL")
def target_chunk(spark, sf_dir):
    rows = deltas.target_chunk(vector_frames(spark, sf_dir), 4)
    return rows.select("episode_index", "frame_index", F.round(chunk_digest(F.col("chunk")), 6).alias("digest"))


@query(f"{CHUNK_STEPS} SELECT episode_index, frame_index, round(sum((joint + 1) * (c - CASE WHEN joint IN (0, 3) THEN 10 * s ELSE 0 END)), 7) + 0.0 AS digest FROM k GROUP BY ALL")
def relative_chunk(spark, sf_dir):
    rows = deltas.target_chunk(vector_frames(spark, sf_dir), 4)
    chunk = deltas.relative_chunk(F.col("chunk"), F.col("state"), [True, False, False, True])
    return rows.select("episode_index", "frame_index", (F.round(chunk_digest(chunk), 7) + 0.0).alias("digest"))


@query(f"WITH {VECTORS}, x AS (SELECT episode_index, joint, s + greatest(-1, least(1, a - s)) AS x FROM joints) {MEANS}")
def limit_delta(spark, sf_dir):
    rows = vector_frames(spark, sf_dir).withColumn("l", deltas.limit_delta(F.col("action"), F.col("state"), 1.0))
    return means(rows.withColumn("limited", F.col("l.limited")), "limited")


@query(f"""WITH RECURSIVE {VECTORS}, g AS (SELECT episode_index, joint, frame_index, a AS published FROM joints WHERE frame_index = 0 UNION ALL
SELECT j.episode_index, j.joint, j.frame_index, CASE WHEN abs(j.a - g.published) >= 1.5 THEN j.a ELSE g.published END FROM g JOIN joints j ON j.episode_index = g.episode_index AND j.joint = g.joint AND j.frame_index = g.frame_index + 1)
SELECT episode_index, joint, round(avg(published), 4) AS mean, count(DISTINCT published) AS levels FROM g GROUP BY episode_index, joint""")
def deadband(spark, sf_dir):
    rows = deltas.deadband(vector_frames(spark, sf_dir), 1.5)
    return rows.groupBy("episode_index", "joint").agg(F.round(F.avg("published"), 4).alias("mean"), F.count_distinct("published").alias("levels"))


@query(f"""WITH {VECTORS}, d AS (SELECT episode_index, frame_index, a - lag(a) OVER (PARTITION BY episode_index, joint ORDER BY frame_index) AS d FROM joints), s AS (SELECT episode_index, frame_index, sqrt(sum(d * d)) AS step FROM d GROUP BY ALL),
c AS (SELECT *, abs(step - lag(step) OVER (PARTITION BY episode_index ORDER BY frame_index)) AS ch FROM s), r AS (SELECT episode_index, frame_index, count(step) OVER w AS n, avg(step) OVER w AS m, stddev_pop(step) OVER w AS sd, max(step) OVER w AS mx, avg(ch) OVER w AS cm, max(ch) OVER w AS cx, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) AS step_count FROM c WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index ROWS 99 PRECEDING))
SELECT episode_index, frame_index, round(m, 6) AS step_mean, round(sd, 5) AS step_std, round(mx, 6) AS step_max, round(cm, 6) AS change_mean, round(cx, 6) AS change_max, step_count FROM r WHERE n >= 2""")
def smoothness(spark, sf_dir):
    rows = deltas.smoothness(vector_frames(spark, sf_dir)).filter("step_mean IS NOT NULL")
    return rounded(rows, "step_mean", "step_max", "change_mean", "change_max").select("episode_index", "frame_index", "step_mean", F.round("step_std", 5).alias("step_std"), "step_max", "change_mean", "change_max", "step_count")


@query(f"WITH {VECTORS} SELECT episode_index, frame_index, round(lag(a) OVER (PARTITION BY episode_index ORDER BY frame_index), 6) AS first, CASE WHEN frame_index > 0 THEN 0.0::DOUBLE END AS lacking FROM joints WHERE joint = 0")
def synthesize_commands(spark, sf_dir):
    rows = vector_frames(spark, sf_dir).withColumn("joints", F.create_map(F.lit("a"), F.col("action")[0], F.lit("b"), F.col("action")[1]))
    return deltas.synthesize_commands(rows, ["a", "z"]).select("episode_index", "frame_index", F.round(F.col("command")[0], 6).alias("first"), F.col("command")[1].alias("lacking"))


@query(f"WITH {PREDICTIONS}, x AS (SELECT episode_index, joint, t - coalesce(lag(t) OVER (PARTITION BY episode_index, joint ORDER BY frame_index), o) AS x FROM pj) {MEANS}")
def delta_ground_truth(spark, sf_dir):
    return means(deltas.delta_ground_truth(predictions(spark, sf_dir), "delta_sequential"), "raw_truth")


@query(f"WITH {PREDICTIONS}, x AS (SELECT episode_index, joint, t - (p - o) AS x FROM pj) {MEANS}")
def recorded_ground_truth(spark, sf_dir):
    """The fourth quarter stands in for the raw output."""
    rows = predictions(spark, sf_dir).withColumnRenamed("observed", "raw_output")
    return means(deltas.recorded_ground_truth(rows, "delta_obs_t"), "raw_truth")


def chunks(spark, sf_dir):
    """(episode_index, frame_index, split, current, target, bridge, adapter, hold): two steps of eight joints each."""
    rows = predictions(spark, sf_dir)
    two = lambda c: F.transform(F.array(F.slice(c, 1, 8), F.slice(c, 9, 8)), lambda a: F.transform(a, lambda x: x.cast("double")))
    rows = rows.select("episode_index", "frame_index", F.col("split_label").alias("split"), F.transform(F.slice("observed", 1, 8), lambda x: x.cast("double")).alias("current"), two("truth").alias("target"), two("reference").alias("bridge"), two("predicted").alias("adapter"))
    return rows.withColumn("hold", F.array("current", "current"))


WIDTHS, ACTIVE = [1.0, 2.0, 1.0, 2.0, 1.0, 2.0, 1.0, 2.0], [0, 1, 2, 3, 4, 5, 6]
CHUNKS = f"""{PREDICTIONS}, base AS (SELECT split_label AS split, episode_index, frame_index, joint % 8 AS joint, joint // 8 AS k, p, t, h, first_value(o) OVER (PARTITION BY frame_index, joint % 8 ORDER BY joint) AS c, 1.0 + (joint % 8) % 2 AS width FROM pj),
pol AS (SELECT *, unnest(['hold', 'bridge', 'adapter']) AS policy, unnest([c, h, p]) AS x FROM base)"""


@query(f"""WITH {CHUNKS}, m AS (SELECT split, policy, avg(abs(x - t) / width) FILTER (joint < 7) AS a, sqrt(avg((x - t) ** 2) FILTER (joint < 7)) AS r, avg(abs(x - t)) FILTER (joint < 3) AS sh, avg(abs(x - c)) FILTER (joint < 7) AS m, avg(abs(t - c)) FILTER (joint < 7) AS tm FROM pol GROUP BY ALL)
SELECT split, policy, round(a, 6) AS normalized_mae, round(r, 6) AS rmse, round(sh, 6) AS shoulder_mae, round(m, 6) AS motion, round(tm, 6) AS target_motion, round(m / greatest(tm, 1e-8), 6) AS motion_ratio FROM m""")
def chunk_metrics(spark, sf_dir):
    found = metrics.chunk_metrics(chunks(spark, sf_dir), WIDTHS, ACTIVE, SHOULDERS, ["hold", "bridge", "adapter"])
    return rounded(found, "normalized_mae", "rmse", "shoulder_mae", "motion", "target_motion", "motion_ratio")


@query(f"""WITH {CHUNKS}, u AS (SELECT split, abs(p - h) / 0.8 AS s FROM base WHERE joint < 7 AND k = 0) SELECT split, round(avg(s), 6) AS mean_share, round(max(s), 6) AS max_share, round(avg((s >= 0.95)::INTEGER), 6) AS saturation FROM u GROUP BY split""")
def residual_usage(spark, sf_dir):
    rows = chunks(spark, sf_dir).withColumn("correction", F.zip_with(F.col("adapter")[0], F.col("bridge")[0], lambda a, b: a - b))
    return rounded(metrics.residual_usage(rows, [0.8] * 8, ACTIVE), "mean_share", "max_share", "saturation")


HUBER = "CASE WHEN abs({x}) < 0.05 THEN 0.5 * {x} * {x} / 0.05 ELSE abs({x}) - 0.025 END"


@query(f"""WITH {CHUNKS}, e AS (SELECT split, frame_index, (p - t) / width AS e, (p - t) / width - lag((p - t) / width) OVER (PARTITION BY frame_index, joint ORDER BY k) AS d, (p - h) / 0.8 AS r FROM base WHERE joint < 7),
l AS (SELECT split, count(DISTINCT frame_index) AS samples, avg({HUBER.format(x='e')}) AS j, avg({HUBER.format(x='d')}) FILTER (d IS NOT NULL) AS v, avg(r * r) AS r FROM e GROUP BY split)
SELECT split, samples, round(j, 6) AS joint_loss, round(v, 6) AS velocity_loss, round(r, 6) AS residual_loss, round(j + 0.05 * v + 0.01 * r, 6) AS loss FROM l""")
def chunk_loss_terms(spark, sf_dir):
    rows = chunks(spark, sf_dir).withColumn("residual", F.zip_with("adapter", "bridge", lambda a, b: F.zip_with(a, b, lambda x, y: x - y))).withColumnRenamed("adapter", "corrected")
    return rounded(metrics.chunk_loss_terms(rows, WIDTHS, [0.8] * 8, ACTIVE), "joint_loss", "velocity_loss", "residual_loss", "loss")


@query(f"""WITH {PREDICTIONS}, m AS (SELECT split_label AS split, frame_index, sqrt(sum((p - t) ** 2) FILTER (joint < 3)) AS d, sum(p * t) FILTER (joint BETWEEN 3 AND 11) AS tr FROM pj GROUP BY ALL)
SELECT split, round(avg(d), 6) AS position_mae, round(avg(degrees(acos(greatest(-1, least(1, (tr - 1) / 2))))), 6) AS orientation_mae_deg FROM m GROUP BY split""")
def pose_errors(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    poses = rows.select(F.col("split_label").alias("split"), *(F.slice(c, at, n).alias(to) for c, at, n, to in (("predicted", 1, 3, "position"), ("truth", 1, 3, "target_position"), ("predicted", 4, 9, "rotation"), ("truth", 4, 9, "target_rotation"))))
    return rounded(metrics.pose_errors(poses), "position_mae", "orientation_mae_deg")
