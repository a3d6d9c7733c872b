"""Statistics of features, and errors of predictions against the truth.

Predictions are rows (episode_index, split_label, frame_index, predicted, truth, reference, observed), the last four arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.vectors import clip, cosine, geodesic_degrees, minus, norm, smooth_l1
from cadenza.shared import summed_before

QUANTILES = {"q01": 0.01, "q10": 0.1, "q50": 0.5, "q90": 0.9, "q99": 0.99}


def count_quantiles(counts: DataFrame, quantiles: dict[str, float], by: Sequence[str] = ("dim",)) -> DataFrame:
    """(by, one column a quantile) of counted values (by, x, c), one row a value, linearly interpolated, for few groups. No state grows with
    the number of values: counts are added up over range partitions, and the values at the wanted places are looked up."""
    before = summed_before(counts, "upto", "c", *map(F.col, by), F.col("x"))
    sizes = before.groupBy(*by).agg(F.sum("c").alias("n"), F.min("upto").alias("base"))
    wanted = F.array(*(F.struct(F.lit(k).alias("k"), (F.lit(q) * (F.col("n") - 1)).alias("at")) for k, q in quantiles.items()))
    wanted = sizes.select(*by, "base", F.explode(wanted).alias("w")).select(*by, "base", "w.k", F.col("w.at").alias("at"))
    wanted = wanted.select(*by, "k", "base", "at", F.explode(F.array(F.struct(F.floor("at").alias("i"), F.lit(0).alias("s")), F.struct(F.ceil("at").alias("i"), F.lit(1).alias("s")))).alias("e"))
    # a few rows a group, of which there are few (dimensions, stages): each value meets the wanted places of its group
    wanted = wanted.select(*(F.col(c).alias(f"w_{c}") for c in by), "k", "at", "e.*", "base")
    met = before.join(F.broadcast(wanted), [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in by])
    met = met.filter((F.col("upto") - F.col("base") <= F.col("i")) & (F.col("i") < F.col("upto") - F.col("base") + F.col("c")))
    pairs = met.groupBy(*by, "k", "at").agg(F.max(F.when(F.col("s") == 0, F.col("x"))).alias("lo"), F.max(F.when(F.col("s") == 1, F.col("x"))).alias("hi"))
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))
    return pairs.groupBy(*by).agg(*(F.max(F.when(F.col("k") == k, value)).alias(k) for k in quantiles))


def exact_quantiles(rows: DataFrame, quantiles: dict[str, float], by: Sequence[str] = ("dim",)) -> DataFrame:
    """count_quantiles of rows (by, x); nulls don't count."""
    return count_quantiles(rows.filter("x IS NOT NULL").groupBy(*by, "x").agg(F.count(F.lit(1)).alias("c")), quantiles, by)


def value_counts(frames: DataFrame, feature: str) -> DataFrame:
    """(dim, x, c): how often each value occurs in each dimension of a feature. Tables of several datasets, one below the other,
    are those of all of them."""
    rows = frames.select(F.posexplode(feature).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    return rows.filter("x IS NOT NULL").groupBy("dim", "x").agg(F.count(F.lit(1)).alias("c"))


def stats_of_counts(counts: DataFrame) -> DataFrame:
    """feature_stats by value_counts."""
    once = counts.groupBy("dim", "x").agg(F.sum("c").alias("c"))
    n, mean = F.sum("c"), F.sum(F.col("x") * F.col("c")) / F.sum("c")
    plain = once.groupBy("dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), mean.alias("mean"), n.alias("count"))
    spread = once.join(F.broadcast(plain.select("dim", "mean")), "dim").groupBy("dim").agg(F.sqrt(F.sum((F.col("x") - F.col("mean")) ** 2 * F.col("c")) / F.sum("c")).alias("std"))  # a row a dimension
    return plain.join(spread, "dim").select("dim", "min", "max", "mean", "std", "count").join(count_quantiles(once, QUANTILES), "dim", "left")


def feature_stats(frames: DataFrame, feature: str) -> DataFrame:
    """Minimum, maximum, mean, population deviation, count and exact quantiles of each dimension."""
    rows = frames.select(F.posexplode(feature).alias("dim", "x")).withColumn("x", F.col("x").cast("double"))
    plain = rows.groupBy("dim").agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count("x").alias("count"))
    return plain.join(exact_quantiles(rows, QUANTILES), "dim", "left")


def joint_errors(predictions: DataFrame) -> DataFrame:
    """(episode_index, joint, mse, mae, rmse) per episode and joint."""
    joints = predictions.select("episode_index", F.posexplode(minus("predicted", "truth")).alias("joint", "e"))
    out = joints.groupBy("episode_index", "joint").agg(F.avg(F.col("e") * F.col("e")).alias("mse"), F.avg(F.abs("e")).alias("mae"))
    return out.withColumn("rmse", F.sqrt("mse"))


def episode_metrics(predictions: DataFrame) -> DataFrame:
    """Per episode: frames, mse, mae, rmse, the largest error and its joint (of equal ones that of the earliest frame, then of
    the lowest joint), the mean cosine of the frames (0 where a norm is next to nothing), and the mean and population
    deviation of the distance between consecutive frames of prediction and truth, 0 with one frame."""
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    step = lambda c: norm(minus(c, F.lag(c).over(order)))
    rows = predictions.withColumns({"cosine": cosine("predicted", "truth"), "p_step": step("predicted"), "t_step": step("truth"), "error": minus("predicted", "truth")})
    keep = [c for c in ("split_label",) if c in predictions.columns]
    smooth = [F.coalesce(f(c), F.lit(0.0)).alias(f"{n}_smoothness_{k}") for c, n in (("p_step", "pred"), ("t_step", "truth")) for k, f in (("mean", F.avg), ("std", F.stddev_pop))]
    frames = rows.groupBy("episode_index").agg(*(F.min(c).alias(c) for c in keep), F.count(F.lit(1)).alias("frames"), F.avg("cosine").alias("cosine"), *smooth)
    joints = rows.select("episode_index", "frame_index", F.posexplode("error").alias("joint", "e"))
    place = F.struct(F.abs("e").alias("m"), (-F.col("frame_index")).alias("f"), (-F.col("joint")).alias("j"))
    whole = joints.groupBy("episode_index").agg(F.avg(F.col("e") * F.col("e")).alias("mse"), F.avg(F.abs("e")).alias("mae"), F.max(place).alias("worst"))
    whole = whole.select("episode_index", "mse", "mae", F.sqrt("mse").alias("rmse"), F.col("worst.m").alias("max_abs_error"), (-F.col("worst.j")).alias("max_error_joint"))
    return frames.join(whole, "episode_index")


def split_summary(metrics: DataFrame) -> DataFrame:
    """Per split of episode metrics: episodes, mean and population deviation of the errors and the cosine."""
    both = [f(c).alias(f"{c}_{k}") for c in ("mse", "mae", "rmse", "cosine") for k, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return metrics.groupBy("split_label").agg(F.count(F.lit(1)).alias("episodes"), *both)


def joint_summary(errors: DataFrame, splits: DataFrame) -> DataFrame:
    """Per split and joint the mean and population deviation of the episodes' mae. splits: (episode_index, split_label)."""
    rows = errors.join(splits, "episode_index")
    return rows.groupBy("split_label", "joint").agg(F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"))


def metrics_rollup(metrics: DataFrame) -> DataFrame:
    """Means of the episodes' metrics, overall (split_label 'overall') and by split: each episode counts alike."""
    out = metrics.groupingSets([[], ["split_label"]], "split_label").agg(F.grouping("split_label").alias("g"), F.count(F.lit(1)).alias("episodes"), *(F.avg(c).alias(f"{c}_mean") for c in ("mse", "mae", "rmse", "cosine")))
    return out.withColumn("split_label", F.when(F.col("g") == 1, "overall").otherwise(F.col("split_label"))).drop("g")


def box_stats(errors: DataFrame, splits: DataFrame) -> DataFrame:
    """Per split and joint: least, quartiles and greatest of the episodes' mae."""
    rows = errors.join(splits, "episode_index")
    q = F.percentile("mae", F.array(*(F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0))))
    out = rows.groupBy("split_label", "joint").agg(q.alias("q"))
    return out.select("split_label", "joint", *(F.col("q")[i].alias(n) for i, n in enumerate(("low", "q1", "median", "q3", "high"))))


def joint_rows(predictions: DataFrame, max_delta: float) -> DataFrame:
    """One row per frame and joint: absolute errors of the model, of holding the reference, and of the limited model, the
    displacements from the reference, and whether the limit cuts."""
    z = F.arrays_zip(*(F.col(c) for c in ("predicted", "truth", "reference", "observed")))
    keep = [c for c in ("episode_index", "split_label", "frame_index", "chunk_id") if c in predictions.columns]
    rows = predictions.select(*keep, F.posexplode(z).alias("joint", "v"))
    p, t, h, o = (F.col(f"v.{c}").cast("double") for c in ("predicted", "truth", "reference", "observed"))
    limited = o + clip(p - o, -max_delta, max_delta)
    return rows.select(
        *keep, "joint", F.abs(p - t).alias("model"), F.abs(h - t).alias("hold"), F.abs(limited - t).alias("limited"), (p - h).alias("moved"), (t - h).alias("target"), (F.abs(p - o) > max_delta).alias("clamped")
    )


def correlation(a: str, b: str) -> Column:
    """Null where either one hardly varies."""
    return F.when((F.stddev_pop(a) >= 1e-8) & (F.stddev_pop(b) >= 1e-8), F.corr(a, b))


def direction_agreement(moved: str, target: str, epsilon: float = 1e-4, only: Column | None = None) -> Column:
    """The share of equal signs where the target moves; null where it never does."""
    active = F.abs(target) > epsilon
    return F.avg(F.when(active if only is None else active & only, (F.signum(moved) == F.signum(target)).cast("int")))


def joint_sanity(predictions: DataFrame, max_delta: float) -> DataFrame:
    """Per episode and joint: the errors, correlation and direction agreement of displacements, and the share clamped."""
    means = [F.avg(c).alias(f"{c}_mae") for c in ("model", "hold", "limited")]
    rows = joint_rows(predictions, max_delta)
    return rows.groupBy("episode_index", "joint").agg(*means, correlation("moved", "target").alias("correlation"), direction_agreement("moved", "target").alias("direction"), F.avg(F.col("clamped").cast("int")).alias("clamp_rate"))


def sanity_columns(shoulders: Sequence[int]) -> list[Column]:
    shoulder = F.col("joint").isin(list(shoulders))
    only = lambda c: F.avg(F.when(shoulder, F.col(c)))
    return [
        F.avg("model").alias("model_mae"), F.avg("hold").alias("hold_mae"), F.avg("limited").alias("limited_mae"), (F.avg("model") < F.avg("hold")).alias("model_beats_hold"),
        only("model").alias("shoulder_model_mae"), only("hold").alias("shoulder_hold_mae"), (only("model") < only("hold")).alias("shoulders_beat_hold"),
        direction_agreement("moved", "target").alias("direction"), direction_agreement("moved", "target", only=shoulder).alias("shoulder_direction"), F.avg(F.col("clamped").cast("int")).alias("clamp_element_rate"),
    ]


def baseline_sanity(predictions: DataFrame, max_delta: float, shoulders: Sequence[int]) -> DataFrame:
    """Per episode: the model against holding the reference and against the limiter, shoulders apart, the error at the last
    frame of each chunk (chunk_id), and how many elements and frames are clamped."""
    rows = joint_rows(predictions, max_delta)
    out = rows.groupBy("episode_index").agg(*sanity_columns(shoulders))
    frames = rows.groupBy("episode_index", "frame_index", "chunk_id").agg(F.bool_or("clamped").alias("any"), F.avg("model").alias("mae"))
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    following = F.lead("chunk_id").over(order)
    frames = frames.withColumn("endpoint", following.isNull() | (following != F.col("chunk_id")))
    frames = frames.groupBy("episode_index").agg(F.avg(F.col("any").cast("int")).alias("clamp_frame_rate"), F.avg(F.when(F.col("endpoint"), F.col("mae"))).alias("endpoint_mae"))
    return out.join(frames, "episode_index")


def sanity_rollup(predictions: DataFrame, max_delta: float, shoulders: Sequence[int], latencies: DataFrame | None = None) -> DataFrame:
    """baseline_sanity's errors overall and by split, each frame counting alike; with latencies (split_label, seconds) also how
    many predictions there are (n), and their mean_ms, p50_ms, p95_ms and p99_ms."""
    rows = joint_rows(predictions, max_delta)
    label = lambda df: df.withColumn("split_label", F.when(F.col("g") == 1, "overall").otherwise(F.col("split_label"))).drop("g")
    out = label(rows.groupingSets([[], ["split_label"]], "split_label").agg(F.grouping("split_label").alias("g"), F.count_distinct("episode_index").alias("episodes"), *sanity_columns(shoulders)))
    frames = rows.groupBy("split_label", "episode_index", "frame_index").agg(F.bool_or("clamped").cast("int").alias("any"))
    frames = label(frames.groupingSets([[], ["split_label"]], "split_label").agg(F.grouping("split_label").alias("g"), F.count(F.lit(1)).alias("frames"), F.avg("any").alias("clamp_frame_rate")))
    out = out.join(frames, "split_label")
    if latencies is None:
        return out
    times = latencies.select("split_label", "seconds").union(latencies.select(F.lit("overall"), "seconds"))
    return out.join(latency_summary(times, ["split_label"]).drop("delay_steps"), "split_label", "left")


def latency_summary(latencies: DataFrame, by: Sequence[str] = ("stage",), *, hz: float = 30.0) -> DataFrame:
    """Per group of latencies (seconds): count, mean, p50, p95, p99 in ms, and the control steps that the p95 takes."""
    rows = latencies.select(*by, (F.col("seconds") * 1000).alias("x"))
    out = rows.groupBy(*by).agg(F.count("x").alias("n"), F.avg("x").alias("mean_ms"))
    q = exact_quantiles(rows, {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, by).toDF(*(f"q_{c}" for c in by), "p50_ms", "p95_ms", "p99_ms")
    out = out.join(q, [F.col(c).eqNullSafe(F.col(f"q_{c}")) for c in by], "left").select(*by, "n", "mean_ms", "p50_ms", "p95_ms", "p99_ms")
    return out.withColumn("delay_steps", F.ceil(F.col("p95_ms") * hz / 1000))


def gate_decision(summary: DataFrame, *, threshold: float = 10.0, hz: float = 30.0, most_clamped: float = 0.05) -> DataFrame:
    """Rows of summary (contract_errors, model_beats_hold, shoulders_beat_hold, p95_ms, starved_steps, clamp_element_rate)
    with failed_gates, decision (GO or NO_GO) and retraining_recommended. The latency's budget is what `threshold` queued
    steps last."""
    gates = {
        "contract_has_no_errors": F.col("contract_errors") == 0, "policy_beats_hold": F.col("model_beats_hold"), "shoulders_beat_hold": F.col("shoulders_beat_hold"),
        "p95_within_refill_budget": F.col("p95_ms") <= 1000 * threshold / hz, "no_starvation": F.col("starved_steps") == 0, "few_clamped": F.col("clamp_element_rate") < most_clamped,
    }
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(g, F.lit(False)), n) for n, g in gates.items())))
    rows = summary.withColumn("failed_gates", failed)
    worse = ~F.coalesce(F.col("model_beats_hold") & F.col("shoulders_beat_hold"), F.lit(False))
    return rows.withColumn("decision", F.when(F.size("failed_gates") == 0, "GO").otherwise("NO_GO")).withColumn("retraining_recommended", worse)


def chunk_metrics(chunks: DataFrame, widths: Sequence[float], active: Sequence[int], shoulders: Sequence[int], policies: Sequence[str]) -> DataFrame:
    """(split, policy, ...) from chunks (split, current array, target and one column a policy: arrays of arrays): errors over
    the joints' ranges, their root mean square, those of the shoulders, and the motion against the target's."""
    one = [F.struct(F.lit(p).alias("policy"), F.col(p).alias("chunk")) for p in policies]
    rows = chunks.select("split", "current", "target", F.explode(F.array(*one)).alias("x"))
    rows = rows.select("split", "current", "x.policy", F.explode(F.arrays_zip(F.col("x.chunk").alias("p"), F.col("target").alias("t"))).alias("s"))
    rows = rows.select("split", "policy", F.posexplode(F.arrays_zip(F.col("s.p").alias("p"), F.col("s.t").alias("t"), F.col("current").alias("c"))).alias("joint", "v"))
    p, t, c = (F.col(f"v.{k}").cast("double") for k in "ptc")
    width = F.element_at(F.array(*(F.lit(max(float(w), 1e-8)) for w in widths)), F.col("joint") + 1)
    some, shoulder = F.col("joint").isin(list(active)), F.col("joint").isin(list(shoulders))
    mean = lambda x, where=some: F.avg(F.when(where, x))
    out = rows.groupBy("split", "policy").agg(
        mean(F.abs(p - t) / width).alias("normalized_mae"), F.sqrt(mean((p - t) * (p - t))).alias("rmse"), mean(F.abs(p - t), shoulder).alias("shoulder_mae"), mean(F.abs(p - c)).alias("motion"), mean(F.abs(t - c)).alias("target_motion")
    )
    return out.withColumn("motion_ratio", F.col("motion") / F.greatest("target_motion", F.lit(1e-8)))


def pose_errors(poses: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Per group of poses (position, target_position: three numbers; rotation, target_rotation: nine): the mean distance and
    the mean angle in degrees."""
    return poses.groupBy(*by).agg(F.avg(norm(minus("position", "target_position"))).alias("position_mae"), F.avg(geodesic_degrees(F.col("rotation"), F.col("target_rotation"))).alias("orientation_mae_deg"))


def residual_usage(rows: DataFrame, bounds: Sequence[float], active: Sequence[int], by: Sequence[str] = ("split",)) -> DataFrame:
    """Per group of rows (correction array): mean and largest share of the bound that corrections use, and how many use 0.95."""
    x = rows.select(*by, F.posexplode("correction").alias("joint", "c")).filter(F.col("joint").isin(list(active)))
    share = F.abs("c") / F.element_at(F.array(*(F.lit(max(float(b), 1e-8)) for b in bounds)), F.col("joint") + 1)
    x = x.withColumn("share", share)
    return x.groupBy(*by).agg(F.avg("share").alias("mean_share"), F.max("share").alias("max_share"), F.avg((F.col("share") >= 0.95).cast("int")).alias("saturation"))


def quality_gates(metrics: DataFrame, usage: DataFrame, adapter: str, bridge: str, *, most_saturated: float = 0.05) -> DataFrame:
    """Per split of chunk_metrics: what the adapter improves on the bridge, and whether all gates pass."""
    of = lambda policy, k: metrics.filter(F.col("policy") == policy).select("split", *(F.col(c).alias(f"{k}_{c}") for c in ("normalized_mae", "shoulder_mae", "motion_ratio")))
    rows = of(adapter, "a").join(of(bridge, "b"), "split").join(usage.select("split", "saturation"), "split")
    rows = rows.withColumns({f"improvement_{c}": F.col(f"b_{c}") - F.col(f"a_{c}") for c in ("normalized_mae", "shoulder_mae")})
    rows = rows.withColumn("improvement_motion_ratio", F.abs(F.col("b_motion_ratio") - 1) - F.abs(F.col("a_motion_ratio") - 1))
    passed = (F.col("improvement_normalized_mae") > 0) & (F.col("improvement_shoulder_mae") > 0) & (F.col("improvement_motion_ratio") >= 0) & (F.col("saturation") <= most_saturated)
    return rows.select("split", "improvement_normalized_mae", "improvement_shoulder_mae", "improvement_motion_ratio", "saturation", passed.alias("passed"))


#: Metres and radians over which errors of poses are taken.
POSE_SCALES = (0.05, 0.25)


def chunk_loss_terms(chunks: DataFrame, widths: Sequence[float], bounds: Sequence[float], active: Sequence[int], *, beta: float = 0.05, weights: tuple[float, float, float] = (1.0, 0.05, 0.01), poses: DataFrame | None = None, pose_weight: float = 0.25) -> DataFrame:
    """(split, samples, joint_loss, velocity_loss, residual_loss, loss) from chunks (episode_index, frame_index,
    split; corrected, target, residual: arrays of arrays): smooth-L1 of errors over ranges and of errors of consecutive steps, squared share of the residual's bound.
    weights: of these three. poses (split, side, position, target_position: three numbers in m; rotation, target_rotation: nine) of
    the chunks' steps add pose_loss, the mean over sides of position and orientation errors, over POSE_SCALES and smoothed alike."""
    at = lambda v, j: F.element_at(F.array(*(F.lit(max(float(x), 1e-6)) for x in v)), j + 1)
    steps = chunks.select("split", F.struct("episode_index", "frame_index").alias("sample"), F.posexplode(F.arrays_zip("corrected", "target", "residual")).alias("k", "s"))
    rows = steps.select("split", "sample", "k", F.posexplode(F.arrays_zip(F.col("s.corrected").alias("p"), F.col("s.target").alias("t"), F.col("s.residual").alias("r"))).alias("joint", "v"))
    rows = rows.filter(F.col("joint").isin(list(active)))
    error = (F.col("v.p").cast("double") - F.col("v.t").cast("double")) / at(widths, F.col("joint"))
    order = Window.partitionBy("sample", "joint").orderBy("k")
    rows = rows.withColumn("e", error).withColumn("de", F.col("e") - F.lag("e").over(order)).withColumn("r", F.col("v.r").cast("double") / at(bounds, F.col("joint")))
    out = rows.groupBy("split").agg(
        F.count_distinct("sample").alias("samples"), F.avg(smooth_l1(F.col("e"), beta)).alias("joint_loss"), F.coalesce(F.avg(smooth_l1(F.col("de"), beta)), F.lit(0.0)).alias("velocity_loss"), F.avg(F.col("r") * F.col("r")).alias("residual_loss")
    )
    extra = F.lit(0.0)
    if poses is not None:
        near = lambda x: smooth_l1(x, beta)
        place = F.aggregate(F.transform(minus("position", "target_position"), lambda d: near(d / POSE_SCALES[0])), F.lit(0.0), lambda s, x: s + x) / 3
        angle = F.radians(geodesic_degrees(F.col("rotation"), F.col("target_rotation")))
        sides = poses.groupBy("split", "side").agg(F.avg(place).alias("p"), F.avg(near(angle / POSE_SCALES[1])).alias("o"))
        out = out.join(sides.groupBy("split").agg(F.avg((F.col("p") + F.col("o")) / 2).alias("pose_loss")), "split", "left")
        extra = pose_weight * F.coalesce("pose_loss", F.lit(0.0))
    return out.withColumn("loss", extra + weights[0] * F.col("joint_loss") + weights[1] * F.col("velocity_loss") + weights[2] * F.col("residual_loss"))
