"""Results stated for small inputs, and edge cases of the operators."""

import math

import pytest
from pyspark.sql import functions as F

from cadenza.operators import audit, coverage, deltas, frames, joints, metrics, motion, splits, vectors
from cadenza.sources import datasets

NAMES = ["right_joint_1.pos", "right_joint_2.pos", "right_gripper.pos", "left_joint_1.pos", "left_joint_2.pos", "left_gripper.pos"]


def topics_of(spark, cases, start=None, end=None):
    """Severity, gaps and rate of a stream with these times in a session that a second stream bounds."""
    rows = [(i, "s", "stream", float(t)) for i, times in enumerate(cases) for t in times]
    if start is not None:
        rows += [(i, "a", "action", float(t)) for i in range(len(cases)) for t in (start, end)]
    found = coverage.topic_coverage(spark.createDataFrame(rows, "episode_index int, topic string, role string, ts double"), action_gap_s=1e9)
    return {r.episode_index: r for r in found.filter("topic = 's'").collect()}


def test_coverage_of_streams(spark):
    dense = [i / 30 for i in range(30)]
    got = topics_of(spark, [dense, [*dense, *(3 + i / 30 for i in range(30))], [0, 0.1, 0.2, 0.3, 0.4, 5.4], [1, 1, 1]])
    assert (got[0].severity, got[0].gaps) == ("pass", []) and got[0].avg_fps == pytest.approx(30)
    assert got[1].severity == "critical" and [g.kind for g in got[1].gaps] == ["dropframe"]
    assert len(got[2].gaps) == 1 and got[2].gaps[0].duration_s == pytest.approx(5.0)
    assert got[3].avg_fps is None
    got = topics_of(spark, [dense], -5, 0.97)
    assert [g.kind for g in got[0].gaps] == ["leading"] and got[0].severity == "critical"
    got = topics_of(spark, [dense], 0, 6)
    assert [g.kind for g in got[0].gaps] == ["trailing"]
    got = topics_of(spark, [[5.0]], 0, 10)
    assert (got[0].severity, got[0].coverage, got[0].total_gap) == ("critical", 0.0, 10.0)


def test_silent_topics(spark):
    rows = spark.createDataFrame([(1, "a", "stream", 0.0), (1, "a", "stream", 0.1)], "episode_index int, topic string, role string, ts double")
    declared = spark.createDataFrame([(1, "a", "stream"), (1, "b", "stream"), (1, "c", "action")], "episode_index int, topic string, role string")
    got = {r.topic: (r.severity, r.message_count, r.coverage) for r in coverage.topic_coverage(rows, declared).collect()}
    assert got == {"a": ("pass", 2, 1.0), "b": ("critical", 0, 0.0), "c": ("warning", 0, 0.0)}
    got = {r.topic: r.severity for r in coverage.topic_coverage(rows, declared, action_from_observation=True).collect()}
    assert got["c"] == "pass"


@pytest.mark.parametrize(("rates", "low"), [([60, 60, 50], [2]), ([60, 59, 61], []), ([60], []), ([60, 60, 60, 48], [3])])
def test_degraded_rates(spark, rates, low):
    rows = [(i, "t", role, float(f), s) for i, f in enumerate(rates) for role, s in (("stream", "pass"),)]
    rows += [(i, "act", "action", f, "pass") for i, f in enumerate([60.0, 60.0, 10.0])] + [(9, "t", "stream", None, "critical")]
    got = coverage.fps_degradation(spark.createDataFrame(rows, "episode_index int, topic string, role string, avg_fps double, severity string")).collect()
    assert sorted(r.episode_index for r in got if r.degraded) == low
    assert all(r.severity == ("warning" if r.degraded else "critical" if r.episode_index == 9 else "pass") for r in got)


def test_presence(spark):
    schema = "episode_index int, topic string, role string"
    rows = [(i, "cam", "stream") for i in range(3)] + [(i, "joints", "stream") for i in range(4)] + [(0, "stray", "stream")] + [(i, "log", "unclassified") for i in range(3)]
    got = coverage.missing_expected(spark.createDataFrame(rows, schema)).collect()
    assert [(r.episode_index, r.topic, r.severity) for r in got] == [(3, "cam", "critical")] and "3/4" in got[0].reason
    assert coverage.missing_expected(spark.createDataFrame([(1, "cam", "stream")], schema)).count() == 0


REACH = ["arm_a", "arm_b", "hand_gripper"]


def reaching(spark):
    """90 frames: the first joint rests to frame 29, moves by 0.01 a frame to 0.40 at frame 69, and rests; the gripper opens at
    frame 50."""
    rows = [(0, i, v, v) for i in range(90) for v in [[min(max(i - 29, 0), 40) / 100, 1.0, 0.2 if i >= 50 else 0.0]]]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, action array<double>, state array<double>")


def test_motion_window(spark):
    """0.03 is the first step beyond 0.025 (frame 32), 0.37 the last that is as far from 0.40 (frame 66)."""
    rows = reaching(spark)
    limits = {"arm_threshold": 0.025, "end_arm_threshold": 0.025}
    got = motion.detect_motion_window(rows, REACH, motion.MotionTrimConfig(start_offset_frames=-4, end_postroll_frames=6, **limits)).first()
    assert (got.start_event, got.start, got.final_settle_event, got.end) == (32, 28, 67, 73)
    got = motion.detect_motion_window(rows, REACH, motion.MotionTrimConfig(start_offset_frames=-50, end_postroll_frames=50, **limits)).first()
    assert (got.start, got.end) == (0, 90)
    spike = F.array(F.lit(0.0), F.lit(1.0), F.lit(0.5))
    got = motion.detect_motion_window(rows.withColumn("action", F.when(F.col("frame_index") == 20, spike).otherwise(F.col("action"))), REACH, motion.MotionTrimConfig(start_mode="gripper", start_offset_frames=-5)).first()
    assert (got.start_event, got.start) == (50, 45)
    got = motion.detect_motion_window(rows, REACH, motion.MotionTrimConfig(start_mode="displacement", displacement_threshold=0.2)).first()
    assert got.start_event == got.start == 50
    still = motion.detect_motion_window(rows.filter("frame_index < 10"), REACH).first()
    assert (still.start, still.end, still.start_event_found, still.final_settle_found) == (0, 10, False, False)
    with pytest.raises(ValueError):
        motion.detect_motion_window(rows, ["a_gripper"])
    with pytest.raises(ValueError):
        motion.MotionTrimConfig(start_mode="none")


def test_trim_plan(spark):
    plan = spark.createDataFrame([(1, 20, True), (2, 53, True), (3, 999, False)], "episode_index int, start_event int, start_event_found boolean")
    assert motion.reference_preroll(plan) == 37
    with pytest.raises(ValueError):
        motion.reference_preroll(plan.filter("NOT start_event_found"))
    rows = reaching(spark)
    bad = spark.createDataFrame([(0, 5, 500)], "episode_index long, start long, end long")
    with pytest.raises(Exception, match="outside its episode"):
        motion.build_trim_plan(rows, REACH, overrides=bad).collect()


def predictions(spark, rows):
    return spark.createDataFrame([(0, "val", i, p, t) for i, (p, t) in enumerate(rows)], "episode_index int, split_label string, frame_index int, predicted array<double>, truth array<double>")


def test_episode_metrics(spark):
    flat = predictions(spark, [([0.5] * 3, [0.0] * 3)] * 4)
    got = metrics.episode_metrics(flat).first()
    assert (got.mse, got.mae, got.rmse) == (0.25, 0.5, 0.5) and got.cosine == 0
    tie = metrics.episode_metrics(predictions(spark, [([0.0, 2.0, 0.0], [0.0] * 3), ([2.0, 0.0, 0.0], [0.0] * 3)])).first()
    assert (tie.max_abs_error, tie.max_error_joint) == (2.0, 1)  # the earliest frame before the lowest joint
    assert metrics.episode_metrics(predictions(spark, [([1.0, 0.0], [0.0, 1.0])])).first().cosine == 0
    ramp = metrics.episode_metrics(predictions(spark, [([0.1 * i, 0.0], [0.0, 0.0]) for i in range(9)])).first()
    assert ramp.pred_smoothness_mean == pytest.approx(0.1) and ramp.pred_smoothness_std == pytest.approx(0, abs=1e-9)
    one = metrics.episode_metrics(predictions(spark, [([1.0], [2.0])])).first()
    assert (one.pred_smoothness_mean, one.truth_smoothness_std) == (0, 0)


def test_quantiles_are_exact(spark):
    rows = spark.createDataFrame([([float(i % 7), None if i % 2 else float(i)],) for i in range(101)], "v array<double>")
    got = {r.dim: r for r in metrics.feature_stats(rows, "v").collect()}
    assert got[0].q50 == 3 and got[1].q50 == 50 and got[1].q10 == pytest.approx(10) and got[1]["count"] == 51
    assert metrics.feature_stats(rows.filter("false"), "v").count() == 0
    assert metrics.feature_stats(spark.createDataFrame([([0.0],), ([10.0],)], "v array<double>"), "v").first().q50 == 5


def test_fill_order(spark):
    left = spark.createDataFrame([(1, 0, 5.0), (1, 1000, None), (1, 9000, None), (2, 0, None), (2, 10, 7.0)], "episode_index int, ts long, observation double")
    right = spark.createDataFrame([(1, 900, 1.0), (1, 2000, 2.0)], "episode_index int, ts long, value double")
    got = sorted((r.episode_index, r.ts, r.fill_kind, r.filled) for r in frames.fill_action(left, right, tolerance=200).collect())
    assert got == [(1, 0, "fallback_to_observation", 5.0), (1, 1000, "exact", 1.0), (1, 9000, "hold_last", 2.0), (2, 0, "dropped", None), (2, 10, "fallback_to_observation", 7.0)]


def test_joint_names_and_order(spark):
    names = ["follower_l_joint1", "follower_r_finger_joint1", "leader_r_joint1", "follower_x_joint1", "other_joint1", "follower_joint9", None]
    roles, arms = {"follower": "observation", "leader": "action"}, {"l": "left", "r": "right"}
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.k for r in rows.select(joints.parse_joint_name(F.col("n"), roles, arms).alias("k")).collect()]
    assert [tuple(k)[:3] if k and k.role else None for k in got] == [("observation", "left", "joint1"), ("observation", "right", "finger_joint1"), ("action", "right", "joint1"), None, None, ("observation", "", "joint9"), None]
    got = rows.limit(1).select(joints.parse_joint_name(F.col("n"), roles).alias("k")).first().k
    assert tuple(got) == ("observation", "", "l_joint1")
    order = [*(f"joint{i}" for i in range(1, 8)), "finger_joint1"]
    v = spark.range(1).select(joints.reorder_command(F.array(*(F.lit(float(i)) for i in range(8))), order).alias("v")).first().v
    assert v == [7.0, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    with pytest.raises(ValueError):
        joints.map_action_to_state(["a", "b"], ["a"])
    assert joints.map_action_to_state(["a", "b"], ["b", "a"]) == [1, 0] and joints.map_action_to_state(["a", "g"], ["a"], ["g"]) == [0, None]


def test_deltas_and_back(spark):
    rows = [(e, f, f // 4, [math.sin(f + e), float(f), 2.0], [math.cos(f), f - 0.5, 1.0]) for e in range(2) for f in range(10)]
    df = spark.createDataFrame(rows, "episode_index int, frame_index int, chunk_id int, action array<double>, state array<double>")
    for kind, f in (("delta_obs_t", None), ("delta_sequential", deltas.delta_sequential)):
        first = df if f else df.withColumn("state", F.first("state").over(deltas.Window.partitionBy("episode_index", "chunk_id").orderBy("frame_index")))
        made = f(df, excluded=[2]) if f else deltas.delta_obs_t(first, excluded=[2])
        for r in deltas.restore_delta(made, kind, excluded=[2]).collect():
            assert r.restored == pytest.approx(r.action)
    near = spark.createDataFrame([(0, i, [i + 0.01], [float(i)]) for i in range(5)], "episode_index int, frame_index int, action array<double>, state array<double>")
    got = deltas.delta_action_stats(near).first()
    assert got["mean"] == pytest.approx(0.01) and got["std"] == 1e-6
    assert deltas.delta_action_stats(near, excluded=[0]).first()["mean"] == pytest.approx(2.01)
    chunk = spark.range(1).select(deltas.delta_chunk(F.array(F.array(F.lit(1.0)), F.array(F.lit(3.0))), F.array(F.lit(0.5))).alias("c")).first().c
    assert chunk == [[0.5], [2.0]]
    limited = spark.range(1).select(deltas.limit_delta(F.array(F.lit(1.0), F.lit(5.0)), F.array(F.lit(0.0), F.lit(4.9)), 0.5).alias("l")).first().l
    assert limited.limited == pytest.approx([0.5, 5.0]) and limited.clamped == [0]
    assert spark.range(1).select(deltas.limit_delta(F.array(F.lit(1.0)), F.lit(None).cast("array<double>"), 0.5)["limited"]).first()[0] == [1.0]


def test_splits(spark):
    episodes = spark.range(33).withColumnRenamed("id", "episode_index")
    one, again, other = (sorted(map(tuple, splits.split_episodes(episodes, seed=s).collect())) for s in (1000, 1000, 7))
    assert one == again != other and [e for e, _ in one] == list(range(33))
    assert {s: sum(x == s for _, x in one) for s in splits.SPLITS} == {"train": 27, "val": 3, "test": 3}
    picked = lambda spec, **k: sorted(r.id for r in splits.select_episodes(spark.range(12).withColumnRenamed("id", "episode_index"), spec, 10, **k).withColumnRenamed("episode_index", "id").collect())
    assert picked("1,3:5,8:", base=1) == [0, 2, 3, 7, 8, 9] and picked("7:", skip=True) == [0, 1, 2, 3, 4, 5, 6, 10, 11] and picked("") == []
    assert splits.episode_spec("1,3:5,8:", 10, base=1) == [1, 3, 4, 8, 9, 10] and splits.episode_spec(":2", 5) == [0, 1]
    for bad in ("0", "5:5", "4:99", "x"):
        with pytest.raises(ValueError):
            splits.episode_spec(bad, 10, base=1)
    with pytest.raises(ValueError):
        splits.attach_split(episodes, splits.split_episodes(episodes).filter("episode_index > 3"), episodes=episodes)


def test_limits_and_scalars(spark):
    row = spark.range(1).select(vectors.normalize_from_limits(F.array(F.lit(-2.0), F.lit(0.25)), [(-1, 1), None]).alias("v"), vectors.duration_text(F.lit(3723.0)).alias("d"), vectors.duration_text(F.lit(5.0)).alias("e")).first()
    assert row.v == [-1.0, 0.25] and (row.d, row.e) == ("1h 2m 3s", "5.0s")
    with pytest.raises(Exception, match="finite"):
        spark.range(1).select(vectors.normalize_from_limits(F.array(F.lit(float("nan"))), [(-1, 1)])).collect()


def test_dataset_files(spark, tmp_path):
    for i, text in enumerate(["one", "two"]):
        (tmp_path / f"{i}.bin").write_text(text)
    root = f"file://{tmp_path}"
    catalog = datasets.episode_catalog(spark, root, "*.bin").collect()
    assert sorted((r.episode_index, r.path[-5:], r.length) for r in catalog) == [(0, "0.bin", 3), (1, "1.bin", 3)]
    before = datasets.fingerprint(spark, root).collect()
    then = spark.createDataFrame(before, "path string, bytes long, sha256 string")
    (tmp_path / "0.bin").write_text("six")
    (tmp_path / "2.bin").write_text("new")
    assert sorted((r.path[-5:], r.problem) for r in datasets.verify_fingerprint(datasets.fingerprint(spark, root), then).collect()) == [("0.bin", "changed"), ("2.bin", "new")]
    errors = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.25)], "episode_index int, joint int, mae double")
    datasets.write_metrics(spark.createDataFrame([(0, 0.1)], "episode_index int, mse double"), errors, ["a", "b"], f"{root}/metrics")
    got = spark.read.option("header", "true").option("inferSchema", "true").csv(f"{root}/metrics").first()
    assert (got.mse, got.mae_a, got.mae_b) == (0.1, 0.5, 0.25)
    topics = coverage.topic_coverage(spark.createDataFrame([(0, "s", "stream", float(t)) for t in (0, 1, 2, 3, 4, 30)], "episode_index int, topic string, role string, ts double"))
    datasets.write_quality_report(topics, coverage.worst_severity(topics), f"{root}/report")
    assert spark.read.json(f"{root}/report").first().topics[0].gaps[0].kind == "dropframe"


def test_merging_and_checks(spark):
    a = spark.createDataFrame([(4, 0, 1.0, "x"), (4, 1, 2.0, "x")], "episode_index int, frame_index long, v double, spare string")
    b = spark.createDataFrame([(4, 0, 3.0)], "episode_index int, frame_index long, v double")
    got = sorted((r.episode_index, r.frame_index, r["index"], r.v) for r in datasets.merge_datasets([a, b], drop=["spare"]).collect())
    assert got == [(0, 0, 0, 1.0), (0, 1, 1, 2.0), (1, 0, 2, 3.0)]
    with pytest.raises(ValueError):
        datasets.merge_datasets([a, b])
    with pytest.raises(ValueError):
        datasets.merge_datasets([a])
    cache = spark.createDataFrame([([[1.0], [2.0]],), ([[1.0]],)], "chunk array<array<double>>")
    with pytest.raises(Exception, match="another shape"):
        datasets.checked_chunks(cache, ["chunk"], size=2, width=1).collect()
    with pytest.raises(ValueError):
        datasets.checked_chunks(cache, ["other"], size=2, width=1)
    frames_ = spark.createDataFrame([(0, 0, [1.0]), (0, 2, None), (1, 0, [float("nan")])], "episode_index int, frame_index long, v array<double>")
    got = {r.episode_index: r for r in audit.validate_frames(frames_, {"v": 1}).collect()}
    assert (got[0].index_skips, got[0].v_null, got[1].v_not_finite, got[0].valid) == (1, 1, 1, False)
    features = datasets.define_features({"right": ["b", "a"], "left": ["a"]}, ["top"], velocity=True)
    assert [f["feature"] for f in features] == ["observation.state", "observation.velocity", "action", "observation.images.top"] and features[0]["names"] == ["left_a", "right_b", "right_a"]


def test_structure_of_messages(spark):
    rows = [("t", 1, '{"a": 1, "b": [1, 2], "c": "x"}', 5.0), ("t", 2, '{"a": 1.5, "b": [3, 4]}', 6.0), ("t", 9, '{"z": 1}', 9.0), ("u", 1, '{"a": {"b": 1, "c": [1.5]}, "d": ["x"], "e": null, "f": [], "g": [{"h": [{"i": true}]}], "j": {}}', None), ("u", 2, "no json", 2.0), ("v", 1, "[1]", 2.0), ("v", 2, None, 2.0)]
    schema = "topic string, seq long, payload_json string, ts double"
    got = audit.message_structure(spark.createDataFrame(rows, schema), samples=2).collect()
    assert {(r.field, r.type, r.samples, r.length) for r in got if r.topic == "t"} == {("a", "int | float", 2, None), ("b", "List[int]", 2, 2), ("c", "str", 1, None)}
    nested = {"a": "object", "a.b": "int", "a.c": "List[float]", "d": "List[str]", "e": "None", "f": "List[empty]", "g": "List[object]", "g[0].h": "List[object]", "g[0].h[0].i": "bool", "j": "object"}
    assert {r.field: r.type for r in got if r.topic == "u"} == nested and {r.topic for r in got} == {"t", "u"}
    assert {(r.first_ts, r.last_ts) for r in got if r.topic == "t"} == {(5.0, 6.0)}
    assert audit.message_structure(spark.createDataFrame([], schema)).count() == 0


def contract(spark, **changes):
    """The errors and warnings of one contract that is right but for the changes."""
    names = ["right_joint_1.pos", "left_joint_1.pos"]
    facts = {("dataset", "action"): names, ("dataset", "state"): names, ("processor", "action"): names, ("checkpoint", "action"): names, ("runtime", "arms"): ["right", "left"], ("runtime", "joints"): ["joint1"]}
    facts |= {(s, "cameras"): ["left", "right"] for s in ("dataset", "checkpoint", "runtime")} | changes.pop("facts", {})
    numbers = {"state_dim": 2, "action_dim": 2} | changes.pop("numbers", {})
    slices = {"right": (0, 1), "left": (1, 2)} | changes.pop("slices", {})
    flags = {"use_relative_actions": True, "relative_enabled": True, "absolute_enabled": True, "async_prefetch": True} | changes.pop("flags", {})
    shapes = changes.pop("shapes", [])
    row = audit.contract_audit(
        spark.createDataFrame([(1, *k, v) for k, v in facts.items()], "pair_id long, side string, kind string, names array<string>"),
        numbers=spark.createDataFrame([(1, k, v) for k, v in numbers.items()], "pair_id long, name string, value long"),
        slices=spark.createDataFrame([(1, k, *v) for k, v in slices.items() if v], "pair_id long, arm string, start long, end long"),
        flags=spark.createDataFrame([(1, k, v) for k, v in flags.items()], "pair_id long, name string, value boolean"),
        shapes=spark.createDataFrame([(1, *s) for s in shapes], "pair_id long, side string, camera string, shape array<int>"),
    ).first()
    return row.status, row.errors, row.warnings


def test_contracts(spark):
    assert contract(spark) == ("pass", [], [])
    status, errors, _ = contract(spark, facts={("runtime", "arms"): ["left", "right"]})
    assert status == "error" and any("runtime/checkpoint arm order" in e for e in errors) and sum("Non-contiguous" in e for e in errors) == 2
    assert contract(spark, facts={("runtime", "cameras"): ["right", "left"]})[0] == "pass"
    assert "runtime/checkpoint camera roles" in contract(spark, facts={("runtime", "cameras"): ["right"]})[1][0]
    assert contract(spark, facts={("dataset", "state"): ["left_joint_1.pos", "right_joint_1.pos"]})[1][0].startswith("dataset action/state names mismatch")
    assert contract(spark, slices={"left": None})[1] == ["Missing runtime arm configuration for left", "Runtime arm slices cover 1 actions, checkpoint expects 2"]
    assert len(contract(spark, numbers={"action_dim": 3})[1]) == 4 and len(contract(spark, facts={("runtime", "joints"): ["a", "b"]})[1]) == 1
    assert contract(spark, flags={"absolute_enabled": False})[1] == ["relative actions are never made absolute"] and len(contract(spark, flags={"relative_enabled": False})[1]) == 1
    assert contract(spark, flags={"rtc_enabled": True, "async_prefetch": False}) == ("pass_with_warnings", [], ["RTC is enabled", "Synchronous prefetch is disabled"])
    assert contract(spark, facts={("conversion", "arms"): ["left", "right"], ("conversion", "action"): []})[1] == ["conversion/checkpoint arm order mismatch: actual=[left,right], expected=[right,left]"]
    shapes = [(s, "top", [3, *x]) for s, x in (("dataset", (480, 640)), ("checkpoint", (240, 320)))]
    assert contract(spark, shapes=shapes)[2] == ["Camera top metadata shape differs"] and len(contract(spark, shapes=[*shapes[:1], ("checkpoint", "top", [3, 9, 9])])[2]) == 2


def test_monitor_logs_of_several_kinds(spark, tmp_path):
    logs = {
        "a.csv": "# action_type: delta_sequential\n# joint_names: j1, j2\ntime,obs_state_0,obs_state_10,obs_state_2,note\n0.5,1,3,2,#no comment\n1.5,,6,5,\n",
        "b.csv": "# use_delta_actions: true\ntime,control_cmd_0\n# 7,1\n2,9\n",
        "c.csv": "time,control_cmd_0\n1,2\n",
        "d.csv": "# action_type: absolute\n# use_delta_actions: True\n",
        "e.csv": "",
    }
    (tmp_path / "in").mkdir()
    for name, text in logs.items():
        (tmp_path / "in" / name).write_text(text)
    want = {
        ("a.csv", "delta_sequential", ("j1", "j2"), 0, "0.5", (1.0, 2.0, 3.0), None), ("a.csv", "delta_sequential", ("j1", "j2"), 1, "1.5", (None, 5.0, 6.0), None),
        ("b.csv", "delta_obs_t", (), 0, "# 7", None, (1.0,)), ("b.csv", "delta_obs_t", (), 1, "2", None, (9.0,)), ("c.csv", "absolute", (), 0, "1", None, (2.0,)),
    }
    of = lambda rows: {(r.path[-5:], r.action_type, tuple(r.joint_names), r.row, r["values"]["time"], *(tuple(r.vectors[k]) if k in r.vectors else None for k in ("obs_state", "control_cmd"))) for r in rows}
    root = f"file://{tmp_path}/in"
    assert of(datasets.monitor_logs(spark, root).collect()) == want
    query = datasets.monitor_logs(spark, root, stream=True).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert of(spark.read.parquet(f"{tmp_path}/out").collect()) == want
    assert next(datasets.parsed_log("x", logs["a.csv"]))[4] == {"time": "0.5", "note": "#no comment"}


def exchanges_over(df, table):
    """Exchanges of df's plan that have a scan of the table below them."""
    text = df._jdf.queryExecution().executedPlan().toString().replace("+-", "").splitlines()
    depth = [len(x) - len(x.lstrip(" :*|-")) for x in text]
    found = 0
    for i, x in enumerate(text):
        if "Exchange" in x.split("(")[0].split(",")[0]:
            below = next((k for k in range(i + 1, len(text)) if depth[k] <= depth[i]), len(text))
            found += any(table in y and "FileScan" in y for y in text[i + 1 : below])
    return found


def test_bucketed_tables_move_nothing(spark, tmp_path):
    rows = spark.range(600).select((F.col("id") % 12).alias("episode_index"), F.floor(F.col("id") / 12).alias("frame_index"), (F.col("id") * 1.0).alias("ts"), (F.col("id") * 2.0).alias("value"))
    spark.sql(f"CREATE DATABASE bucketed LOCATION 'file://{tmp_path}/db'")
    datasets.write_table(rows, "bucketed.bucketed_frames", buckets=4)
    table = spark.table("bucketed.bucketed_frames")
    assert exchanges_over(frames.reindex(table.drop("frame_index"), ["ts"], 30.0), "bucketed_frames") == 0
    assert exchanges_over(frames.reindex(rows.drop("frame_index"), ["ts"], 30.0), "Range") == 0  # the counter looks for scans alone
    left, right = table.select("episode_index", "ts"), table.filter("frame_index % 3 = 1").select("episode_index", "ts", "value")
    near = frames.nearest_asof(left, right)
    assert exchanges_over(near, "bucketed_frames") == 1  # of the two sides together; each by itself is where it belongs
    assert exchanges_over(left.hint("merge").join(right.groupBy("episode_index").count(), "episode_index"), "bucketed_frames") == 0
    plain = frames.nearest_asof(rows.select("episode_index", "ts"), rows.filter("frame_index % 3 = 1").select("episode_index", "ts", "value"))
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, plain.collect()))
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_statistics_of_parts(spark, tmp_path):
    root = f"file://{tmp_path}/set"
    part = lambda lo, hi: spark.range(lo, hi).select((F.col("id") % 7).alias("episode_index"), F.col("id").alias("frame_index"), F.array(F.pmod(F.xxhash64("id"), F.lit(97)) / 7.0, F.when(F.col("id") % 5 != 0, F.col("id") * 0.5)).alias("action"))
    datasets.append_frames(part(0, 300), root, "action", part="1")
    for f in (tmp_path / "set" / "data" / "part=1").iterdir():
        f.unlink()  # what was there can't be read again
    datasets.append_frames(part(300, 470), root, "action", part="2")
    datasets.append_frames(part(300, 500), root, "action", part="2")
    names = ["dim", "min", "max", "mean", "std", "count", "q01", "q10", "q50", "q90", "q99"]
    got, want = (sorted(tuple(r[n] for n in names) for r in df.collect()) for df in (datasets.stored_stats(spark, root, "action"), metrics.feature_stats(part(0, 500), "action")))
    assert [pytest.approx(w, rel=1e-12) for w in want] == got


def test_metadata_is_checked(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 1, [1.0]), (1, 0, [1.0, 2.0])], "episode_index long, frame_index long, action array<double>")
    features = [{"feature": "action", "dtype": "float32", "shape": [2], "names": ["a", "b"]}, {"feature": "observation.state", "dtype": "float32", "shape": [2], "names": ["a", "b"]}]
    said = lambda at: sorted(r.problem for r in datasets.metadata_problems(*datasets.read_dataset(spark, at)).collect())
    for name, declared, some in (("good", (2, 2), rows.filter("size(action) = 2")), ("bad", (3, 4), rows)):
        root = f"file://{tmp_path}/{name}"
        datasets.write_frames(some, root)
        datasets.write_metadata(spark, root, features[: 1 + (name == "bad")], fps=30, episodes=declared[0], frames=declared[1])
    assert said(f"file://{tmp_path}/good") == []
    assert said(f"file://{tmp_path}/bad") == ["3 episodes declared, 2 found", "4 frames declared, 3 found", "action: 1 vectors aren't of 2", "observation.state has no column"]
    spark.read.json(f"file://{tmp_path}/good/meta/features").withColumn("version", F.lit("0")).write.json(f"file://{tmp_path}/old/meta/features")
    datasets.write_frames(rows.filter("size(action) = 2"), f"file://{tmp_path}/old")
    assert said(f"file://{tmp_path}/old") == ["version 0"]


def test_split_and_summary_files(spark, tmp_path):
    given = spark.createDataFrame([(e, "train" if e < 5 or e == 8 else "test") for e in range(10)], "episode_index long, split string")
    path = f"file://{tmp_path}/splits"
    datasets.write_splits(given, path)
    assert sorted(map(tuple, datasets.read_splits(spark, path).collect())) == sorted(map(tuple, given.collect()))
    (tmp_path / "older.json").write_text('{\n "split_ratio": [8, 1, 1],\n "total_episodes": 4,\n "train_episodes": [0, 3],\n "val_episodes": [],\n "test_episodes": [1, 2]\n}')
    (tmp_path / "broken.json").write_text("{no json")
    assert sorted(map(tuple, datasets.read_splits(spark, f"file://{tmp_path}/*.json").collect())) == [(0, "train"), (1, "test"), (2, "test"), (3, "train")]
    rows = spark.createDataFrame([(0, "val", 1.0, 2.0, 1.0, 0.5), (1, "val", 3.0, 2.0, 1.0, 0.5), (2, "test", 5.0, 2.0, 1.0, 1.0)], "episode_index int, split_label string, mse double, mae double, rmse double, cosine double")
    datasets.write_summary(rows, f"file://{tmp_path}/summary")
    got = spark.read.json(f"file://{tmp_path}/summary").first()
    assert (got.overall.episodes, got.overall.mse.mean, got.by_split.val.mse.mean, got.by_split.val.mse.std, got.by_split.test.cosine.mean) == (3, 3.0, 2.0, 1.0, 1.0)


def test_steps_by_name(spark):
    rows = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    steps = datasets.steps_of([{"step": "drop_features", "names": ["a"]}])
    assert datasets.run_steps(rows, [{"feature": "a"}, {"feature": "b"}], steps)[0].columns == ["b", "c"]
    off = datasets.DropFeatures(["b"], is_enabled=False)
    assert datasets.run_steps(rows, [{"feature": "b"}], [off]) == (rows, [{"feature": "b"}])
    with pytest.raises(ValueError, match="no step"):
        datasets.steps_of([{"step": "unknown"}])
    with pytest.raises(ValueError, match="already"):
        datasets.register("drop_features")(datasets.DropFeatures)


def test_losses_of_poses_and_latencies(spark):
    chunks = spark.createDataFrame([(0, 0, "val", [[1.0]], [[1.0]], [[0.0]])], "episode_index int, frame_index int, split string, corrected array<array<double>>, target array<array<double>>, residual array<array<double>>")
    turn, still = [0.0, -1.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    poses = spark.createDataFrame([("val", "right", [0.1, 0.0, 0.0], [0.0, 0.0, 0.0], still, still), ("val", "left", [0.0, 0.0, 0.0], [0.0, 0.0, 0.0], turn, still)], "split string, side string, position array<double>, target_position array<double>, rotation array<double>, target_rotation array<double>")
    got = metrics.chunk_loss_terms(chunks, [1.0], [1.0], [0], poses=poses).first()
    place, angle = (0.1 / 0.05 - 0.025) / 3, math.pi / 2 / 0.25 - 0.025
    assert got.pose_loss == pytest.approx((place + angle) / 4) and got.loss == pytest.approx(0.25 * got.pose_loss)
    rows = spark.createDataFrame([("a", 0.010), ("a", 0.020), ("a", None), ("b", 0.5)], "stage string, seconds double")
    got = {r.stage: r for r in metrics.latency_summary(rows).collect()}
    assert (got["a"].n, got["a"].p50_ms, round(got["a"].p95_ms, 9), got["b"].delay_steps) == (2, 15.0, 19.5, 15)


def test_small_steps(spark, tmp_path):
    samples = spark.createDataFrame([("observation", [1.0], [2.0], [3.0]), ("action", [4.0], [5.0], [6.0]), ("other", [7.0], [8.0], [9.0])], "role string, pos array<double>, vel array<double>, eff array<double>")
    got = joints.select_features(samples, {"observation": ["pos", "eff"], "action": ["vel"]}).collect()
    assert {(r.role, *(v and v[0] for v in (r.pos, r.vel, r.eff))) for r in got} == {("observation", 1.0, None, 3.0), ("action", None, 5.0, None)}
    frame = spark.createDataFrame([(1, [1.0], "a", "old")], "index int, `observation.state` array<double>, `observation.images.top` string, task string")
    kept, lacking = joints.exclude_observations(frame, ["images.top", "images.side"])
    assert kept.columns == ["index", "observation.state", "task"] and lacking == ["images.side"]
    assert joints.override_task(frame, "new").first().task == "new"
    kinds = spark.createDataFrame([("delta", True), (None, True), (None, False), (None, None)], "action_type string, use_delta boolean")
    assert [r[0] for r in kinds.select(joints.resolve_action_type(F.col("action_type"), F.col("use_delta"))).collect()] == ["delta", "delta_obs_t", "absolute", "absolute"]
    motors = spark.createDataFrame([([(["a", "b"],), (["c"],)],)], "names array<struct<motor_names:array<string>>>")
    assert motors.select(joints.flatten_motor_names(F.col("names")).alias("n")).first().n == ["a", "b", "c"]
    stack = spark.createDataFrame([([[1.0], [2.0]],)], "s array<array<double>>")
    assert stack.select(joints.select_step(F.col("s")), joints.select_step(F.col("s"), last=False)).first() == ([2.0], [1.0])
    names = spark.createDataFrame([(n,) for n in ("right_finger_joint1.pos", "b.pos", "left_finger_joint1.pos", "a.pos")], "name string")
    assert [r.name for r in sorted(joints.display_joint_order(names).collect(), key=lambda r: r.position)] == ["a.pos", "b.pos", "left_finger_joint1.pos", "right_finger_joint1.pos"]
    first = spark.createDataFrame([(2, ["follower_r_joint9"]), (1, ["follower_r_joint2", "follower_l_joint1", "leader_r_joint1", "follower_r_joint1", "nothing"])], "seq long, name array<string>")
    roles, arms = {"follower": "observation", "leader": "action"}, {"r": "right", "l": "left"}
    assert {r.robot: r.joint_ids for r in joints.scan_joint_names(first, roles, arms).collect()} == {"right": ["joint1", "joint2"], "left": ["joint1"]}
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "topic string, seq long").write.parquet(f"file://{tmp_path}/m")
    got = datasets.read_messages(spark, f"file://{tmp_path}/m", ["a"])
    assert sorted(r.seq for r in got.collect()) == [1, 3] and "PushedFilters: [In(topic, [a])]" in got._jdf.queryExecution().executedPlan().toString().replace("EqualTo(topic,a)", "In(topic, [a])").replace("IsNotNull(topic), ", "")
    assert datasets.read_messages(spark, f"file://{tmp_path}/m").count() == 3


def test_quality_gates(spark):
    rows = [("val", "bridge", 0.5, 0.4, 0.8), ("val", "adapter", 0.3, 0.3, 1.1), ("test", "bridge", 0.5, 0.4, 0.8), ("test", "adapter", 0.3, 0.4, 1.1), ("far", "bridge", 0.5, 0.4, 0.9), ("far", "adapter", 0.3, 0.3, 1.2), ("full", "bridge", 0.5, 0.4, 0.8), ("full", "adapter", 0.3, 0.3, 1.1)]
    found = spark.createDataFrame(rows, "split string, policy string, normalized_mae double, shoulder_mae double, motion_ratio double")
    usage = spark.createDataFrame([("val", 0.05), ("test", 0.0), ("far", 0.0), ("full", 0.06)], "split string, saturation double")
    got = {r.split: r for r in metrics.quality_gates(found, usage, "adapter", "bridge").collect()}
    assert {s: r.passed for s, r in got.items()} == {"val": True, "test": False, "far": False, "full": False}
    assert (got["val"].improvement_normalized_mae, got["val"].improvement_motion_ratio) == (pytest.approx(0.2), pytest.approx(0.1))
