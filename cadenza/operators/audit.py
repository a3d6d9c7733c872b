"""Contracts between a dataset, a checkpoint and a runtime, checks of frames, and the structure of messages."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.joints import first_rows


@dataclass(frozen=True)
class Rule:
    """Two facts, each 'side.kind', that must be equal: in order or as sets. optional: only where the left one is stated."""

    label: str
    left: str
    right: str
    how: str = "ordered"
    optional: bool = False
    error: bool = True

    def problem(self, facts: Column) -> Column:
        """The rule's text where it is broken, else null. A fact that isn't stated is empty."""
        left, right = (F.coalesce(F.try_element_at(facts, F.lit(k)), F.array().cast("array<string>")) for k in (self.left, self.right))
        a, b = (left, right) if self.how == "ordered" else (F.array_sort(F.array_distinct(left)), F.array_sort(F.array_distinct(right)))
        broken = (a != b) & (F.size(left) > 0) if self.optional else a != b
        return F.when(broken, F.format_string("%s mismatch: actual=[%s], expected=[%s]", F.lit(self.label), F.array_join(left, ","), F.array_join(right, ",")))


#: The contract of a dataset, a checkpoint and a runtime.
CONTRACT = (
    Rule("dataset action/state names", "dataset.action", "dataset.state"),
    Rule("checkpoint/dataset action names", "checkpoint.action", "dataset.action"),
    Rule("relative processor/dataset action names", "processor.action", "dataset.action"),
    Rule("runtime/checkpoint arm order", "runtime.arms", "checkpoint.arms"),
    Rule("checkpoint/dataset camera roles", "checkpoint.cameras", "dataset.cameras", "set"),
    Rule("runtime/checkpoint camera roles", "runtime.cameras", "checkpoint.cameras", "set"),
    Rule("conversion/checkpoint arm order", "conversion.arms", "checkpoint.arms", optional=True),
    Rule("conversion/checkpoint feature names", "conversion.action", "checkpoint.action", optional=True),
)


def arm_order(names: Column) -> Column:
    """The arms of joint names like right_joint_1.pos, in the order of their first joints."""
    return F.array_distinct(F.transform(names, lambda n: F.substring_index(n, "_", 1)))


def slice_problems(arms: Column, slices: Column, dim: Column) -> Column:
    """What is wrong with the slices (a map of arm to start and end) of the arms in order: one that is missing, that doesn't
    begin where the one before ended, or is empty; and an end that isn't the dimension. A missing arm is passed over."""
    state = F.struct(F.lit(0).cast("long").alias("due"), F.array().cast("array<string>").alias("said"))

    def step(now: Column, arm: Column) -> Column:
        one = F.try_element_at(slices, arm)
        start, end = F.coalesce(one["start"], F.lit(-1)), F.coalesce(one["end"], F.lit(-1))
        broken = F.when((start != now["due"]) | (end <= start), F.format_string("Non-contiguous action slice for %s: [%d, %d), expected start %d", arm, start, end, now["due"]))
        text = F.when(one.isNull(), F.format_string("Missing runtime arm configuration for %s", arm)).otherwise(broken)
        return F.struct(F.when(one.isNull(), now["due"]).otherwise(end).alias("due"), F.when(text.isNull(), now["said"]).otherwise(F.concat(now["said"], F.array(text))).alias("said"))

    end = F.aggregate(arms, state, step)
    short = F.when(~end["due"].eqNullSafe(dim), F.format_string("Runtime arm slices cover %d actions, checkpoint expects %s", end["due"], F.coalesce(dim.cast("string"), F.lit("none"))))
    return F.concat(end["said"], F.array(short))


def contract_audit(
    facts: DataFrame, *, rules: Sequence[Rule] = CONTRACT, numbers: DataFrame | None = None, slices: DataFrame | None = None, flags: DataFrame | None = None, shapes: DataFrame | None = None
) -> DataFrame:
    """(pair_id, status, errors, warnings) of all pairs in facts (pair_id, side, kind, names): status is error,
    pass_with_warnings or pass. A fact stated twice in different words is an error when it is read; arms of a checkpoint that
    aren't stated follow from its action names.

    numbers (pair_id, name, value): state_dim must be action_dim, action_dim the number of the dataset's actions, and the
    runtime's joints times its arms. slices (pair_id, arm, start, end): those of the runtime's arms must follow one another
    and cover action_dim. flags (pair_id, name, value): relative actions (use_relative_actions, relative_enabled,
    absolute_enabled) must be made and undone; rtc_enabled, and async_prefetch that is off, only warn. shapes (pair_id,
    side, camera, shape): of dataset and checkpoint, ones that differ warn, and once more if the aspect does.

    Everything of a pair meets in one row, of a size that a contract has."""
    rows = facts.withColumn("names", F.coalesce("names", F.array().cast("array<string>"))).select("pair_id", F.struct(F.concat_ws(".", "side", "kind").alias("key"), "names").alias("e"))
    rows = rows.groupBy("pair_id").agg(F.map_from_entries(F.collect_set("e")).alias("facts"))
    known = F.coalesce(F.try_element_at("facts", F.lit("checkpoint.arms")), arm_order(F.coalesce(F.try_element_at("facts", F.lit("checkpoint.action")), F.array().cast("array<string>"))))
    rows = rows.withColumn("facts", F.map_concat(F.map_filter("facts", lambda k, v: k != "checkpoint.arms"), F.create_map(F.lit("checkpoint.arms"), known)))

    def with_map(rows: DataFrame, table: DataFrame, key: str, value: Column, name: str) -> DataFrame:
        own = table.groupBy("pair_id").agg(F.map_from_entries(F.collect_set(F.struct(F.col(key).alias("k"), value.alias("v")))).alias(name))
        return rows.join(own, "pair_id", "left")

    of = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    listed = lambda k: F.coalesce(of("facts", k), F.array().cast("array<string>"))
    errors, warnings = [F.array(*(r.problem(F.col("facts")) for r in rules if r.error)).cast("array<string>")], [F.array(*(r.problem(F.col("facts")) for r in rules if not r.error)).cast("array<string>")]
    if numbers is not None:
        rows = with_map(rows, numbers, "name", F.col("value").cast("long"), "numbers")
        state, action = of("numbers", "state_dim"), of("numbers", "action_dim")
        errors.append(F.array(
            F.when(~state.eqNullSafe(action), F.lit("checkpoint state/action dimensions mismatch")), F.when(~action.eqNullSafe(F.size(listed("dataset.action")).cast("long")), F.lit("checkpoint/dataset action dimension mismatch")),
            F.when(~action.eqNullSafe((F.size(listed("runtime.joints")) * F.size(listed("runtime.arms"))).cast("long")), F.lit("Runtime joint order multiplied by arm count does not match checkpoint action dimension")),
        ))
        if slices is not None:
            rows = with_map(rows, slices, "arm", F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")), "slices")
            empty = F.create_map().cast("map<string,struct<start:bigint,end:bigint>>")
            errors.append(slice_problems(listed("runtime.arms"), F.coalesce("slices", empty), action))
    if flags is not None:
        rows = with_map(rows, flags, "name", F.col("value"), "flags")
        on = lambda k: F.coalesce(of("flags", k), F.lit(False))
        errors.append(F.array(F.when(on("use_relative_actions") & ~on("relative_enabled"), F.lit("relative actions are asked for but never made")), F.when(on("relative_enabled") & ~on("absolute_enabled"), F.lit("relative actions are never made absolute"))))
        warnings.append(F.array(F.when(on("rtc_enabled"), F.lit("RTC is enabled")), F.when(~on("async_prefetch"), F.lit("Synchronous prefetch is disabled"))))
    if shapes is not None:
        own = shapes.groupBy("pair_id", "camera").agg(F.max_by("shape", F.col("side") == "dataset").alias("d"), F.max_by("shape", F.col("side") == "checkpoint").alias("c"), F.count_distinct("side").alias("n"))
        ratio = lambda v: F.round(F.element_at(v, -1) / F.element_at(v, -2), 6)
        own = own.filter("n = 2 AND c <> d").withColumn("said", F.array(F.format_string("Camera %s metadata shape differs", "camera"), F.when(ratio(F.col("c")) != ratio(F.col("d")), F.format_string("Camera %s aspect ratio differs", "camera"))))
        rows = rows.join(own.groupBy("pair_id").agg(F.array_sort(F.flatten(F.collect_list("said"))).alias("shapes")), "pair_id", "left")
        warnings.append(F.coalesce("shapes", F.array().cast("array<string>")))
    rows = rows.withColumns({"errors": F.array_compact(F.concat(*errors)), "warnings": F.array_compact(F.concat(*warnings))})
    status = F.when(F.size("errors") > 0, "error").when(F.size("warnings") > 0, "pass_with_warnings").otherwise("pass")
    return rows.select("pair_id", status.alias("status"), "errors", "warnings")


def validate_frames(frames: DataFrame, dims: Mapping[str, int]) -> DataFrame:
    """One row per episode: frames, and how many break a rule: a vector that is null, has another size or isn't finite; a
    frame_index that isn't the next one; valid if none does."""
    order = Window.partitionBy("episode_index").orderBy("frame_index")
    due = F.coalesce(F.lag("frame_index").over(order) + 1, F.lit(0))
    rows = frames.withColumn("_skips", F.col("frame_index") != due)
    size = {c: F.count_if(F.col(c).isNotNull() & (F.size(c) != n)).alias(f"{c}_size") for c, n in dims.items()}
    null = {c: F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in dims}
    odd = {c: F.count_if(F.exists(c, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))).alias(f"{c}_not_finite") for c in dims}
    out = rows.groupBy("episode_index").agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("_skips")).alias("index_skips"), *null.values(), *size.values(), *odd.values())
    counters = [c for c in out.columns if c not in ("episode_index", "frames")]
    return out.withColumn("valid", sum((F.col(c) for c in counters), F.lit(0)) == 0)


def value_kind(v: Any) -> str:
    """What a JSON value is: None, object, list, or the name of its type."""
    return "None" if v is None else {dict: "object", list: "list"}.get(type(v), type(v).__name__)


def fields_of(value: dict, prefix: str = "") -> Iterator[tuple[str, str, int | None]]:
    """(field, type, length) of an object's fields and of those within them."""
    for key, v in value.items():
        name, kind = f"{prefix}{key}", value_kind(v)
        if kind == "list":
            yield name, f"List[{value_kind(v[0])}]" if v else "List[empty]", len(v)
        else:
            yield name, kind, None
        inner, into = (v, f"{name}.") if kind == "object" else (v[0], f"{name}[0].") if kind == "list" and v else (None, "")
        if isinstance(inner, dict):
            yield from fields_of(inner, into)


def message_structure(messages: DataFrame, *, samples: int = 5) -> DataFrame:
    """(topic, field, type, samples, length, first_ts, last_ts): what the fields of the first messages (topic, seq,
    payload_json, and ts if there is one) of each topic hold. Fields of objects are named a.b, those of a list's first object
    a[0].b, however deep. Types: None, bool, int, float, str, object, List[of the first element's] or List[empty], and
    where samples disagree all of them in the order of their first samples, with | between; length is that of the list in
    the first sample that has one; the times are those of the topic's first and last sample. Texts that aren't JSON objects
    have no fields. Only the sampled texts are parsed."""
    ts = F.col("ts") if "ts" in messages.columns else F.lit(None).cast("double")
    some = first_rows(messages.select("topic", "seq", "payload_json", ts.alias("ts")), ["topic"], ["seq"], samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for topic, seq, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    value = json.loads(text) if text else None
                except ValueError:
                    continue
                out += [(topic, seq, *f) for f in fields_of(value)] if isinstance(value, dict) else []
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["topic", "seq", "field", "type", "length"])

    rows = some.select("topic", F.col("seq").cast("long"), "payload_json").mapInArrow(run, "topic string, seq long, field string, type string, length long")
    seen = F.array_sort(F.collect_list(F.struct("seq", "type", "length")))  # `samples` at most
    out = rows.groupBy("topic", "field").agg(seen.alias("s"))
    times = some.groupBy("topic").agg(F.min_by("ts", "seq").alias("first_ts"), F.max_by("ts", "seq").alias("last_ts"))
    length = F.get(F.filter(F.transform("s", lambda x: x["length"]), lambda n: n.isNotNull()), F.lit(0))
    return out.select("topic", "field", F.array_join(F.array_distinct(F.transform("s", lambda x: x["type"])), " | ").alias("type"), F.size("s").alias("samples"), length.alias("length")).join(times, "topic")


def latest_image_per_camera(images: DataFrame, roles: DataFrame) -> DataFrame:
    """(role, status, path, width, height, aspect): the newest image (role, path, modified, width, height) of each role, or
    'missing'. Equally new ones: the last path."""
    newest = images.groupBy("role").agg(F.max_by(F.struct("path", "width", "height"), F.struct("modified", "path")).alias("i"))
    rows = roles.select("role").distinct().join(newest, "role", "left")
    return rows.select("role", F.when(F.col("i").isNull(), "missing").otherwise("found").alias("status"), "i.path", "i.width", "i.height", (F.col("i.width") / F.col("i.height")).alias("aspect"))
