"""Joints: their names, groups and order, and vectors made of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.shared import ranked

#: Endings of camera topics, the first that fits goes.
CAMERA_ENDINGS = ("image_raw/compressed", "image/compressed", "compressed", "image_raw", "image")


def parse_joint_name(name: Column, roles: Mapping[str, str], arms: Mapping[str, str] | None = None, separator: str = "_") -> Column:
    """struct(role, robot, joint_id) of a joint's name: roles maps prefixes, the first that fits, arms the part behind it.

    Without a known prefix the role is null (rejected). With arms, a name whose arm isn't known is null altogether
    (dropped) if it has more parts; with one part or without arms the robot is ''.
    """
    arms = arms or {}
    role, rest = F.lit(None).cast("string"), F.lit(None).cast("string")
    for prefix, to in reversed(list(roles.items())):
        fits = F.startswith(name, F.lit(prefix + separator))
        role, rest = F.when(fits, to).otherwise(role), F.when(fits, F.substring(name, len(prefix) + len(separator) + 1, 1 << 30)).otherwise(rest)
    cut = F.locate(separator, rest)
    first = F.when(cut > 0, F.substring_index(rest, separator, 1)).otherwise(rest)
    behind = F.when(cut > 0, F.substring(rest, cut + len(separator), F.lit(1 << 30)))
    robot = F.coalesce(*(F.when(first == k, v) for k, v in arms.items()), F.lit(None).cast("string")) if arms else F.lit(None).cast("string")
    dropped = robot.isNull() & (cut > 0) if arms else F.lit(False)
    found = F.struct(role.alias("role"), F.coalesce(robot, F.lit("")).alias("robot"), F.when(robot.isNotNull(), F.coalesce(behind, first)).otherwise(rest).alias("joint_id"))
    return F.when(role.isNull() | ~dropped, found)


def group_joints(messages: DataFrame, roles: Mapping[str, str], arms: Mapping[str, str] | None = None, separator: str = "_") -> DataFrame:
    """(episode_index, ts, role, robot, joint_ids, pos, vel, eff) from messages (episode_index, ts, name, position,
    velocity, effort): a message's joints by role and robot, in the order of their ids. Shorter velocity or effort arrays
    leave nulls. Rejected and dropped joints don't appear. Nothing is shuffled: groups are made inside each row."""
    zipped = F.transform(
        F.arrays_zip(F.col("name").alias("n"), F.col("position").alias("p"), F.col("velocity").alias("v"), F.col("effort").alias("e")),
        lambda j: F.struct(parse_joint_name(j["n"], roles, arms, separator).alias("k"), j["p"].cast("double").alias("p"), j["v"].cast("double").alias("v"), j["e"].cast("double").alias("e")),
    )
    known = F.filter(zipped, lambda j: j["k"]["role"].isNotNull())
    groups = F.array_distinct(F.transform(known, lambda j: F.struct(j["k"]["role"].alias("role"), j["k"]["robot"].alias("robot"))))
    rows = messages.select("episode_index", "ts", known.alias("j"), F.explode(groups).alias("g"))
    own = F.array_sort(F.transform(F.filter("j", lambda j: (j["k"]["role"] == F.col("g.role")) & (j["k"]["robot"] == F.col("g.robot"))), lambda j: F.struct(j["k"]["joint_id"].alias("id"), j["p"].alias("p"), j["v"].alias("v"), j["e"].alias("e"))))
    rows = rows.select("episode_index", "ts", "g.role", "g.robot", own.alias("own"))
    part = lambda f: F.transform("own", lambda j: j[f])
    return rows.select("episode_index", "ts", "role", "robot", part("id").alias("joint_ids"), part("p").alias("pos"), part("v").alias("vel"), part("e").alias("eff"))


def scan_joint_names(messages: DataFrame, roles: Mapping[str, str], arms: Mapping[str, str] | None = None, *, observation_only: bool = True) -> DataFrame:
    """(robot, joint_ids): the sorted joints of each arm by the first message of messages (seq, name)."""
    first = messages.agg(F.min_by("name", "seq").alias("name")).select(F.explode("name").alias("n"))
    found = first.select(parse_joint_name(F.col("n"), roles, arms).alias("k")).filter("k.role IS NOT NULL")
    found = found.filter("k.role = 'observation'") if observation_only else found
    return found.groupBy("k.robot").agg(F.array_sort(F.collect_set("k.joint_id")).alias("joint_ids"))  # a robot's joints


def permuted(v: Column, order: Sequence[int]) -> Column:
    """v[order[0]], v[order[1]], ..."""
    return F.transform(F.array(*map(F.lit, order)), lambda i: F.element_at(v, i + 1))


def reorder_command(data: Column, joint_order: Sequence[str] | None) -> Column:
    """A command given in joint_order, in the order of the sorted names; as it is without an order or at another length."""
    if not joint_order:
        return data
    order = sorted(range(len(joint_order)), key=lambda i: joint_order[i])
    return F.when(F.size(data) == len(order), permuted(data, order)).otherwise(data)


def reorder_joints(v: Column, have: Sequence[str], want: Sequence[str]) -> Column:
    """v, in the order `have`, in the order `want`; as it is where lengths differ or a name is missing."""
    if len(have) != len(want) or set(have) - set(want) or len(set(have)) != len(have):
        return v
    place = {n: i for i, n in enumerate(have)}
    return F.when(F.size(v) == len(have), permuted(v, [place[n] for n in want])).otherwise(v)


def map_action_to_state(actions: Sequence[str] | None, states: Sequence[str] | None, excluded: Sequence[str] = (), sizes: tuple[int, int] | None = None) -> list[int | None]:
    """For each action joint the place of the state joint of its name, null for an excluded one that has none. A missing
    name is an error; without names both sizes must agree."""
    if not actions or not states:
        if sizes is None or sizes[0] != sizes[1]:
            raise ValueError("without names, actions and states must have one size")
        return list(range(sizes[0]))
    place = {n: i for i, n in enumerate(states)}
    lacking = [n for n in actions if n not in place and n not in set(excluded)]
    if lacking:
        raise ValueError(f"no state for {lacking}")
    return [place.get(n) for n in actions]


def joint_groups(names: Sequence[str]) -> tuple[list[int], list[int]]:
    """(arm, gripper) places: grippers have the word in their name. No arm joint is an error."""
    gripper = [i for i, n in enumerate(names) if "gripper" in n.lower()]
    arm = [i for i in range(len(names)) if i not in gripper]
    if not arm:
        raise ValueError("no arm joint")
    return arm, gripper


def shoulder_mask(name: Column) -> Column:
    return name.rlike(r"joint_[123]\.")


def display_joint_order(joints: DataFrame) -> DataFrame:
    """joints (name) with position, from 0, in a display's order: finger joints last, each part sorted."""
    rows = ranked(joints, "position", F.contains("name", F.lit("finger_joint1")), F.col("name"))
    return rows.withColumn("position", F.col("position") - 1)


def concat_arms(samples: DataFrame, arms: Sequence[str], values: Sequence[str] = ("observation", "action")) -> DataFrame:
    """(episode_index, frame_index, *values): the arms' vectors one behind the other, by sorted arm, of the frames in which
    every arm has all values. samples: (episode_index, frame_index, robot, *values)."""
    some = samples.filter(F.col("robot").isin(*arms))
    for v in values:
        some = some.filter(F.col(v).isNotNull())
    joined = lambda v: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("robot", v))), lambda s: s[v])).alias(v)
    out = some.groupBy("episode_index", "frame_index").agg(F.count_distinct("robot").alias("n_arms"), *map(joined, values))
    return out.filter(F.col("n_arms") == len(set(arms))).drop("n_arms")


def select_features(samples: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """samples (role, pos, vel, eff, ...) with only the fields named for a row's role; the others are null."""
    out = samples
    for c in ("pos", "vel", "eff"):
        roles = [r for r, kept in fields.items() if c in kept]
        out = out.withColumn(c, F.when(F.col("role").isin(*roles), F.col(c)) if roles else F.lit(None).cast(samples.schema[c].dataType))
    return out.filter(F.col("role").isin(*fields))


def camera_name(topic: Column) -> Column:
    """A camera topic's short name."""
    name = F.regexp_replace(topic, "^/+", "")
    cut = F.coalesce(*(F.when(F.endswith(name, F.lit(e)), F.regexp_replace(name, e + "$", "")) for e in CAMERA_ENDINGS), name)
    short = F.regexp_replace(F.replace(cut, F.lit("/"), F.lit("_")), "_+$", "")
    return F.when(short == "", "camera").otherwise(short)


def flatten_motor_names(names: Column) -> Column:
    """Names given as groups (motor_names), as one list."""
    return F.flatten(F.transform(names, lambda n: n["motor_names"]))


def exclude_observations(frames: DataFrame, endings: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """frames without observation.<ending> columns, and the endings that there are none of."""
    names = {f"observation.{e}": e for e in endings}
    return frames.drop(*(F.col(f"`{n}`") for n in names if n in frames.columns)), [e for n, e in names.items() if n not in frames.columns]


def override_task(frames: DataFrame, text: str) -> DataFrame:
    return frames.withColumn("task", F.lit(text))


def resolve_action_type(action_type: Column, use_delta: Column) -> Column:
    """The action type; where there is none, the older flag says delta_obs_t or absolute."""
    return F.coalesce(action_type, F.when(use_delta, "delta_obs_t").otherwise("absolute"))


def select_step(stack: Column, *, last: bool = True) -> Column:
    """The last (or first) of stacked observations."""
    return F.element_at(stack, -1 if last else 1)


def letterbox_geometry(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """struct(scale, new_width, new_height, offset_x, offset_y, wasted) of a picture fitted into a canvas."""
    scale = F.least(to_width / width, to_height / height)
    w, h = F.floor(width * scale).cast("int"), F.floor(height * scale).cast("int")
    wasted = 1 - (w * h) / F.lit(float(to_width * to_height))
    return F.struct(scale.alias("scale"), w.alias("new_width"), h.alias("new_height"), F.floor((to_width - w) / 2).cast("int").alias("offset_x"), F.floor((to_height - h) / 2).cast("int").alias("offset_y"), wasted.alias("wasted"))


def acceptance(rows: DataFrame, reason: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows and the share that is accepted (reason null), per group."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg(reason.isNull().cast("int")).alias("accepted"))


def first_rows(rows: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each group."""
    k = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("k", k).filter(F.col("k") <= n).drop("k")
