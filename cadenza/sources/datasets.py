"""Datasets of episodes: catalogs, frames, feature tables, merging, resuming, fingerprints, metrics and reports."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.frames import reindex
from cadenza.shared import ranked


def episode_catalog(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(episode_index, path, length, modified): the files under root by sorted path, from 0. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    files = files.select("path", "length", F.col("modificationTime").alias("modified"))
    return ranked(files, "k", F.col("path")).select((F.col("k") - 1).cast("int").alias("episode_index"), "path", "length", "modified")


def read_messages(spark: SparkSession, path: str, topics: Sequence[str] | None = None) -> DataFrame:
    """Messages in Parquet; the topics are filtered where the files are read."""
    rows = spark.read.parquet(path)
    return rows if topics is None else rows.filter(F.col("topic").isin(list(topics)))


def define_features(joints: Mapping[str, Sequence[str]], cameras: Sequence[str] = (), *, shape: Sequence[int] = (480, 640, 3), velocity: bool = False, effort: bool = False) -> list[dict]:
    """The features of a dataset: state and action by the arms' sorted joints (named <arm>_<joint> with several arms),
    velocity and effort if wanted, and a picture a camera."""
    names = [f"{arm}_{j}" if len(joints) > 1 else j for arm in sorted(joints) for j in joints[arm]]
    vectors = ["observation.state", *(["observation.velocity"] if velocity else []), *(["observation.effort"] if effort else []), "action"]
    out = [{"feature": v, "dtype": "float32", "shape": [len(names)], "names": names} for v in vectors]
    return out + [{"feature": f"observation.images.{c}", "dtype": "video", "shape": list(shape), "names": ["height", "width", "channels"]} for c in cameras]


FEATURES = "feature string, dtype string, shape array<int>, names array<string>"


def features_table(spark: SparkSession, features: list[dict]) -> DataFrame:
    return spark.createDataFrame([(f["feature"], f["dtype"], f["shape"], f["names"]) for f in features], FEATURES)


def write_frames(frames: DataFrame, root: str, *, mode: str = "error") -> None:
    """Frames under root/data, by episode in order; episodes aren't split over more files than their size asks for."""
    frames.repartitionByRange("episode_index", "frame_index").sortWithinPartitions("episode_index", "frame_index").write.mode(mode).parquet(f"{root}/data")


def write_table(frames: DataFrame, table: str, *, buckets: int, mode: str = "error") -> None:
    """Frames as a table bucketed by episode and sorted within, one file a bucket: windows, sums and joins by episode over it
    move nothing (a union of two such tables moves once), and a range of episodes is pruned by the sorted files' statistics.
    Buckets bound how many tasks read it; take several a core."""
    frames.repartition(buckets, "episode_index").sortWithinPartitions("episode_index", "frame_index").write.mode(mode).bucketBy(buckets, "episode_index").sortBy("episode_index", "frame_index").saveAsTable(table)


#: The version of what write_metadata writes.
VERSION = "1"


def write_metadata(spark: SparkSession, root: str, features: list[dict], *, fps: float, episodes: int | None = None, frames: int | None = None, mode: str = "error") -> None:
    """root/meta/features as JSON lines, with fps, the version, and how many episodes and frames are declared."""
    rows = features_table(spark, features).withColumns({"fps": F.lit(float(fps)), "version": F.lit(VERSION), "total_episodes": F.lit(episodes).cast("long"), "total_frames": F.lit(frames).cast("long")})
    rows.coalesce(1).write.mode(mode).json(f"{root}/meta/features")


def read_dataset(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(frames, features) of a dataset written here."""
    return spark.read.parquet(f"{root}/data"), spark.read.schema(f"{FEATURES}, fps double, version string, total_episodes long, total_frames long").json(f"{root}/meta/features")


def metadata_problems(frames: DataFrame, features: DataFrame) -> DataFrame:
    """(problem) of a dataset as read_dataset gives it: another version, a declared number of episodes or frames that isn't
    there, a vector feature without a column, and vectors of another size than declared. None if all is well."""
    declared = features.filter("dtype <> 'video'").select("feature", F.element_at("shape", 1).alias("dim")).collect()  # a row a feature
    there = [(r.feature, r.dim) for r in declared if r.feature in frames.columns]
    sizes = [F.count_if(F.size(F.col(f"`{f}`")) != d).alias(f"s{i}") for i, (f, d) in enumerate(there)]
    counts = frames.agg(F.count_distinct("episode_index").alias("episodes"), F.count(F.lit(1)).alias("frames"), *sizes)
    said = features.agg(*(F.max(c).alias(c) for c in ("version", "total_episodes", "total_frames")))
    differs = lambda what, a, b: F.when(F.col(a) != F.col(b), F.format_string(f"%d {what} declared, %d found", a, b))
    found = [F.when(~F.col("version").eqNullSafe(F.lit(VERSION)), F.format_string("version %s", F.coalesce("version", F.lit("none")))), differs("episodes", "total_episodes", "episodes"), differs("frames", "total_frames", "frames")]
    found += [F.when(F.col(f"s{i}") > 0, F.format_string(f"{f}: %d vectors aren't of {d}", f"s{i}")) for i, (f, d) in enumerate(there)]
    found += [F.lit(f"{r.feature} has no column") for r in declared if r.feature not in frames.columns]
    return counts.join(said).select(F.explode(F.array_compact(F.array(*found))).alias("problem"))  # one row each


def append_frames(frames: DataFrame, root: str, feature: str, *, part: str) -> None:
    """Frames of new episodes as a further part of root/data, and beside them their statistics as root/meta/stats/<feature>:
    what was there before isn't read. A part that is written again replaces itself."""
    from cadenza.operators.metrics import value_counts

    frames.repartitionByRange("episode_index", "frame_index").sortWithinPartitions("episode_index", "frame_index").write.mode("overwrite").parquet(f"{root}/data/part={part}")
    new = frames.sparkSession.read.parquet(f"{root}/data/part={part}")
    value_counts(new, feature).write.mode("overwrite").parquet(f"{root}/meta/stats/{feature}/part={part}")


def stored_stats(spark: SparkSession, root: str, feature: str) -> DataFrame:
    """feature_stats of all parts by their stored statistics."""
    from cadenza.operators.metrics import stats_of_counts

    return stats_of_counts(spark.read.parquet(f"{root}/meta/stats/{feature}"))


def write_splits(splits: DataFrame, path: str, *, mode: str = "error") -> None:
    """Splits (episode_index, split) as JSON lines of ranges (split, first, last)."""
    from cadenza.operators.splits import split_ranges

    split_ranges(splits).write.mode(mode).json(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """(episode_index, split) of split files: ranges as written here, or older files, one object each with a list of episodes
    a split ({"train_episodes": [0, 1], "test_episodes": [2], "total_episodes": 3}). Both kinds may lie side by side; a file
    that is no JSON has no episodes."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    lines = text.select(F.explode(F.split("v", "\n")).alias("v")).select(F.from_json("v", "split string, first long, last long").alias("r")).filter("r.split IS NOT NULL AND r.first <= r.last").select("r.*")
    ranges = lines.select(F.explode(F.sequence("first", "last")).alias("episode_index"), "split")
    older = text.select(F.explode(F.from_json("v", "map<string,string>")).alias("key", "list")).filter(F.endswith("key", F.lit("_episodes")) & (F.col("key") != "total_episodes"))
    older = older.select(F.explode(F.from_json("list", "array<long>")).alias("episode_index"), F.regexp_replace("key", "_episodes$", "").alias("split"))
    return ranges.union(older)


def summary_report(metrics: DataFrame) -> DataFrame:
    """One row of episode metrics (episode_index, split_label, mse, mae, rmse, cosine): overall and by_split, each with the
    number of episodes, mean and population deviation of each metric."""
    both = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in ("mse", "mae", "rmse", "cosine")]
    whole = metrics.agg(F.struct(F.count(F.lit(1)).alias("episodes"), *both).alias("overall"))
    each = metrics.groupBy("split_label").agg(F.struct(F.count(F.lit(1)).alias("episodes"), *both).alias("s"))
    return whole.join(each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split_label", "s")))).alias("by_split")))  # one row each


def write_summary(metrics: DataFrame, path: str, *, mode: str = "error") -> None:
    summary_report(metrics).coalesce(1).write.mode(mode).json(path)


def merge_datasets(datasets: Sequence[DataFrame], drop: Sequence[str] = (), *, fps: float = 30.0) -> DataFrame:
    """Two or more tables of frames as one, without the dropped columns, episodes numbered on and frames again. Columns and
    types that differ are an error. Each dataset's episodes keep their order."""
    if len(datasets) < 2:
        raise ValueError("merging needs two datasets")
    parts = [d.drop(*(F.col(f"`{c}`") for c in drop if c in d.columns)) for d in datasets]
    want = sorted((f.name, f.dataType.simpleString()) for f in parts[0].schema)
    for p in parts[1:]:
        if sorted((f.name, f.dataType.simpleString()) for f in p.schema) != want:
            raise ValueError("the datasets' columns differ")
    rows = parts[0].withColumn("_part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        rows = rows.unionByName(p.withColumn("_part", F.lit(i)))
    episodes = ranked(rows.select("_part", "episode_index").distinct(), "_k", F.col("_part"), F.col("episode_index"))
    rows = rows.join(episodes, ["_part", "episode_index"]).withColumn("episode_index", (F.col("_k") - 1).cast(parts[0].schema["episode_index"].dataType))
    return reindex(rows.withColumnRenamed("frame_index", "_frame").drop("_part", "_k", "index", "timestamp"), ["_frame"], fps).drop("_frame")


def append_new_episodes(new: DataFrame, existing: DataFrame, *, by: str = "path") -> DataFrame:
    """The rows of new whose source isn't in existing."""
    return new.join(existing.select(by).distinct(), by, "left_anti")


MONITOR = "path string, action_type string, joint_names array<string>, row long, values map<string,string>, vectors map<string,array<double>>"


def parsed_log(path: str, text: str) -> Iterator[tuple]:
    """Rows as in MONITOR of one log. Its leading lines that begin with # say what it holds; later ones are rows like any."""
    lines = text.splitlines()
    n = next((i for i, x in enumerate(lines) if not x.startswith("#")), len(lines))
    action, older, names = None, False, []
    for key, _, said in (x.lstrip("#").strip().partition(":") for x in lines[:n]):
        said = said.strip()
        if key == "action_type":
            action = said
        elif key == "use_delta_actions":  # what older logs say instead
            older = said.lower() == "true"
        elif key == "joint_names":
            names = [x.strip() for x in said.split(",") if x.strip()]
    action = "delta_obs_t" if older and action in (None, "absolute") else action or "absolute"
    reader = csv.reader(lines[n:])
    header = next(reader, [])
    numbered: dict[str, list[tuple[int, int]]] = {}
    for at, c in enumerate(header):
        if found := re.fullmatch(r"(.+)_(\d+)", c):
            numbered.setdefault(found[1], []).append((int(found[2]), at))
    in_vector = {at for v in numbered.values() for _, at in v}
    for i, row in enumerate(r for r in reader if r):
        row = row + [""] * (len(header) - len(row))
        vectors = {k: [float(row[at]) if row[at] else None for _, at in sorted(v)] for k, v in numbered.items()}
        yield path, action, names, i, {c: row[at] for at, c in enumerate(header) if at not in in_vector}, vectors


def monitor_logs(spark: SparkSession, path: str, *, stream: bool = False) -> DataFrame:
    """Rows as in MONITOR of the logs under path, each with what its own file says of itself: numbered columns like
    obs_state_3 are one vector a prefix, by their number, the others are values. action_type is absolute where nothing is
    said. stream: as a stream that takes new files up. A file is one row until it is parsed, so a task holds one log."""
    reader = spark.readStream.schema("value string") if stream else spark.read
    files = reader.format("text").option("wholetext", "true").load(path).select(F.col("_metadata.file_path").alias("path"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "action_type", "joint_names", "row", "values", "vectors"]
        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.list_(pa.float64()))]
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(parsed_log(file, text or ""))
                for at in range(0, len(rows), 1 << 14):
                    cols = list(zip(*rows[at : at + (1 << 14)], strict=True))
                    arrays = [pa.array([list(v.items()) for v in c] if pa.types.is_map(k) else list(c), k) for c, k in zip(cols, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return files.mapInArrow(run, MONITOR)


def chunk_samples(frames: DataFrame, *, stride: int, size: int) -> DataFrame:
    """(episode_index, frame_index, current_state, target_chunk) of every stride-th frame."""
    from cadenza.operators.deltas import target_chunk
    from cadenza.operators.frames import stride_samples

    rows = stride_samples(target_chunk(frames, size), stride)
    return rows.select("episode_index", "frame_index", F.col("state").alias("current_state"), F.col("chunk").alias("target_chunk"))


def checked_chunks(cache: DataFrame, required: Sequence[str], *, size: int, width: int) -> DataFrame:
    """A cache of chunks as it is read; a required column that it lacks is an error, and so is a chunk of another shape."""
    lacking = set(required) - set(cache.columns)
    if lacking:
        raise ValueError(f"the cache lacks {sorted(lacking)}")
    for c in required:
        if cache.schema[c].dataType.simpleString().startswith("array<array"):
            fits = (F.size(c) == size) & F.forall(c, lambda a: F.size(a) == width)
            cache = cache.withColumn(c, F.when(F.assert_true(F.coalesce(fits, F.lit(False)), f"{c} has another shape").isNull(), F.col(c)))
    return cache


def fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of the files under path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_fingerprint(now: DataFrame, then: DataFrame) -> DataFrame:
    """(path, problem): files that are new, gone or changed."""
    rows = now.select("path", F.col("sha256").alias("a")).join(then.select("path", F.col("sha256").alias("b")), "path", "full")
    problem = F.when(F.col("b").isNull(), "new").when(F.col("a").isNull(), "gone").when(F.col("a") != F.col("b"), "changed")
    return rows.select("path", problem.alias("problem")).filter("problem IS NOT NULL")


def write_metrics(metrics: DataFrame, joint_errors: DataFrame, names: Sequence[str], path: str, *, fmt: str = "csv") -> None:
    """One row per episode with a column mae_<joint> each, as CSV or JSON."""
    wide = joint_errors.groupBy("episode_index").pivot("joint", list(range(len(names)))).agg(F.first("mae"))
    wide = wide.select("episode_index", *(F.col(str(i)).alias(f"mae_{n}") for i, n in enumerate(names)))
    writer = metrics.join(wide, "episode_index", "left").orderBy("episode_index").write
    (writer.option("header", "true").csv if fmt == "csv" else writer.json)(path)


def quality_report(topics: DataFrame, episodes: DataFrame) -> DataFrame:
    """One row per episode (episode_index, severity, passed) with its topics as structs; a robot's topics make one list."""
    own = topics.groupBy("episode_index").agg(F.array_sort(F.collect_list(F.struct("topic", "role", "message_count", "avg_fps", "coverage", "severity", "reason", "gaps"))).alias("topics"))
    return episodes.join(own, "episode_index", "left")


def write_quality_report(topics: DataFrame, episodes: DataFrame, path: str) -> None:
    quality_report(topics, episodes).write.json(path)


class Step(Protocol):
    """A transformation of frames that says what it does to their features. A step with is_enabled false is passed over."""

    name: str

    def __call__(self, frames: DataFrame) -> DataFrame: ...

    def features(self, features: list[dict]) -> list[dict]: ...


#: Steps by name, made from their settings.
REGISTRY: dict[str, Callable[..., Step]] = {}


def register(name: str) -> Callable[[Callable[..., Step]], Callable[..., Step]]:
    """Makes a step known by name; a name that is taken is an error."""

    def put(make: Callable[..., Step]) -> Callable[..., Step]:
        if name in REGISTRY:
            raise ValueError(f"there is a step {name} already")
        REGISTRY[name] = make
        return make

    return put


def steps_of(settings: Sequence[Mapping]) -> list[Step]:
    """Steps of settings [{"step": name, ...}] in order; one that isn't known is an error."""
    for one in settings:
        if one["step"] not in REGISTRY:
            raise ValueError(f"no step is called {one['step']}; there are {sorted(REGISTRY)}")
    return [REGISTRY[one["step"]](**{k: v for k, v in one.items() if k != "step"}) for one in settings]


@register("drop_features")
class DropFeatures:
    """A step that leaves out columns."""

    name = "drop_features"

    def __init__(self, names: Sequence[str], is_enabled: bool = True) -> None:
        self.names, self.is_enabled = set(names), is_enabled

    def __call__(self, frames: DataFrame) -> DataFrame:
        return frames.drop(*(F.col(f"`{n}`") for n in self.names if n in frames.columns))

    def features(self, features: list[dict]) -> list[dict]:
        return [f for f in features if f["feature"] not in self.names]


class Derive:
    """A step of one function of frames that leaves the features as they are."""

    def __init__(self, name: str, function: Callable[[DataFrame], DataFrame]) -> None:
        self.name, self.function = name, function

    def __call__(self, frames: DataFrame) -> DataFrame:
        return self.function(frames)

    def features(self, features: list[dict]) -> list[dict]:
        return features


def run_steps(frames: DataFrame, features: list[dict], steps: Sequence[Step]) -> tuple[DataFrame, list[dict]]:
    """Frames and features after all steps that are enabled, in order; two steps of one name are an error."""
    if len({s.name for s in steps}) != len(steps):
        raise ValueError("two steps have one name")
    for step in (s for s in steps if getattr(s, "is_enabled", True)):
        frames, features = frames.transform(step), step.features(features)
    return frames, features
