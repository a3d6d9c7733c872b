"""Reproducible splits and samples of episodes. Members follow a seeded hash of the episode, so they don't depend on order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.shared import ranked

SPLITS = ("train", "val", "test")


def draw(seed: int, of: str = "episode_index") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(of).cast("string")))


def split_counts(n: int, ratio: tuple[float, ...]) -> tuple[int, int, int]:
    """Episodes for training, validation and test: the latter two half-even shares, training the rest."""
    if n < 1 or len(ratio) not in (2, 3) or sum(ratio) <= 0:
        raise ValueError("a split needs an episode and two or three ratios that aren't all zero")
    val, test = (round(n * r / sum(ratio)) for r in (*ratio[1:], 0)[:2])
    return max(0, n - val - test), val, test


def at_least_one(n: int, ratio: tuple[float, ...]) -> tuple[int, int, int]:
    """As split_counts, but validation and test have one episode at least if their ratio isn't zero; a sum of zero is all
    training."""
    if sum(ratio) <= 0:
        return n, 0, 0
    val, test = (max(1, round(n * r / sum(ratio))) if r > 0 else 0 for r in (*ratio[1:], 0)[:2])
    return n - val - test, val, test


def cut(rank: Column, counts: tuple[int, int, int]) -> Column:
    train, val, _ = counts
    return F.when(rank <= train, "train").when(rank <= train + val, "val").otherwise("test")


def split_episodes(episodes: DataFrame, *, ratio: tuple[float, ...] = (8, 1, 1), seed: int = 42, max_episodes: int | None = None) -> DataFrame:
    """(episode_index, split): ranks by a seeded hash, cut where the counts say. With max_episodes only so many are drawn
    first, and split."""
    rows = ranked(episodes.select("episode_index"), "k", draw(seed), F.col("episode_index"))
    n = episodes.count()
    if max_episodes is not None and max_episodes < n:
        rows, n = rows.filter(F.col("k") <= max_episodes), max_episodes
    return rows.select("episode_index", cut(F.col("k"), split_counts(n, ratio)).alias("split"))


def default_split(episodes: DataFrame, *, seed: int = 42) -> DataFrame:
    """8:1:1 by the seeded hash with an episode at least for validation and test."""
    rows = ranked(episodes.select("episode_index"), "k", draw(seed), F.col("episode_index"))
    return rows.select("episode_index", cut(F.col("k"), at_least_one(episodes.count(), (8, 1, 1))).alias("split"))


def contiguous_split(episodes: DataFrame, *, ratio: tuple[float, ...] = (8, 1, 1)) -> DataFrame:
    """Ranges of the episodes in order: training first, then validation, then test."""
    rows = ranked(episodes.select("episode_index"), "k", F.col("episode_index"))
    return rows.select("episode_index", cut(F.col("k"), at_least_one(episodes.count(), ratio)).alias("split"))


def subsample_episodes(episodes: DataFrame, most: int, *, seed: int = 42) -> DataFrame:
    """At most so many episodes, by the seeded hash."""
    return ranked(episodes.select("episode_index"), "k", draw(seed), F.col("episode_index")).filter(F.col("k") <= most).drop("k")


def sample_per_split(splits: DataFrame, n: int, *, seed: int = 42, split: str = "all") -> DataFrame:
    """At most n episodes of each split (or of the one named) of splits (episode_index, split)."""
    some = splits.filter(F.col("split").isin(*SPLITS)) if split == "all" else splits.filter(F.col("split") == split)
    return ranked(some, "k", draw(seed), F.col("episode_index"), within="split").filter(F.col("k") <= n).select("episode_index", "split")


def expand_ranges(ranges: DataFrame) -> DataFrame:
    """(episode_index, split) from rows (split, first, last) with both ends included."""
    return ranges.select(F.explode(F.sequence("first", "last")).alias("episode_index"), "split")


def split_ranges(splits: DataFrame) -> DataFrame:
    """(split, first, last): splits as ranges of consecutive episodes."""
    island = ranked(splits, "k", F.col("episode_index"), within="split").withColumn("island", F.col("episode_index") - F.col("k"))
    return island.groupBy("split", "island").agg(F.min("episode_index").alias("first"), F.max("episode_index").alias("last")).drop("island")


def split_problems(splits: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode_index, problem): episodes in several splits or twice in one, in none, or unknown."""
    times = splits.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))
    rows = episodes.select("episode_index", F.lit(True).alias("known")).join(times, "episode_index", "full")
    problem = F.when(F.col("known").isNull(), "unknown").when(F.col("n").isNull(), "unassigned").when(F.col("n") > 1, "repeated")
    return rows.select("episode_index", problem.alias("problem")).filter("problem IS NOT NULL")


def attach_split(rows: DataFrame, splits: DataFrame, *, manual: DataFrame | None = None, episodes: DataFrame | None = None) -> DataFrame:
    """rows with split; episodes listed in manual (episode_index) that no split has are 'manual'. With episodes given, an
    episode that isn't in exactly one split is an error."""
    if episodes is not None:
        bad = split_problems(splits, episodes).limit(5).collect()
        if bad:
            raise ValueError(f"not exactly one split: {[tuple(r) for r in bad]}")
    if manual is not None:
        splits = splits.unionByName(manual.select("episode_index", F.lit("manual").alias("split")).join(splits, "episode_index", "left_anti"))
    return rows.join(splits, "episode_index", "left")


def spec_ranges(spec: str, total: int, *, base: int = 0) -> list[tuple[int, int]]:
    """Half-open ranges of a text like '1,3:5,8': numbers and ranges without their end, counted from `base`; open ranges go to
    either end. Out of bounds, empty ranges and other texts are errors."""
    out = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        first, colon, last = (x.strip() for x in part.partition(":"))
        lo = int(first) if first or not colon else base
        hi = (int(last) if last else total + base) if colon else lo + 1
        if lo >= hi or lo < base or hi > total + base:
            raise ValueError(f"{part} isn't within episodes {base} to {total + base - 1}")
        out.append((lo, hi))
    return out


def episode_spec(spec: str, total: int, *, base: int = 0) -> list[int]:
    """The episodes of spec_ranges, sorted, once each."""
    return sorted({i for lo, hi in spec_ranges(spec, total, base=base) for i in range(lo, hi)})


def select_episodes(rows: DataFrame, spec: str, total: int, *, base: int = 0, skip: bool = False) -> DataFrame:
    """rows of the episodes in the text, or of the others; a predicate a range, which files are pruned by."""
    wanted = F.lit(False)
    for lo, hi in spec_ranges(spec, total, base=base):
        wanted = wanted | ((F.col("episode_index") >= lo - base) & (F.col("episode_index") < hi - base))
    return rows.filter(~wanted if skip else wanted)


def limit_episodes(rows: DataFrame, n: int) -> DataFrame:
    return rows.filter(F.col("episode_index") < n)


def filter_by_quality(rows: DataFrame, report: DataFrame, *, worst: str = "warning") -> DataFrame:
    """rows without the episodes whose severity in report (episode_index, severity) is beyond `worst`."""
    rank = {"pass": 1, "warning": 2, "critical": 3}
    bad = [s for s, k in rank.items() if k > rank[worst]]
    return rows.join(report.filter(F.col("severity").isin(bad)).select("episode_index"), "episode_index", "left_anti")


def available_episodes(plan: DataFrame, recordings: DataFrame) -> tuple[DataFrame, int]:
    """The plan's rows that have a recording (episode_index), and how many were skipped."""
    have = recordings.select("episode_index").distinct()
    return plan.join(have, "episode_index", "left_semi"), plan.join(have, "episode_index", "left_anti").count()
