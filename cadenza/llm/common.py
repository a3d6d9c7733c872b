"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.shared import fresh, ranked, shared_dir, shared_path, stash

__all__ = ["WORD", "bounded", "fresh", "min_components", "ranked", "shared_dir", "shared_path", "stash", "table", "word_count"]

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes that a Python worker works on at once, however large the batches are that Spark sends.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20


def bounded(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows and, unless a single row is larger, about `most` bytes. Before the first
    and behind the last, memory that earlier tasks of this worker have left is given back."""
    give_back()
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * most / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    give_back()


def give_back() -> None:
    """Returns free memory to the system: workers stay for the next stage, and what they hold counts for their executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def min_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): (node, component), component the smallest node reachable.

    Alternates the large-star and small-star steps, which keep the number of edges and end after about log(n)
    rounds; each round is written to the shared folder. Nodes without an edge don't appear.
    """
    edges = stash(edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    for _ in range(max_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        low = both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("m"))
        large = both.join(low, F.col("a") == F.col("v")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("v"))
        small = small.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = stash(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        change = "count(1) AS n", "coalesce(bit_xor(xxhash64(a, b)), 0) AS x"
        if after.selectExpr(*change).first() == edges.selectExpr(*change).first():
            return after.selectExpr("a AS node", "b AS component").union(after.selectExpr("b", "b").distinct())
        edges = after
    raise RuntimeError("components did not settle")
