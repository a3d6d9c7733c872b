"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part: an id, and a vector without null or non-finite components that isn't zero.

    Vectors of another length than most have take no part either; of lengths equally frequent the smaller one counts.
    """
    x = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))).filter(F.exists(x, lambda c: c != 0))
    most = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    return rows.filter(F.size(x) == (most["d"] if most else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column without nulls, in double precision."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in x], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)
