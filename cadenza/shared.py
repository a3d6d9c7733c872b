"""Tables in the folder that driver and executors share, and ranks over whole tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, one in the warehouse; with a
    local master, whose executor is the driver, a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        path = tempfile.mkdtemp(prefix="cadenza-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_cadenza"
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str = "stash", partition_by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and Spark knows the table's true size."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranked(df: DataFrame, name: str, *order: Column, within: str | None = None) -> DataFrame:
    """df with its 1-based rank in the given total order, or in that order among the rows of equal `within`.

    Range partitions are sorted side by side, and each gets the number of rows before it. One row a partition (and
    value of `within` in it) meets in a single task, never the rows themselves.
    """
    pid, at, low = fresh(df, "pid"), fresh(df, "at"), fresh(df, "low")
    shared_dir(df.sparkSession)
    first = [F.col(within)] if within else []
    rows = df.orderBy(*first, *order).checkpoint().withColumn(at, F.monotonically_increasing_id())
    rows = rows.withColumn(pid, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND((1 << 33) - 1))
    keys = [pid, *([within] if within else [])]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(at).alias(low))
    before = Window.partitionBy(*first).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, low, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    small = sizes if within else F.broadcast(sizes)  # without `within` one row a partition
    joined = rows.alias("r").join(small.alias("s"), same, "left")
    return joined.select("r.*", (F.col("s.rows_before") + F.col(f"r.{at}") - F.col(f"s.{low}") + 1).alias(name)).drop(pid, at)


def summed_before(df: DataFrame, name: str, value: str, *order: Column) -> DataFrame:
    """df with the sum of `value` over the rows before each in the given total order: sums within range partitions side by
    side, plus those of the partitions before. One row a partition meets in a single task."""
    pid, at = fresh(df, "pid"), fresh(df, "at")
    shared_dir(df.sparkSession)
    rows = df.orderBy(*order).checkpoint().withColumn(at, F.monotonically_increasing_id())
    rows = rows.withColumn(pid, F.shiftright(at, 33))
    sizes = rows.groupBy(pid).agg(F.sum(value).alias("n"))
    sizes = sizes.select(pid, F.coalesce(F.sum("n").over(Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("sum_before"))
    own = F.coalesce(F.sum(value).over(Window.partitionBy(pid).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("own_before", own).join(F.broadcast(sizes), pid).withColumn(name, F.col("sum_before") + F.col("own_before")).drop(pid, at, "sum_before", "own_before")
