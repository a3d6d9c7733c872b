"""Running values over very long keys: the rows of one key are spread over range partitions, each partition works on its own
rows, and one row a partition carries what came before (or comes after) into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.shared import fresh, shared_dir

#: Rows of one key that a task of `overlapping` works on.
BLOCK = 1 << 20


class Segments:
    """df sorted by key and order over range partitions, and checkpointed, so that a partition is the same rows whenever it
    is read. A null key is a key. `rows` has all columns that `running` has added."""

    def __init__(self, df: DataFrame, by: str, *order: Column) -> None:
        self.by, self.pid, self.at = by, fresh(df, "segment"), fresh(df, "place")
        shared_dir(df.sparkSession)
        rows = df.orderBy(by, *order).checkpoint().withColumn(self.at, F.monotonically_increasing_id())
        self.kept = rows.withColumn(self.pid, F.shiftright(self.at, 33))

    @property
    def rows(self) -> DataFrame:
        return self.kept.drop(self.pid, self.at)

    def running(self, **values: tuple[str, Column] | tuple[str, Column, int]) -> Segments:
        """Adds columns: the running 'sum', 'min' or 'max' of a value, the 'last' one that isn't null up to a row, or the 'next'
        one from it on. A third item of 1 leaves the row itself out."""
        order = Window.partitionBy(self.pid, self.by).orderBy(self.at)
        back = Window.partitionBy(self.pid, self.by).orderBy(F.desc(self.at))
        before = Window.partitionBy(self.by).orderBy(self.pid).rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(self.by).orderBy(F.desc(self.pid)).rowsBetween(Window.unboundedPreceding, -1)
        simple = {"sum": F.sum, "min": F.min, "max": F.max}
        totals, carries, locals_ = [], [], {}
        for name, (kind, value, *skip) in values.items():
            window = (back if kind == "next" else order).rowsBetween(Window.unboundedPreceding, -1 if skip and skip[0] else 0)
            if kind in simple:
                totals.append(simple[kind](value).alias(f"t_{name}"))
                carries.append(simple[kind](f"t_{name}").over(before).alias(f"c_{name}"))
                locals_[f"l_{name}"] = simple[kind](value).over(window)
            else:
                known, pick = F.when(value.isNotNull(), F.col(self.at)), F.min_by if kind == "next" else F.max_by
                totals.append(pick(value, known).alias(f"t_{name}"))
                carries.append(F.last(f"t_{name}", ignorenulls=True).over(after if kind == "next" else before).alias(f"c_{name}"))
                locals_[f"l_{name}"] = F.last(value, ignorenulls=True).over(window)
        sums = self.kept.groupBy(self.pid, self.by).agg(*totals).select(self.pid, self.by, *carries)
        r, s = self.kept.alias("r"), sums.alias("s")
        joined = r.join(s, (F.col(f"r.{self.pid}") == F.col(f"s.{self.pid}")) & F.col(f"r.{self.by}").eqNullSafe(F.col(f"s.{self.by}")), "left")
        rows = joined.select("r.*", *(f"s.c_{n}" for n in values)).withColumns(locals_)
        for name, (kind, *_) in values.items():
            here, carry = F.col(f"l_{name}"), F.col(f"c_{name}")
            both = {"sum": F.coalesce(here + carry, here, carry), "min": F.least(here, carry), "max": F.greatest(here, carry)}.get(kind, F.coalesce(here, carry))
            rows = rows.withColumn(name, both)
        self.kept = rows.drop(*(f"{k}_{n}" for n in values for k in "lc"))
        return self


def overlapping(df: DataFrame, position: str, rows_before: int, *, block: int = BLOCK) -> DataFrame:
    """df with block and ghost: rows are dealt to blocks by their position in their key, and the last `rows_before` rows of a
    block are also in the next one, as ghosts, for windows that look back."""
    own = F.floor(F.col(position) / block)
    both = F.array(F.struct(own.alias("block"), F.lit(False).alias("ghost")), F.when(F.col(position) % block >= block - rows_before, F.struct((own + 1).alias("block"), F.lit(True).alias("ghost"))))
    return df.withColumn("b", F.explode(F.array_compact(both))).withColumns({"block": F.col("b.block"), "ghost": F.col("b.ghost")}).drop("b")
