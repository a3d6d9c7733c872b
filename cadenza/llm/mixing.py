"""Mixing sources to target weights: every document is repeated so that each source comes near its share of the words.

DataFrame functions only. One row per source is what the water level is computed from; texts stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import fresh, stash, word_count

#: Weights of the sources in code point order, repeating; a source gives at most CAP times its words.
WEIGHTS, CAP, SEED = (1, 2, 3), 3, 42


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Targets share the sum of all sizes by weight; none passes cap times its source's size. The excess goes to the
    rest by weight, which is the water level found in one pass over the sources in order of cap to weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = totals.withColumn("w", weight.cast("long")).withColumn("most", F.col("source_size") * cap)
    filling = Window.orderBy((F.col("most") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    rows = (
        rows.withColumn("total", F.sum("source_size").over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("full", F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("n", F.row_number().over(filling))
        .withColumn("open", F.col("most") * F.col("w_left") > (F.col("total") - F.col("full")) * F.col("w"))
    )
    first = F.min(F.when(F.col("open"), F.struct("n", F.col("total").alias("t"), F.col("full").alias("f"), F.col("w_left").alias("l")))).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = rows.withColumn("level", first)
    shared = (F.col("level.t") - F.col("level.f")).cast("double") * F.col("w") / F.col("level.l")
    return rows.select("source", "source_size", F.when(F.col("n") >= F.col("level.n"), shared).otherwise(F.col("most").cast("double")).alias("target"))


def with_copies(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """docs with the columns of the plan, and the names those got: size, source_size, target, copies.

    keep: False leaves id and source alone of the documents' own columns. A null text has size 0; a null source is a
    source of its own, the last; rows with the same id draw the same. Own columns of the same names stay as they are.
    """
    names: dict[str, str] = {}
    for x in ("size", "source_size", "target", "copies", "of_source"):
        names[x] = fresh(docs, x) if keep else x
    docs = docs if keep else docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    if keep:
        docs = docs.withColumn(names["size"], word_count(F.col(text_col)))
    else:
        docs, id_col, source_col = stash(docs, "sizes"), "doc_id", "source"
    sizes = docs.select(F.col(source_col).alias("source"), F.col(names["size"]).alias("size"))
    targets = stash(source_targets(sizes, weights, cap), "targets")  # its size is known: Spark broadcasts it if small
    targets = targets.select(F.col("source").alias(names["of_source"]), F.col("source_size").alias(names["source_size"]), F.col("target").alias(names["target"]))
    rate = F.when(F.col(names["source_size"]) > 0, F.col(names["target"]) / F.col(names["source_size"])).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    out = docs.join(targets, F.col(source_col).eqNullSafe(F.col(names["of_source"])), "left")
    return out.withColumn(names["copies"], copies).drop(names["of_source"]), names


def mixing_plan(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target (of its source), copies, taken."""
    out, _ = with_copies(docs, keep=False, **options)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it, in the columns of docs. Empty documents (size 0) draw too."""
    out, names = with_copies(docs, **options)
    n = fresh(out, "n")
    out = out.filter(F.col(names["copies"]) > 0).withColumn(n, F.explode(F.array_repeat(F.lit(0), F.col(names["copies"]).cast("int"))))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, source_size * 3 AS most FROM totals
), filled AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(most) OVER (ORDER BY most / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled_before,
    sum(w) OVER (ORDER BY most / w, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
    row_number() OVER (ORDER BY most / w, source ASC NULLS LAST) AS n
  FROM weighted
), level AS (
  SELECT n AS from_n, (total - filled_before)::DOUBLE AS left_over, w_left::DOUBLE AS left_weight FROM filled
  WHERE most * w_left > (total - filled_before) * w ORDER BY n LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN n >= from_n THEN left_over * w / left_weight ELSE most::DOUBLE END AS target FROM filled LEFT JOIN level ON true
), rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('42:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated
"""
