"""Quality classifier by importance resampling: how much likelier a text is under a model of the good texts than under
one of the raw texts, and a Gumbel top-k draw of the documents by that weight.

Both models are bags of hashed n-grams (words, punctuation runs and pairs of them). The raw model counts every
document. The target model counts the documents labelled good: at most LABELLED of them, taken in the order of a hash
of their ids. Neighbouring n-grams depend on each other, so a text counts as EVIDENCE independent ones at most: its log
weight is the sum of the n log ratios times EVIDENCE / (n + EVIDENCE). Weights are thus of the size of the Gumbel noise near
the draw's end, and a document is drawn with probability 1 - exp(-weight * t), t being such that k are drawn.

How many are drawn is a parameter. Without it the labels say: as many as have a weight above the cut that tells good from
bad labelled documents best. The cut has no part in who is drawn.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import bounded, fresh, ranked, stash

BUCKETS, LABELLED, SEED = 1 << 14, 20_000, 42
#: Pseudo-count of each bucket, and the independent n-grams that a long text counts as.
SMOOTH, EVIDENCE = 0.5, 16.0
#: Of the labelled good documents, the share that the fitted cut may lose at most.
MAY_LOSE = 0.002

TOKEN = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^\sA-Za-z0-9_\x80-\xff]+")


def buckets(text: str | None) -> np.ndarray:
    """Bucket of each token, then of each pair of neighbours; a token and itself again are one pair whatever the token."""
    tokens = TOKEN.findall((text or "").encode("utf-8", "replace"))
    one = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ one[1:]) * np.uint64(0xD6E8FEB86659FD93)
    two[one[:-1] == one[1:]] = 0
    return np.concatenate([one % np.uint64(BUCKETS), two >> np.uint64(64 - BUCKETS.bit_length() + 1)]).astype(np.int64)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of each bucket in all rows of texts (text, kind): kind 1 into row 1, all into row 0. BUCKETS rows a
    kind reach the driver, whatever the size of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in bounded(batches):
            for text, kind in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(buckets(text.as_py()), minlength=BUCKETS)
                sums[0] += found
                if kind:
                    sums[1] += found
        for kind in (0, 1):
            at = np.flatnonzero(sums[kind])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind), pa.int32()), pa.array(at, pa.int32()), pa.array(sums[kind][at])], names=["kind", "bucket", "n"])

    out = np.zeros((2, BUCKETS))
    for kind, bucket, n in texts.mapInArrow(run, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n")).collect():
        out[kind, bucket] = n
    return out


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw)."""
    p = counts + SMOOTH
    p /= p.sum(axis=1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def log_weight(found: np.ndarray, ratio: np.ndarray, evidence: float) -> float:
    """Log importance weight of a text with these buckets; 0 if it has none."""
    return float(ratio[found].sum() * evidence / (len(found) + evidence))


def weigher(spark, ratio: np.ndarray, evidence: float):
    """log_weight as a column function of the text."""
    shared = spark.sparkContext.broadcast(ratio)

    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        return pd.Series([log_weight(buckets(t), shared.value, evidence) for t in texts])

    return weight


def fitted_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The weight below which labelled bad documents are told from good ones best, losing at most MAY_LOSE of the good."""
    if not good.any() or good.all():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost_good = np.concatenate([[0], np.cumsum(g)])
    lost_bad = np.concatenate([[0], np.cumsum(~g)])
    gain = np.where(lost_good <= MAY_LOSE * g.sum(), lost_bad - lost_good, -1)
    gain[1:-1][s[1:] == s[:-1]] = -1  # equal weights stay together
    at = int(np.argmax(gain))
    return -np.inf if at == 0 else float((s[at - 1] + s[at]) / 2) if at < len(s) else np.inf


def uniform(doc_id: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:quality:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def draw(docs: DataFrame, labels: DataFrame, *, keep: int | float | None = None, labelled: int = LABELLED, evidence: float = EVIDENCE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"):
    """(rows with id, text_hash, log_weight, key and rank; k; the column of a row's key in any table with id and text)."""
    spark = docs.sparkSession
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    marks = stash(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled).select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good")), "labelled")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marked = rows.join(F.broadcast(marks), "id", "left")  # at most `labelled` rows
    weight = weigher(spark, log_ratio(bucket_counts(marked.select("text", F.coalesce("good", F.lit(False)).cast("int").alias("kind")))), evidence)
    own = stash(marked.select("id", F.xxhash64("text").alias("text_hash"), weight("text").alias("log_weight"), "good"), "weights")
    if keep is None:
        fit = own.filter("good IS NOT NULL").dropDuplicates(["id"]).select("log_weight", "good").toPandas()  # at most `labelled` rows
        cut = fitted_cut(fit["log_weight"].to_numpy(float), fit["good"].to_numpy(bool))
        k = own.filter(F.col("log_weight") >= F.lit(float(cut))).count()
    else:
        k = keep if isinstance(keep, int) else round(keep * own.count())
    key = lambda id_, weight: weight - F.log(-F.log(uniform(id_, seed)))
    order = ranked(own.withColumn("key", key(F.col("id"), F.col("log_weight"))), "rank", F.col("key").desc(), F.col("id").asc_nulls_last(), F.col("text_hash"))
    return order, k, lambda id_, text: key(id_, weight(text))


def sampled(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(id, text_hash, log_weight, rank, kept) for every row of docs.

    Kept are the k rows with the largest log weight + Gumbel noise of the id. keep: k, or as a float the share of rows;
    without it the labels size the draw, and without good and bad labels k is all. Null text counts as empty, with weight
    0; rows of one id and text share their draw; ties in rank go to the smaller id. Whole texts count, however long.
    Documents labelled more than once are good if the lowest quality given is 1; labels with a null in either column
    don't count. An empty table has no rows.
    """
    order, k, _ = draw(docs, labels, **options)
    return order.select("id", "text_hash", "log_weight", "rank", (F.col("rank") <= k).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without those that the draw rejects. A row stays if any of its repeats does.

    The draw's last row alone decides: each row's key is computed again where the row is read and held against it, so
    texts are neither joined nor moved.
    """
    order, k, key_of = draw(docs, labels, id_col=id_col, text_col=text_col, **options)
    last = order.filter(F.col("rank") == k).select("key", "id", "text_hash").first()
    if last is None:
        return docs.filter(F.lit(False))
    name = fresh(docs, "draw_key")
    id_, text_hash, key = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col)), F.col(name)
    before = id_.isNotNull() if last.id is None else F.coalesce(id_ < F.lit(last.id), F.lit(False))
    tie = before | (id_.eqNullSafe(F.lit(last.id)) & (text_hash <= F.lit(last.text_hash)))
    rows = docs.withColumn(name, key_of(id_, F.col(text_col)))
    return rows.filter((key > F.lit(last.key)) | ((key == F.lit(last.key)) & tie)).drop(name)
