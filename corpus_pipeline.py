"""From raw documents to tokens: five stages, each written as Parquet and read again by the next.

Rows with a null id stay: they are drawn by the noise of one fixed text, are nobody's earlier document and nobody's near
duplicate. Rows with a null text count as empty and stay null. Rows repeated with one id become one in near_dedup. Extra
columns go through; columns called ids, parity or decodes keep their names, and the new ones get an underscore. Without
labels nothing is rejected; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import linededup, mixing, quality, sentencepieces, simhash
from cadenza.llm.common import shared_path, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality draw rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the blocks of lines that an earlier document has."""
    return linededup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 5-word shingles at a Jaccard similarity of 0.8 or more."""
    return simhash.keep_one(docs, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its ids, parity and decodes."""
    return sentencepieces.encode(docs, sentencepieces.model_bytes())


STAGES: list[tuple[str, Stage]] = [("quality", good_documents), ("line_dedup", unique_lines), ("near_dedup", near_dedup), ("mix", mix), ("tokens", tokens)]

#: Trained weights, alignments and pieces aren't for SQL; tests/llm/test_pipeline.py holds the chain against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table of documents: its columns, and ids, parity and decodes of every row that is kept, as
    often as the mix takes it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
