"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import alignment, ann, caps, chat, lexical, linededup, lm, mixing, privacy, quality, sentencepieces, simhash, warc
from cadenza.llm.common import table


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index, model = ann.build(vectors)
    return ann.search(index, model, vectors.filter("vec_id % 20 = 0"), k=20)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, whether sentencepiece gives the same, and whether they decode to the normalised text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepieces.encode(docs, sentencepieces.model_bytes()).select("doc_id", F.size("ids").alias("n_tokens"), "ids", "parity", "decodes")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated blocks, and the numbers of the lines that went."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, report="deleted_lines")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)
    return found.select(F.col("id").alias("doc_id"), simhash.hexed(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op7_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    tokenizer = chat.tokenizer_json()
    return chat.digests(chat.format_turns(turns.union(more), tokenizer), tokenizer)


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, rank in the draw and decision of every document."""
    found = quality.sampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "log_weight", "rank", "kept")


def op11_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that give it away."""
    return privacy.report(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    found = lexical.search(lexical.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=50)
    return found.select(F.col("query").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and counts of links of two tokenizers over every document."""
    return alignment.summaries(table(spark, sf_dir, "documents"), alignment.tokenizer_json(), alignment.model_bytes()).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_ann": op1_ann,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_warc": op4_warc,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_mixing": op6_mixing,
    "op7_caps": op7_caps,
    "op8_chat": op8_chat,
    "op9_lm": op9_lm,
    "op10_quality": op10_quality,
    "op11_privacy": op11_privacy,
    "op12_lexical": op12_lexical,
    "op13_alignment": op13_alignment,
}

ORACLES = {
    "op6_mixing": mixing.SQL,
    "op12_lexical": lexical.SQL,
}
