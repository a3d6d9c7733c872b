"""Approximate nearest neighbours by additive quantisation: a vector is the sum of one full-dimensional code word from
each codebook, found by beam search; queries score codes through lookup tables, and the best are ranked again exactly.

The codebooks are fitted on a bounded sample; every row is coded. Scoring goes over blocks of rows against blocks of
queries, and in each block the same share of rows is ranked exactly, so recall doesn't sink as rows are added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stash
from cadenza.llm.vectors import matrix, packed, unpacked, usable

#: Codebooks, code words of each, and rows that they are fitted on at most (the first by a hash of their ids).
BOOKS, WORDS, SAMPLE = 16, 64, 20_000
BEAM, SEED = 4, 42
#: Rows and queries that meet in one task, and what each query ranks exactly there: a share of the rows, and all rows
#: within MARGIN standard errors of the k-th score, so that near copies that codes can't tell apart are all looked at.
BLOCK, QUERY_BLOCK, SHARE, MARGIN = 4096, 4096, 1 / 16, 1.5


@dataclass
class Books:
    words: np.ndarray  # books x words x dimensions

    def encode(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of each row of x, the norm of what they stand for, and that of what they leave. A beam is kept over the residuals: of all ways
        to go on, the `beam` with the smallest error stay."""
        n, books = len(x), len(self.words)
        codes = np.zeros((n, 1, books), np.uint8)
        rest = x[:, None, :].astype(np.float32)
        for m, words in enumerate(self.words):
            error = (rest**2).sum(-1)[:, :, None] - 2 * rest @ words.T + (words**2).sum(-1)
            width = error.shape[1] * error.shape[2]
            flat = error.reshape(n, width)
            keep = np.argpartition(flat, min(beam, width) - 1, axis=1)[:, :beam] if width > beam else np.tile(np.arange(width), (n, 1))
            parent, word = keep // len(words), keep % len(words)
            row = np.arange(n)[:, None]
            codes = codes[row, parent]
            codes[:, :, m] = word
            rest = rest[row, parent] - words[word]
        best = (rest**2).sum(-1).argmin(1) if n else np.zeros(0, int)
        row = np.arange(n)
        return codes[row, best], np.linalg.norm(x - rest[row, best], axis=1), np.linalg.norm(rest[row, best], axis=1)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """books x words x queries: inner product of each code word with each query."""
        return self.words @ queries.T.astype(np.float32)


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 8, seed: int = SEED) -> Books:
    """Codebooks one after the other by k-means on the residuals, then all together by least squares on the codes."""
    rng = np.random.default_rng(seed)
    rest, found = x.astype(np.float32), []
    words = max(1, min(words, len(x)))
    for _ in range(books):
        centres = rest[rng.choice(len(rest), words, replace=False)]
        for _ in range(rounds):
            near = ((centres**2).sum(1) - 2 * rest @ centres.T).argmin(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, rest)
            n = np.bincount(near, minlength=words)[:, None]
            centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
        near = ((centres**2).sum(1) - 2 * rest @ centres.T).argmin(1)
        rest = rest - centres[near]
        found.append(centres)
    out = Books(np.stack(found))
    size = books * words
    if len(x) >= 8 * size:
        at = out.encode(x)[0].astype(np.int64) + np.arange(books) * words
        hot = np.zeros((len(x), size), np.float32)
        hot[np.arange(len(x))[:, None], at] = 1
        joint = np.linalg.solve((hot.T @ hot).astype(np.float64) + np.eye(size), hot.T @ x + out.words.reshape(size, -1))
        out = Books(joint.reshape(books, words, -1).astype(np.float32))
    return out


def build(vectors: DataFrame, *, sample: int = SAMPLE, books: int = BOOKS, words: int = WORDS, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, Books | None]:
    """The index, (id, v, codes, norm, coded_norm, error) of every usable row, written to the shared folder, and its codebooks;
    None for a table without usable rows. Usable: an id, and a vector of the usual length without null or non-finite
    components that isn't zero. Repeated rows are coded each; search takes them as one."""
    rows = stash(usable(vectors, id_col=id_col, vec_col=vec_col), "vectors")
    some = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample).toPandas()  # at most `sample` rows
    if some.empty:
        return rows, None
    model = fit(np.stack(some["v"].to_numpy()).astype(np.float64), books, words)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            codes, coded, error = shared.value.encode(x) if len(x) else (np.zeros((0, 1), np.uint8), np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(x), packed(codes), pa.array(np.linalg.norm(x, axis=1) if len(x) else coded), pa.array(coded.astype(np.float64)), pa.array(error.astype(np.float64))], names=["id", "v", "codes", "norm", "coded_norm", "error"])

    return stash(rows.mapInArrow(run, "id long, v binary, codes binary, norm double, coded_norm double, error double"), "index"), model


def block_top(model: Books, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, stretch: np.ndarray, error: float, query_ids: np.ndarray, queries: np.ndarray, k: int, share: float) -> list[np.ndarray]:
    """(number of the query, id, score) of the k best rows of a block for each query."""
    n = len(ids)
    slack = MARGIN * error / np.sqrt(x.shape[1])
    wanted = min(n, max(4 * k, int(np.ceil(n * share))) + 1)
    out: list[list[np.ndarray]] = [[], [], []]
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        tables = model.tables(part)
        scores = np.zeros((n, len(part)), np.float32)
        for m in range(codes.shape[1]):
            scores += tables[m][codes[:, m]]
        scores *= stretch[:, None]
        last = max(0, n - k - 1)
        parted = np.partition(scores, sorted({n - wanted, last}), axis=0)
        least = np.minimum(parted[n - wanted], parted[last] - slack * np.linalg.norm(part, axis=1))
        for j, query in enumerate(part):
            near = np.flatnonzero(scores[:, j] >= least[j])  # ties of the last one too: copies are told apart by id
            near = near[ids[near] != query_ids[at + j]]
            exact = (x[near] * query).sum(1)
            best = np.lexsort((ids[near], -exact))[:k]
            out[0].append(np.full(len(best), at + j))
            out[1].append(ids[near[best]])
            out[2].append(exact[best])
    return [np.concatenate(c) if c else np.zeros(0) for c in out]


def distinct(ids: np.ndarray, packed_rows: list[bytes]) -> np.ndarray:
    """Places of rows, repeated ones (of one id and vector) once. Rows of one id are in one block."""
    if len(np.unique(ids)) == len(ids):
        return np.arange(len(ids))
    return np.sort(np.fromiter({(i, v): k for k, (i, v) in enumerate(zip(ids.tolist(), packed_rows, strict=True))}.values(), np.int64))


def search(index: DataFrame, model: Books | None, queries: DataFrame, *, k: int = 20, share: float = SHARE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product that are found for each usable query, the
    query's own id left out; ties go to the smaller id. Fewer rows than k: all of them. Rows with a null id, and vectors that
    are null, zero or hold null or non-finite components, take no part on either side; repeated rows are one. Vectors of any
    length are taken whole. Other columns, whatever their names, are left out."""
    spark = index.sparkSession
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(model)
    asked = stash(usable(queries, id_col=id_col, vec_col=vec_col).dropDuplicates(["id", "v"]).withColumn("ask", F.xxhash64("id", "v")), "queries")
    blocks, query_blocks = -(-index.count() // BLOCK), max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = index.withColumn("block", dealt(blocks)).withColumn("query_block", every(query_blocks))
    asked = asked.withColumn("query_block", dealt(query_blocks)).withColumn("block", every(blocks)).withColumnsRenamed({"id": "query_id", "v": "q"})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("ask", "query_id", "vec_id")} | {"score": pa.array([], pa.float64())})
        left = left.take(pa.array(distinct(left["id"].to_numpy(), left["v"].to_pylist())))
        coded = left["coded_norm"].to_numpy()
        stretch = (left["norm"].to_numpy() / np.where(coded > 0, coded, 1)).astype(np.float32)
        q = matrix(right["q"].combine_chunks())
        found = block_top(shared.value, left["id"].to_numpy(), unpacked(left["v"], np.float64), unpacked(left["codes"], np.uint8), stretch, float(left["error"].to_numpy().mean()), right["query_id"].to_numpy(), q, k, share)
        who = found[0].astype(np.int64)
        return pa.table({"ask": right["ask"].take(pa.array(who)), "query_id": right["query_id"].take(pa.array(who)), "vec_id": pa.array(found[1].astype(np.int64)), "score": pa.array(found[2].astype(np.float64))})

    key = ["block", "query_block"]
    found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(run, "ask long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
