"""Ranked lexical search over hashed max-sketches.

A document's sketch has ROWS rows of `width` bytes, a power of two of at least LOAD times its distinct terms. Each term is
hashed to one place in each row, where the largest frequency of all terms that meet there stays. An impact grows with
the frequency alone, as a document has one length, so the least of a term's places bounds its impact from above, and the
sum over a query's terms bounds the score. Places hold frequencies up to 254; 255 stands for the document's highest.

A search looks up all queries of a batch in a document's sketch at once. In each task the documents of a query are
scored exactly in the order of falling bounds until the bound is below the threshold, which is the k-th best score so
far. A first pass, for a few best documents of each task, gives a threshold over the whole table to start from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import bounded, stash

ROWS, LOAD, LEAST_WIDTH = 2, 4, 64
#: Documents looked at together.
DOCS = 512
#: Documents of one query scored exactly at a time.
CHUNK = 64
#: Pairs of a query and a term that go to the workers together; a single query may have more.
PAIRS = 200_000

_SPACES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

#: Rows of documents, and rows of distinct terms (a list of them, and how many documents of one batch hold each).
INDEX = "id long, text string, n long, max_tf long, sketch binary, terms array<string>, docs array<int>"


def coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(document, term) of every occurrence of a term; terms by their place in the last item. A-Z are lower-cased, and all
    ASCII characters but letters and digits separate. The last item may hold an empty string that no occurrence has."""
    column = column.cast(pa.string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes().translate(_SPACES) if data is not None else b""
    plain = pa.StringArray.from_buffers(len(column), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data))
    parts = pc.split_pattern(plain, " ")
    found = parts.flatten().dictionary_encode()
    names = found.dictionary.to_pylist()
    at = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(column)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    there = np.array([s != "" for s in names], bool)[at] if len(at) else np.zeros(0, bool)
    return doc[there], at[there], names


def counted(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(document, term, frequency) of every distinct term of every text, by document; terms as in coded."""
    doc, at, names = coded(column)
    keys, tf = np.unique(doc * max(1, len(names)) + at, return_counts=True)
    return keys // max(1, len(names)), keys % max(1, len(names)), tf, names


def hashes(terms: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t.encode()) for t in terms), np.uint64, len(terms))


def spots(hashed: np.ndarray, row: int, width: np.ndarray | int) -> np.ndarray:
    """The places of terms in one row of a sketch."""
    return ((hashed >> np.uint64(32 * row)) & np.uint64(0xFFFFFFFF)).astype(np.int64) & (width - 1)


def widths(distinct: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(1, LOAD * distinct))).astype(np.int64))


def index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows as in INDEX, written to the shared folder: every row of docs with its text, number of terms, highest frequency and
    sketch, and each batch's distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1 << 12, 8 << 20):
            n = batch.num_rows
            doc, term, tf, names = counted(batch.column(1))
            width = widths(np.bincount(doc, minlength=n))
            begin = np.concatenate([[0], np.cumsum(ROWS * width)])
            flat = np.zeros(begin[-1], np.uint8)
            hashed = hashes(names)
            for row in range(ROWS):
                np.maximum.at(flat, begin[doc] + row * width[doc] + spots(hashed[term], row, width[doc]), np.minimum(tf, 255).astype(np.uint8))
            most = np.zeros(n, np.int64)
            np.maximum.at(most, doc, tf)
            total = np.bincount(doc, tf, minlength=n).astype(np.int64)
            sketches = [flat[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
            held = np.bincount(term, minlength=len(names)).astype(np.int32)
            some = np.flatnonzero(held)
            cols = [batch.column(0), batch.column(1), pa.array(total), pa.array(most), pa.array(sketches, pa.binary()), pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int32()))]
            fields = [c.split()[0] for c in INDEX.split(", ")]
            yield pa.RecordBatch.from_arrays(cols, names=fields)
            if len(some):
                cols = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())]
                cols += [pa.array([[names[i] for i in some]], pa.list_(pa.string())), pa.array([held[some]], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, names=fields)

    return stash(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, INDEX), "index")


@dataclass
class Queries:
    """A batch of queries: distinct terms with their weights, the terms of each query, and the queries of each term."""

    ids: list[int | None]
    terms: dict[str, int]
    weights: np.ndarray
    of: list[np.ndarray]
    n: int
    length: int

    def __post_init__(self) -> None:
        self.hashed = hashes(list(self.terms))
        self.query = np.repeat(np.arange(len(self.of)), [len(t) for t in self.of])
        flat = np.concatenate(self.of) if self.of else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.query, self.number = self.query[order], np.bincount(flat, minlength=len(self.terms))
        self.begin = np.cumsum(self.number) - self.number

    def norms(self, n: np.ndarray) -> np.ndarray:
        return 50 + (50 * n * self.n) // max(1, self.length)

    @staticmethod
    def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // np.maximum(1, 1000 * tf + 20 * norm)

    def bounds(self, sketches: list[bytes], n: np.ndarray, max_tf: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, a row a document and a column a query. All sums are whole numbers far below 2^53."""
        out = np.zeros((len(sketches), len(self.of)))
        sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
        norms = self.norms(n)
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            width = int(size) // ROWS
            folded = np.frombuffer(b"".join([sketches[i] for i in own]), np.uint8).reshape(len(own), ROWS, width)
            least = np.minimum.reduce([folded[:, row, spots(self.hashed, row, width)] for row in range(ROWS)])
            doc, term = np.nonzero(least)
            tf = least[doc, term].astype(np.int64)
            at = own[doc]
            worth = self.weights[term] * self.impacts(np.where(tf == 255, max_tf[at], tf), norms[at])
            number = self.number[term]
            ends = np.cumsum(number)
            which = np.repeat(self.begin[term] - (ends - number), number) + np.arange(ends[-1] if len(ends) else 0)
            sums = np.bincount(np.repeat(doc, number) * len(self.of) + self.query[which], np.repeat(worth, number), minlength=len(own) * len(self.of))
            out[own] = sums.reshape(len(own), len(self.of))
        return out

    def frequencies(self, texts: pa.Array) -> np.ndarray:
        """Exact frequencies of the queries' terms, a row a text and a column a term."""
        doc, term, tf, names = counted(texts)
        place = np.fromiter((self.terms.get(s, -1) for s in names), np.int64, len(names))
        out = np.zeros((len(texts), len(self.terms)), np.int64)
        known = place[term] >= 0 if len(names) else np.zeros(0, bool)
        out[doc[known], place[term[known]]] = tf[known]
        return out


def best(batches: Iterator[pa.RecordBatch], queries: Queries, k: int, least: np.ndarray) -> list[list[tuple[int, bool, int]]]:
    """Of each query the k best of the documents (id, text, n, max_tf, sketch) with a score of at least `least` and above 0:
    (-score, id is null, id). Documents are scored by falling bound until the bound is below the k-th best score."""
    found: list[list[tuple[int, bool, int]]] = [[] for _ in queries.of]
    least = np.maximum(least, 1).astype(np.float64)
    for batch in bounded(batches, DOCS):
        n, max_tf = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
        bound = queries.bounds(batch.column(4).to_pylist(), n, max_tf)
        passing = bound >= least
        docs = np.flatnonzero(passing.any(axis=1))
        if not len(docs):
            continue
        tfs = queries.frequencies(batch.column(1).take(pa.array(docs)))
        norms, ids = queries.norms(n[docs]), batch.column(0).take(pa.array(docs)).to_pylist()
        for q in np.flatnonzero(passing.any(axis=0)):
            own = bound[docs, q]
            order = np.argsort(-own, kind="stable")
            order = order[: np.searchsorted(-own[order], -least[q], "right")]
            terms = queries.of[q]
            for at in range(0, len(order), CHUNK):
                if own[order[at]] < least[q]:
                    break
                some = order[at : at + CHUNK]
                scores = (queries.weights[terms] * queries.impacts(tfs[np.ix_(some, terms)], norms[some, None])).sum(axis=1)
                new = [(-int(s), ids[d] is None, ids[d] or 0) for d, s in zip(some, scores, strict=True) if s >= least[q]]
                if new:
                    found[q] = nsmallest(k, found[q] + new)
                    if len(found[q]) == k:
                        least[q] = max(least[q], -found[q][-1][0])
    return found


def weigh(terms: int, df: int) -> int:
    """A term's weight among `terms` documents, of which df hold it."""
    return math.floor(1000 * math.log((2 * terms + 2) / (2 * df + 1)))


def search(indexed: DataFrame, queries: DataFrame, *, k: int = 50, query_id: str = "item_id", query_text: str = "text", pairs: int = PAIRS) -> DataFrame:
    """(query, rank, id, score): of each query the k best documents of the index with a score above 0, equal scores by id, a
    null id last.

    Rows of queries with one id are one query of all their terms; null and empty texts have none and give no rows. Repeated
    documents are ranked one by one. Queries are dealt to batches of about `pairs` pairs of a query and a term, each of
    which is looked up in the whole index; those pairs are all that passes through the driver."""
    spark = indexed.sparkSession
    documents = indexed.filter("sketch IS NOT NULL")
    n, length = documents.selectExpr("count_if(n > 0)", "coalesce(sum(n), 0)").first()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(rows):
            doc, term, _, names = counted(batch.column(1))
            ids = batch.column(0).take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([ids, pa.array([names[t] for t in term], pa.string())], names=["query", "term"])

    wanted = stash(queries.select(F.col(query_id).cast("long").alias("query"), F.col(query_text).alias("text")).mapInArrow(run, "query long, term string").distinct(), "queries")
    held = indexed.filter("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "docs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.docs").alias("docs"))
    known = held.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("df"))
    wanted = stash(wanted.join(known, "term"), "weighed")
    parts = max(1, math.ceil(wanted.count() / pairs))
    results = [_searched(documents, _batch(wanted, parts, part, n, length), k) for part in range(parts)]
    out = results[0]
    for more in results[1:]:
        out = out.union(more)
    return out.select("query", "rank", "id", "score")


def _batch(wanted: DataFrame, parts: int, part: int, n: int, length: int) -> Queries:
    rows = wanted.filter(F.pmod(F.xxhash64("query"), F.lit(parts)) == part).orderBy("query", "term").collect()
    terms = {t: i for i, t in enumerate(dict.fromkeys(r.term for r in rows))}
    ids = list(dict.fromkeys(r.query for r in rows))
    place, weights, of = {q: i for i, q in enumerate(ids)}, np.zeros(len(terms), np.int64), [[] for _ in ids]
    for r in rows:
        weights[terms[r.term]] = weigh(n, r.df)
        of[place[r.query]].append(terms[r.term])
    return Queries(ids, terms, weights, [np.array(t, np.int64) for t in of], n, length)


def _searched(documents: DataFrame, queries: Queries, k: int) -> DataFrame:
    spark = documents.sparkSession
    rows = documents.select("id", "text", "n", "max_tf", "sketch")

    def found(most: int, least: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast((queries, most, least))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given, most, least = shared.value
            out = [(given.ids[q], None if null else i, -s) for q, own in enumerate(best(batches, given, most, least)) for s, null, i in own]
            cols = list(zip(*out, strict=True)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query", "id", "score"])

        return rows.mapInArrow(run, "query long, id long, score long")

    ranks = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    nothing = np.zeros(len(queries.of), np.int64)
    seeds = found(math.ceil(2 * k / max(1, rows.rdd.getNumPartitions())), nothing)
    seeds = seeds.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") == k).select("query", "score").collect()  # a row a query of the batch
    start = {r.query: r.score for r in seeds}
    least = np.array([start.get(q, 0) for q in queries.ids], np.int64)
    return found(k, least).withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
p AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
l AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM l),
f AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT item_id, term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN f USING (term), s),
m AS (SELECT r, 100 - 50 + ((50 * n * n_docs) // total) AS m FROM l, s),
x AS (SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM w JOIN p USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 50
"""
