"""Near-duplicate vectors by spherical-cap filters: random product codes whose code words are directions; a vector is
decoded to the list of all directions it is close enough to, vectors join on these, and pairs are verified exactly.

A table of filters is a random rotation and one random code for each half of the dimensions; a direction is a pair of
half code words. The list is found from the two halves' products without looking at each direction by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import min_components, stash
from cadenza.llm.vectors import matrix, packed, unpacked, usable

THRESHOLD = 0.95
#: Tables, code words of a half, and the least inner product of a vector and a filter's direction, in units of its
#: deviation 1 / sqrt(dimensions). Of random pairs with a cosine of exactly 0.95 in 64 dimensions these missed 5 of
#: 8,000 in a simulation; closer pairs share more filters.
TABLES, WORDS, CAP, SEED = 16, 96, 3.36, 42
#: The share of pairs just at the threshold that filters must find, and the pairs that it is simulated with.
RECALL, PAIRS = 0.999, 4000
#: Vectors of a filter that are compared in one piece with those of another.
BLOCK = 512
#: Filters that a vector is to meet, about; WORDS is right up to MANY vectors, beyond which filters would have several blocks.
LISTED = 40
MANY = TABLES * WORDS * WORDS * BLOCK // LISTED


def words_for(vectors: int, tables: int = TABLES) -> int:
    """Code words of a half, so that a filter's members stay within about a block whatever the number of vectors. Filters grow
    in number with the vectors and their caps get smaller, so that a vector still meets about LISTED of them."""
    return max(WORDS, math.isqrt(LISTED * vectors // (BLOCK * tables)) + 1 if vectors > MANY else 0)


class Filters:
    """Without a cap: CAP deviations, or with more than WORDS words what LISTED filters a vector ask for, and less in either case
    where RECALL asks for it. A given cap that doesn't meet RECALL is an error."""

    def __init__(self, dimensions: int, tables: int = TABLES, words: int = WORDS, cap: float | None = None, seed: int = SEED, threshold: float = THRESHOLD) -> None:
        rng = np.random.default_rng(seed)
        self.words, self.half = words, dimensions // 2
        self.turns = [np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0] for _ in range(tables)]
        self.codes = []
        for _ in range(tables):
            halves = [rng.normal(size=(words, d)) for d in (self.half, dimensions - self.half) if d]
            self.codes.append([h / np.linalg.norm(h, axis=1, keepdims=True) / np.sqrt(len(halves)) for h in halves])

        x, y = self.pairs(dimensions, threshold, seed + 1)
        if words > WORDS:
            self.cap = self.fitted(x, y) if cap is None else cap
            if cap is not None and self.recall(x, y) < RECALL:
                raise ValueError(f"cap {cap} finds less than {RECALL} of the pairs at {threshold} in {dimensions} dimensions")
            return
        shared = np.sort(self.shared_caps(x, y))
        most = float(shared[int((1 - RECALL) * len(shared))])
        if cap is not None and cap > most:
            raise ValueError(f"cap {cap} finds less than {RECALL} of the pairs at {threshold} in {dimensions} dimensions; {most:.4f} does")
        self.cap = min(CAP / np.sqrt(dimensions), most) if cap is None else cap

    def recall(self, x: np.ndarray, y: np.ndarray) -> float:
        """The share of pairs that meet in a filter at the present cap."""
        every = len(self.turns) * self.words * self.words
        keys = [row * every + found for row, found in (self.decode(v) for v in (x, y))]
        return len(np.unique(np.intersect1d(*keys) // every)) / len(x)

    def fitted(self, x: np.ndarray, y: np.ndarray) -> float:
        """The cap of LISTED filters a vector, or the next smaller one that finds RECALL of the pairs."""
        self.cap = -NormalDist().inv_cdf(LISTED / (len(self.turns) * self.words * self.words)) / np.sqrt(x.shape[1])
        while self.recall(x, y) < RECALL:
            self.cap -= 0.05 / np.sqrt(x.shape[1])
        return self.cap

    @staticmethod
    def pairs(dimensions: int, cosine: float, seed: int, n: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
        """n random pairs of unit vectors with the given cosine."""
        x, y = np.random.default_rng(seed).normal(size=(2, n, dimensions))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
        y = cosine * x + np.sqrt(1 - cosine * cosine) * y
        return x, y / np.linalg.norm(y, axis=1, keepdims=True)

    def shared_caps(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The greatest cap at which each pair shares a filter."""
        out = np.full(len(x), -2.0)
        for turn, codes in zip(self.turns, self.codes, strict=True):
            sides = []
            for v in (x @ turn, y @ turn):
                head = v[:, : self.half] @ codes[0].T if len(codes) == 2 else np.zeros((len(x), 1))
                sides.append((head.astype(np.float32), (v[:, self.half :] @ codes[-1].T).astype(np.float32)))
            for lo in range(0, len(x), 100):
                (hx, tx), (hy, ty) = [(h[lo : lo + 100, :, None], t[lo : lo + 100, None, :]) for h, t in sides]
                least = np.minimum(hx + tx, hy + ty)
                out[lo : lo + 100] = np.maximum(out[lo : lo + 100], least.max((1, 2)))
        return out

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that the unit vectors x exceed."""
        rows, found = [], []
        for t, (turn, codes) in enumerate(zip(self.turns, self.codes, strict=True)):
            y = x @ turn
            tail = y[:, self.half :] @ codes[-1].T
            head = y[:, : self.half] @ codes[0].T if len(codes) == 2 else np.zeros((len(x), 1))
            top = tail.max(1)
            r, i = np.nonzero(head + top[:, None] >= self.cap)  # half words that some direction can exceed with
            at, j = np.nonzero(head[r, i][:, None] + tail[r] >= self.cap)
            rows.append(r[at])
            found.append((t * self.words + i[at]) * self.words + j)
        return np.concatenate(rows), np.concatenate(found)


def first_shared(lists: list[np.ndarray], pairs: np.ndarray, current: int) -> np.ndarray:
    """Whether a pair of members shares no filter before the current one, so that it is reported once."""
    members, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(pairs.shape)
    own = [lists[m][lists[m] < current] for m in members]
    row = np.repeat(np.arange(len(own)), [len(o) for o in own])
    values, col, n = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    shared = n[col] > 1
    names, col = np.unique(col[shared], return_inverse=True)
    row = row[shared]
    ok = np.ones(len(pairs), bool)
    for lo in range(0, len(names), 2048):
        part = (col >= lo) & (col < lo + 2048)
        has = np.zeros((len(own), 2048), np.float32)
        has[row[part], col[part] - lo] = 1
        common = has @ has.T
        ok &= common[at[:, 0], at[:, 1]] == 0
    return ok


def roots(pairs: np.ndarray, n: int) -> np.ndarray:
    """The smallest of n members that each is connected with by the pairs."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        after = label.copy()
        np.minimum.at(after, pairs[:, 0], least)
        np.minimum.at(after, pairs[:, 1], least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def links(nodes: DataFrame, *, threshold: float = THRESHOLD, tables: int = TABLES, words: int | None = None, cap: float | None = None) -> DataFrame:
    """(node, others, root) from distinct vectors (node, v, n copies): for each node of a block of a filter, the copies of
    other nodes that are found here, and nowhere before, with a cosine of at least the threshold, and the smallest node
    that it is connected with by these. Rows go with the nodes of blocks, never with pairs.

    A filter's members are dealt to blocks of about BLOCK, and each two blocks are compared by themselves, so a filter
    that a third of all vectors exceed is spread over many tasks. Without words, there are as many as the number of
    vectors asks for.
    """
    words = words_for(nodes.count(), tables) if words is None else words
    first = nodes.select(F.size("v").alias("d")).first()
    shared = nodes.sparkSession.sparkContext.broadcast(Filters(first["d"] if first else 2, tables, words, cap, threshold=threshold))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                x = matrix(some.column(1))
                x /= np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True) * np.abs(x).max(1, keepdims=True)
                row, found = shared.value.decode(x)
                order = np.lexsort((found, row))
                row, found = row[order], found[order]
                ends = np.searchsorted(row, np.arange(len(x) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([some.column(0), packed(x), lists, some.column(2)], names=["node", "x", "filters", "n"])

    coded = stash(nodes.select("node", "v", "n").mapInArrow(decode, "node long, x binary, filters array<int>, n long"), "caps")
    sizes = coded.select(F.explode("filters").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sizes = stash(sizes.select("f", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "filters")
    rows = coded.select("node", "x", "n", "filters", F.explode("filters").alias("f")).join(sizes, "f")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("f", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node", "x", "n", "filters")
    rows = rows.repartition("f", "lo", "hi").sortWithinPartitions("f", "lo", "hi", "node")

    def compare(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        f, lo, hi = (table[c][0].as_py() for c in ("f", "lo", "hi"))
        x, node, own, n = unpacked(table["x"], np.float64), table["node"].to_numpy(), table["own"].to_numpy(), table["n"].to_numpy()
        near = x @ x.T >= threshold
        if lo != hi:
            near &= own[:, None] != own[None, :]
        pairs = np.argwhere(np.triu(near, 1))
        if not len(pairs):
            return node[:0], n[:0], node[:0]
        lists = [r.values.to_numpy() for r in table["filters"]]
        pairs = pairs[first_shared(lists, pairs, f)]  # each pair counts, and connects, in one block
        root = roots(pairs, len(node))
        others = np.bincount(pairs[:, 0], n[pairs[:, 1]], len(node)) + np.bincount(pairs[:, 1], n[pairs[:, 0]], len(node))
        told = others > 0
        return node[told], others[told].astype(np.int64), node[root[told]]  # rows are in order of node

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table, ends: list[int]) -> Iterator[pa.RecordBatch]:
            found = [compare(table.slice(a, b - a)) for a, b in zip([0, *ends], ends, strict=False) if b - a > 1]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found, strict=True)], names=["node", "others", "root"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            key = np.stack([table[c].to_numpy() for c in ("f", "lo", "hi")])
            ends = (np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist()
            if ends:
                yield from flush(table, ends)
                held = table.slice(ends[-1]).combine_chunks().to_batches()  # the last group may go on
        if held:
            table = pa.Table.from_batches(held)
            yield from flush(table, [table.num_rows])

    return rows.mapInArrow(verify, "node long, others long, root long")


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", **options) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: how many other vectors are linked, the smallest id reachable,
    and whether that is the row's own.

    Equal vectors are one node with a count, so copies aren't expanded into pairs. Rows that take no part have no links
    and are a component of their own; a null id has a null component and isn't kept; rows repeated with one id count as
    vectors of their own. Other columns, whatever their names, are left out.
    """
    rows = stash(usable(vectors, id_col=id_col, vec_col=vec_col), "vectors")
    nodes = stash(rows.groupBy("v").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n")), "nodes")
    told = stash(links(nodes, **options), "links")
    linked = told.groupBy("node").agg(F.sum("others").alias("others"))
    edges = told.filter("root < node").select(F.col("node").alias("a"), F.col("root").alias("b"))
    found = nodes.join(linked, "node", "left").join(min_components(edges), "node", "left")
    found = found.select("v", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    found = rows.join(stash(found, "classes"), "v").select("id", "n_links", "component_id").groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id")).join(stash(found.withColumnRenamed("id", "vec_id"), "found"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return own.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"))
