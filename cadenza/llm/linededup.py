"""Line dedup: overlapping documents are found through shared rare line hashes and aligned by patience diff; the aligned
common blocks of at least `min_words` words are deleted from the later document.

What is looked up: a line of min_words words by its own hash, a shorter one, which by itself is seldom rare, by the hash
of the run of lines from it on, and of that back from it, that just reaches min_words. Each such hash leads to the
earliest document that has it, however many others do, so a document is aligned with the first holders of its runs and
never with all the others of a group of copies. Where few distinct lines repeat over and over, alignments of whole documents can miss
a common run; runs that are left are aligned one by one at the end, so that no common block is overlooked. "Earlier" is the smaller id; the first
holder keeps its lines.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import bounded, fresh, stash

MIN_WORDS = 20
#: Occurrences of a line on either side from which a block is tried where all common lines repeat; what that misses is
#: aligned run by run at the end, so it changes nothing but the time that is taken.
NEAR = 8


def lines_of(text: str | None) -> tuple[list[int], list[int]]:
    """Hash and number of words of each line; white space at its ends doesn't count."""
    lines = [x.strip() for x in (text or "").encode("utf-8", "replace").split(b"\n")]
    return [xxhash.xxh64_intdigest(x) - (1 << 63) for x in lines], [len(x.split()) for x in lines]


def runs(hashes: list[int], words: list[int], min_words: int) -> dict[int, list[tuple[int, int]]]:
    """Hash of each run of lines that just reaches min_words, from a line on or back -> where it is, half-open."""
    n, found = len(hashes), set()
    packed = np.asarray(hashes, np.int64).tobytes()
    total = np.concatenate([[0], np.cumsum(words)]).astype(np.int64)
    on = np.searchsorted(total, total[:-1] + min_words)  # the first end that reaches min_words
    back = np.searchsorted(total, total[1:] - min_words, side="right") - 1  # the last start that does
    for i in range(n):
        if words[i]:
            if on[i] <= n:
                found.add((i, int(on[i])))
            if back[i] >= 0:
                found.add((int(back[i]), i + 1))
    out: dict[int, list[tuple[int, int]]] = {}
    for lo, hi in found:
        out.setdefault(xxhash.xxh64_intdigest(packed[8 * lo : 8 * hi]) - (1 << 63), []).append((lo, hi))
    return out


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    ends: list[int] = []
    tops: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        before[i] = ends[k - 1] if k else -1
        ends[k : k + 1], tops[k : k + 1] = [i], [v]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def alike(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many lines around a[i] and b[j] are equal without a gap."""
    up = next((k for k in range(min(i, j)) if a[i - 1 - k] != b[j - 1 - k]), min(i, j))
    most = min(len(a) - i, len(b) - j)
    return up + next((k for k in range(most) if a[i + k] != b[j + k]), most)


def patience(a: list[int], b: list[int], likeness: Callable[[int, int], int]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b) of two sequences of line hashes: of the lines that occur once on either side a longest
    chain in the same order, common lines next to its links, and the same again between these. Where all common
    lines repeat, the least frequent one takes the place of the chain, at the two places of the greatest likeness."""
    found, todo = [], [(0, len(a), 0, len(b), False, False)]
    while todo:
        i, m, j, n, after, before = todo.pop()
        while after and i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while before and i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i == m or j == n:
            continue
        at_a: dict[int, list[int]] = {}
        at_b: dict[int, list[int]] = {}
        for side, places, lo, hi in ((a, at_a, i, m), (b, at_b, j, n)):
            for k in range(lo, hi):
                places.setdefault(side[k], []).append(k)
        common = at_a.keys() & at_b.keys()
        once = sorted((at_a[h][0], at_b[h][0]) for h in common if len(at_a[h]) == len(at_b[h]) == 1)
        if once:
            once = [once[k] for k in increasing([y for _, y in once])]
        elif common:
            h = min(common, key=lambda h: (len(at_a[h]) * len(at_b[h]), at_b[h][0]))
            once = [max(((p, q) for p in at_a[h][:NEAR] for q in at_b[h][:NEAR]), key=lambda pq: likeness(*pq))]
        if once:
            links = [(i, j), *once, (m, n)]
            todo += [(p, q, r, s, k > 0, k < len(once)) for k, ((p, r), (q, s)) in enumerate(zip(links, links[1:], strict=False))]
    return sorted(found)


def repeated(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]], min_words: int = MIN_WORDS) -> list[int]:
    """Lines of b in the blocks of min_words words that are aligned with a.

    One alignment leaves blocks that come in another order or more often than in a, so what is left of b between the
    deleted blocks is aligned with all of a again, until nothing more is found. Lines outside the common runs of
    min_words words can't be in such a block and don't take part.
    """
    (x, _), (y, words) = a, b
    in_a, in_b = runs(*a, min_words), runs(*b, min_words)
    shared = in_a.keys() & in_b.keys()
    of_a, rest = ({i for h in shared for lo, hi in side[h] for i in range(lo, hi)} for side in (in_a, in_b))
    total = np.concatenate([[0], np.cumsum(words)])
    places: dict[int, list[int]] = {}
    for i in sorted(of_a):
        places.setdefault(x[i], []).append(i)
    gone: set[int] = set()
    pieces = [sorted(rest)]
    while pieces:
        left = []
        for piece in pieces:
            own = sorted(i for h in {y[j] for j in piece} for i in places.get(h, ()))
            new: set[int] = set()
            end = (-1, -1)
            for i, j in ((own[i], piece[j]) for i, j in patience([x[i] for i in own], [y[j] for j in piece], lambda i, j: alike(x, y, own[i], piece[j]))):  # noqa: B023
                if i < end[0] and j < end[1] and i - j == end[0] - end[1]:
                    continue  # inside the block before
                lo_i, lo_j, hi_i, hi_j = i, j, i + 1, j + 1
                while lo_i and lo_j and x[lo_i - 1] == y[lo_j - 1]:
                    lo_i, lo_j = lo_i - 1, lo_j - 1
                while hi_i < len(x) and hi_j < len(y) and x[hi_i] == y[hi_j]:
                    hi_i, hi_j = hi_i + 1, hi_j + 1
                end = (hi_i, hi_j)
                while not words[lo_j] and lo_j < j:
                    lo_j += 1
                while not words[hi_j - 1] and hi_j > j + 1:
                    hi_j -= 1
                if total[hi_j] - total[lo_j] >= min_words:
                    new |= set(range(lo_j, hi_j))
            if new - gone:
                gone |= new
                left.append(piece)
        pieces = []
        for piece in left:
            kept = [j for j in piece if j not in gone]
            cuts = [k for k in range(1, len(kept)) if kept[k] != kept[k - 1] + 1]
            pieces += [kept[p:q] for p, q in zip([0, *cuts], [*cuts, len(kept)], strict=True) if p < q]
    for h in shared:  # each line of a common block is in one of its runs; runs that are left are aligned by themselves
        lo_a, hi_a = in_a[h][0]
        for lo, hi in in_b[h]:
            if gone.issuperset(j for j in range(lo, hi) if words[j]):
                continue
            aligned = patience(x[lo_a:hi_a], y[lo:hi], lambda i, j: alike(x[lo_a:hi_a], y[lo:hi], i, j))  # noqa: B023
            if aligned != [(k, k) for k in range(hi - lo)]:
                continue
            while not words[lo]:
                lo += 1
            while not words[hi - 1]:
                hi -= 1
            gone |= set(range(lo, hi))
    return sorted(gone)


def profiles(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, hashes, words, runs) of every document with an id that has min_words words; repeats once."""
    schema = "id long, text_hash long, hashes array<long>, words array<int>, runs array<long>"
    arrow = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("hashes", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("runs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            rows = []
            for i, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                hashes, words = lines_of(text.as_py())
                if sum(words) >= min_words:
                    rows.append((i, t, hashes, words, sorted(runs(hashes, words, min_words))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    rows = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(text_col)).mapInArrow(run, schema)
    return rows.dropDuplicates(["id", "text_hash"])


def deletions(docs: DataFrame, *, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, lines array<int>): the 0-based lines that each document loses. Documents that lose none are absent."""
    own = stash(profiles(docs, min_words, id_col, text_col), "profiles")
    held = own.select("id", "text_hash", F.explode("runs").alias("run"))
    first = held.groupBy("run").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.max(F.struct("id", "text_hash")).alias("last")).filter("first <> last")
    pairs = held.join(first.select("run", "first"), "run").filter(F.col("first") < F.struct("id", "text_hash"))
    pairs = stash(pairs.select("id", "text_hash", F.col("first.id").alias("id_a"), F.col("first.text_hash").alias("hash_a")).distinct(), "pairs")
    a = own.select(F.col("id").alias("id_a"), F.col("text_hash").alias("hash_a"), F.col("hashes").alias("a_hashes"), F.col("words").alias("a_words"))
    both = pairs.join(a, ["id_a", "hash_a"]).join(own.select("id", "text_hash", "hashes", "words"), ["id", "text_hash"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            ids, hashes, lines = [], [], []
            for i, t, *sides in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = repeated((sides[0], sides[1]), (sides[2], sides[3]), min_words)
                ids += [i] * len(found)
                hashes += [t] * len(found)
                lines += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(lines, pa.int32())], names=["id", "text_hash", "line"])

    cut = both.select("id", "text_hash", "a_hashes", "a_words", "hashes", "words").mapInArrow(align, "id long, text_hash long, line int")
    return cut.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def without_lines(text: Column, lines: Column) -> Column:
    """text without the given lines; texts that lose none don't leave the JVM."""
    @F.pandas_udf("string")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for t, g in zip(texts, gone, strict=True):
            gone_here = set() if t is None else set(g.tolist())
            out.append(None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone_here))
        return pd.Series(out, dtype="object")

    return F.when(lines.isNull(), text).otherwise(cut(F.when(lines.isNotNull(), text), lines))


def dedup_lines(docs: DataFrame, *, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", report: str | None = None) -> DataFrame:
    """docs, all rows and columns, with the repeated blocks gone from text. report: a column for the deleted lines.

    A document of which everything is repeated keeps its row with an empty text. Rows with a null id or text stay as
    they are and count as nobody's earlier document; rows of one id and one text are one document, so that none is
    later than the other; of one id with several texts the hash of the text decides.
    """
    key = {c: fresh(docs, f"cut_{c}") for c in ("id", "text_hash", "lines")}
    cut = deletions(docs, min_words=min_words, id_col=id_col, text_col=text_col)
    cut = stash(cut, "deletions").select(*(F.col(c).alias(k) for c, k in key.items()))
    # merged at every size: a broadcast of the deletions would end once they outgrow it
    joined = docs.join(cut.hint("merge"), (F.col(id_col).cast("long") == F.col(key["id"])) & (F.xxhash64(text_col) == F.col(key["text_hash"])), "left")
    text = without_lines(F.col(text_col), F.col(key["lines"]))
    out = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*out, *([F.col(key["lines"]).alias(report)] if report else []))
