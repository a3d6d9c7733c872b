"""Cross-tokenizer alignment: the ids of a byte-level BPE (A) and of a SentencePiece model (B) over the same bytes.

Both cut space + text into tokens. Dictionaries lead from each token's cumulative end to its index; the ends that both
have, sorted, cut the two id lists into groups, and within a group each two tokens whose bytes overlap are a link.

A text is cut before single spaces between characters that aren't white space. Neither tokenizer has a token over such
a place, so both end there, groups never reach over it, and each distinct segment needs to be encoded and aligned once.

How many documents hold a link's pair of ids is counted over the corpus in two steps: blocks of a few MB of text count
their distinct pairs, and the sums go back to the blocks. So what is shuffled are a block's distinct pairs, not links,
and a pair that all documents hold has one row a block.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.chat import TOKENIZER_PATH, tokenizer_json
from cadenza.llm.common import bounded, fresh, stash
from cadenza.llm.sentencepieces import BYTE, MARK, MODEL_PATH, Model, cuttable, model_bytes

#: Rows and bytes of a block.
BLOCK_ROWS, BLOCK_BYTES = 1 << 12, 3 << 20
#: Distinct segments that a worker remembers.
REMEMBERED = 150_000
#: A place where neither tokenizer has a token over: a single space between characters that aren't white space.
CUT = re.compile(r"(?<=\S) (?=\S)")

#: Segments encoded in one string.
TOGETHER = 500


@lru_cache(1)
def unprintable() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters are themselves, the
    other bytes follow from U+0100 in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ends that both token lists have, sorted, and how many tokens of A and of B there are up to each."""
    a, b = (dict(zip(e.tolist(), range(1, len(e) + 1), strict=True)) for e in (a_ends, b_ends))
    keys = sorted(a.keys() & b.keys())
    return np.array(keys, np.int64), np.fromiter(map(a.__getitem__, keys), np.int64, len(keys)), np.fromiter(map(b.__getitem__, keys), np.int64, len(keys))


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of all slices: between two neighbouring ends of either list lie the bytes that one token of A and one of B
    share. (end, index in A, index in B), by end."""
    there = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 0, bool)
    there[a_ends] = there[b_ends] = True
    every = np.flatnonzero(there)
    return every, np.searchsorted(a_ends, every), np.searchsorted(b_ends, every)


def written(a: pa.Array, b: pa.Array, a_number: np.ndarray, b_number: np.ndarray, groups: np.ndarray) -> pa.Array:
    """Groups as strings: the ids of A and B (strings), how many of each a group has, and how many groups a string has."""
    a, b = (pc.binary_join(of_lengths(ids, number), ",") for ids, number in ((a, a_number), (b, b_number)))
    return pc.binary_join(of_lengths(pc.binary_join_element_wise(a, b, "|"), groups), ";")


def of_lengths(values: pa.Array, number: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), values)


def segments(text: str) -> list[str]:
    return CUT.split(text)


class Aligner:
    """Distinct segments, encoded by both tokenizers and aligned. Of each it remembers: number of A tokens, of B tokens, of
    groups and of links (-1 in all where the bytes of a tokenizer's tokens aren't the segment's), its groups as a string,
    and its links as A id * 2^32 + B id."""

    def __init__(self, tokenizer: str, model: bytes, most: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on each core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        code = unprintable()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.a_bytes[i] = t.encode() if t in special else bytes(code[c] for c in t)
        parsed = Model.parse(model)
        if not (cuttable(parsed) and parsed.dummy_prefix and not parsed.squeeze and not parsed.charsmap):
            raise ValueError("texts can't be cut at spaces for this model")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() for p, k in zip(parsed.pieces, parsed.kinds, strict=True)]
        self.sizes_of = [np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes)]
        self.names_of = [pa.array(map(str, range(len(x))), pa.string()) for x in (self.a_bytes, self.b_bytes)]
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes = np.zeros((0, 4), np.int64)
        self.strings: list[str] = []
        self.links, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def aligned(self, units: list[list[str]]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """What is remembered of all segments of the units, one after the other: sizes, strings, all links. A unit's segments are
        encoded in one string; where that doesn't give its bytes back, they are taken one by one."""
        texts = [" ".join(u) for u in units]
        whole = [b" " + t.encode() for t in texts]
        ids = [[e.ids for e in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1)]
        good = [b"".join(map(self.a_bytes.__getitem__, x)) == b"".join(map(self.b_bytes.__getitem__, y)) == w for x, y, w in zip(*ids, whole, strict=True)]
        if not all(good):
            if all(g or len(u) == 1 for g, u in zip(good, units, strict=True)):
                kept = [u for g, u in zip(good, units, strict=True) if g]
                some, words, links = self.aligned(kept) if kept else (np.zeros((0, 4), np.int64), [], np.zeros(0, np.int64))
                there = np.repeat(good, list(map(len, units)))
                sizes, rest = np.full((len(there), 4), -1), iter(words)
                sizes[there] = some
                return sizes, [next(rest) if t else "" for t in there], links
            return self.aligned([p for g, u in zip(good, units, strict=True) for p in ([u] if g else [[s] for s in u])])
        flat = [np.fromiter(chain.from_iterable(x), np.int64) for x in ids]
        ends = [np.cumsum(n[x]) for n, x in zip(self.sizes_of, flat, strict=True)]
        last = np.cumsum([1 + len(s.encode()) for u in units for s in u])
        common, *upto = common_ends(*ends)
        every, *index = links_of(*ends)
        if not np.isin(last, common).all():
            raise ValueError("a token reaches over a space between words")
        until = [np.searchsorted(x, last, "right") for x in (*ends, common, every)]
        sizes = np.stack([np.diff(u, prepend=0) for u in until], axis=1)
        ids = [names.take(pa.array(x)) for names, x in zip(self.names_of, flat, strict=True)]
        strings = written(*ids, *(np.diff(u, prepend=0) for u in upto), sizes[:, 2]).to_pylist()
        return sizes, strings, flat[0][index[0]] << 32 | flat[1][index[1]]

    def places(self, names: list[str]) -> np.ndarray:
        """Of each of the distinct segments, its place among the remembered ones."""
        new = [s for s in names if s not in self.known]
        if len(self.known) + len(new) > self.most:
            self.forget()
            new = names
        if new:
            odd = [s == "" or s != s.strip() for s in new]
            plain = [s for s, o in zip(new, odd, strict=True) if not o]
            units = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)] + [[s] for s, o in zip(new, odd, strict=True) if o]
            sizes, strings, links = self.aligned(units)
            self.sizes = np.concatenate([self.sizes, sizes])
            self.strings += strings
            self.links = np.concatenate([self.links, links])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.maximum(0, sizes[:, 3]))])
            self.known.update(zip(chain.from_iterable(units), range(len(self.known), len(self.known) + len(new)), strict=True))
        return np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))


def split(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(segment, number, names): the segments of all texts one after the other by their place in names, and how many each
    text has; null and empty texts have none. Texts whose spaces are all single ones are split in one go."""
    column = pa.array([t or None for t in texts], pa.string())
    parts = pc.split_pattern(column, " ")
    coded = parts.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    odd = np.array([s == "" or s != s.strip() for s in names], bool)
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    number = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), number)
    slow = np.unique(doc[odd[at]]) if len(at) else np.zeros(0, np.int64)
    if not len(slow):
        return at, number, names
    more = {s: i for i, s in enumerate(names)}
    lists = np.split(at, np.cumsum(number)[:-1])
    for i in slow:
        lists[i] = np.array([more.setdefault(s, len(more)) for s in segments(texts[i])], np.int64)
        number[i] = len(lists[i])
    return np.concatenate(lists), number, list(more)


def summed(values: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of the given lengths."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(number)
    return total[ends] - total[ends - number]


def expanded(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1 and so on, size[0] of them, then those of the next."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def lists(values: np.ndarray, number: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), pa.array(values, kind))


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
#: Rows of documents (pairs is null: at says which of the block's pairs a document holds linked, times how often), and one row
#: for each block (pairs, and how many of its documents hold each).
BLOCKS = "block long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<int>, pairs array<long>, docs array<int>"


def aligned(docs: DataFrame, tokenizer: str, model: bytes, *, text_col: str = "text", groups: str = "groups") -> DataFrame:
    """docs with their groups, an array of (a, b): the ids of both tokenizers from one common end to the next.

    Null and empty texts, and texts with bytes that a tokenizer doesn't keep, have null. Whole texts, repeated rows alike;
    extra columns stay, and the new one gets an underscore where docs has its name."""
    shared, name = docs.sparkSession.sparkContext.broadcast((tokenizer, model)), fresh(docs, groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        for batch in bounded(batches):
            segment, number, names = split(batch.column(batch.schema.names.index(text_col)).to_pylist())
            place = aligner.places(names)[segment]
            out, ends = [], np.cumsum(number)
            for begin, end in zip(ends - number, ends, strict=True):
                own = [aligner.strings[p] for p in place[begin:end]]
                parts = [tuple([int(x) for x in ids.split(",")] for ids in g.split("|")) for s in own for g in s.split(";")] if own and all(own) else None
                out.append(parts and [{"a": a, "b": b} for a, b in parts])
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, name])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{name}` array<struct<a:array<int>,b:array<int>>>"])
    return docs.mapInArrow(run, schema)


def blocks(docs: DataFrame, tokenizer: str, model: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows as in BLOCKS: documents with their numbers of tokens, groups and links, the digest of their groups and the pairs
    that they hold; and the blocks' distinct pairs. It is written to the shared folder, which fixes the blocks."""
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*shared.value)
        block = TaskContext.get().partitionId() << 32
        for batch in bounded(batches, BLOCK_ROWS, BLOCK_BYTES):
            block += 1
            n = batch.num_rows
            segment, number, names = split(batch.column(1).to_pylist())
            place = aligner.places(names)
            sizes = aligner.sizes[place]
            good = (number > 0) & (summed((sizes[segment, 0] < 0).astype(np.int64), number) == 0)
            doc = np.repeat(np.arange(n), number)
            segment, doc = segment[good[doc]], doc[good[doc]]
            number = np.where(good, number, 0)
            counts = [summed(sizes[segment, k], number) for k in range(4)]
            strings = pa.array([aligner.strings[p] for p in place], pa.string()).take(pa.array(segment)) if len(segment) else pa.array([], pa.string())
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), strings), ";").to_pylist()
            digests = [hashlib.sha256(s.encode()).hexdigest() if ok else "" for s, ok in zip(joined, good, strict=True)]
            # a document's distinct segments, then their links, then its distinct pairs
            some, often = np.unique(doc * max(1, len(names)) + segment, return_counts=True)
            doc, own = some // max(1, len(names)), place[some % max(1, len(names))]
            size = aligner.ends[own + 1] - aligner.ends[own]
            pairs, which = np.unique(aligner.links[expanded(aligner.ends[own], size)], return_inverse=True)
            keys, back = np.unique(np.repeat(doc, size) * max(1, len(pairs)) + which, return_inverse=True)
            times = np.bincount(back, np.repeat(often, size), minlength=len(keys)).astype(np.int32)
            doc, at = keys // max(1, len(pairs)), (keys % max(1, len(pairs))).astype(np.int32)
            held = np.bincount(doc, minlength=n)
            more = int(len(pairs) > 0)  # a row for the block itself
            at_lists = lists(at, np.concatenate([held, np.zeros(more, np.int64)]), pa.int32())
            time_lists = lists(times, np.concatenate([held, np.zeros(more, np.int64)]), pa.int32())
            ids = pa.concat_arrays([batch.column(0).cast(pa.int64()), pa.nulls(more, pa.int64())])
            cols = [pa.array(np.full(n + more, block)), ids, *(pa.array(np.concatenate([c, np.zeros(more, np.int64)])) for c in counts)]
            cols += [pa.array(digests + [""] * more, pa.string()), at_lists, time_lists]
            cols += [pa.array([None] * n + [pairs] * more, pa.list_(pa.int64())), pa.array([None] * n + [np.bincount(at, minlength=len(pairs)).astype(np.int32)] * more, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in BLOCKS.split(", ")])

    return stash(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCKS), "blocks")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, docs, best) of the blocks' pairs: how many documents hold it linked, and whether no pair of its A id is held by
    more. One row for each A id of the vocabulary, its highest count, goes to all tasks."""
    each = found.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = stash(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("docs")), "pairs")
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("docs").alias("highest"))
    joined = counts.join(F.broadcast(highest), F.shiftright("pair", 32) == F.col("a"))  # at most as many rows as A has ids
    return joined.select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def summaries(docs: DataFrame, tokenizer: str, model: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A pair's count is the number of rows that hold it linked; n_best counts the links whose count is the highest of their A
    id, count_sum adds the counts of all links. Null and empty texts, and texts whose A or B bytes aren't space + text (such
    as those with U+2581), have zeros and ''. Repeated rows and rows with one id or none count and are returned one by one;
    an empty table gives no rows; other columns are left out. A very long text is a block of its own."""
    found = blocks(docs, tokenizer, model, id_col=id_col, text_col=text_col)
    places = found.filter("pairs IS NOT NULL").select("block", F.posexplode("pairs").alias("i", "pair"))
    counted = places.join(pair_counts(found), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", "docs", "best"))).alias("c"))
    counted = counted.select(F.col("block").alias("of"), F.col("c.docs").alias("docs"), F.col("c.best").alias("best"))
    own = found.filter("pairs IS NULL").drop("pairs", "docs")
    names = ["id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        at = [rows.column(c).combine_chunks() for c in ("at", "times")]
        number = pc.list_value_length(at[0]).to_numpy(zero_copy_only=False).astype(np.int64)
        at, times = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in at)
        values = [counts.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) if counts.num_rows else np.zeros(0, np.int64) for c in ("best", "docs")]
        sums = [pa.array(summed(v[at] * times if len(v) else times[:0], number)) for v in values]
        return pa.table([*(rows.column(c) for c in names[:5]), *sums, rows.column("groups_sha256")], names=names)

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(score, schema)


__all__ = ["MODEL_PATH", "TOKENIZER_PATH", "Aligner", "aligned", "blocks", "common_ends", "links_of", "model_bytes", "pair_counts", "segments", "summaries", "tokenizer_json", "written"]
