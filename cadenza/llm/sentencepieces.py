"""SentencePiece encoding and decoding with the tokenizers library: the model file is parsed here, its normaliser,
white space marker, scores and byte fallback are rebuilt, batches are encoded on several threads, and each text's ids
are compared with those of the sentencepiece library.

BPE models become merges ordered by the score of the piece that they make; unigram models keep their scores. A text is
cut between a mark-free character and a white space marker before it is segmented. That changes nothing where no piece
of the vocabulary reaches over such a place, which is looked up while the model is rebuilt.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cadenza.llm.common import bounded, fresh

MARK = "▁"
#: Where the vocabulary file is, unless a caller names another.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
#: Fixed values of the model file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; values of fixed width stay bytes."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        else:
            n, at = varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + n], at + n
        yield key >> 3, value


@dataclass
class Model:
    """What a model file says, with the format's defaults."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        m = cls()
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                m.pieces.append(piece[1].decode())
                m.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                m.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
                m.model_type, m.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                normal = dict(fields(value))
                m.charsmap = normal.get(2, b"")
                m.dummy_prefix, m.squeeze, m.escape = (bool(normal.get(k, 1)) for k in (3, 4, 5))
        if m.model_type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {m.model_type} is neither unigram nor BPE")
        m.unk_id = m.kinds.index(UNKNOWN) if UNKNOWN in m.kinds else 0
        return m


def merges(m: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score of the result first."""
    ids = {p: i for i, p in enumerate(m.pieces) if m.kinds[i] in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-m.scores[i], i, left, right))
    return [(m.pieces[a], m.pieces[b]) for *_, a, b in sorted(found)]


def cuttable(m: Model) -> bool:
    """No piece reaches from a character over a marker: segments can be found marker by marker."""
    return m.escape and USER_DEFINED not in m.kinds and not any(MARK in p.lstrip(MARK) for p in m.pieces)


def rebuild(m: Model):
    """The model as a tokenizers.Tokenizer for whole texts."""
    import tokenizers as T

    if m.model_type == BPE:
        core = T.models.BPE({p: i for i, p in enumerate(m.pieces)}, merges(m), unk_token=m.pieces[m.unk_id], fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        core = T.models.Unigram(list(zip(m.pieces, m.scores, strict=True)), m.unk_id, m.byte_fallback)
    out = T.Tokenizer(core)
    steps = [T.normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.squeeze:
        steps += [T.normalizers.Replace(T.Regex(r"\A +| +\z"), ""), T.normalizers.Replace(T.Regex(" {2,}"), " ")]
    if m.escape:
        steps.append(T.normalizers.Replace(" ", MARK))
    if m.dummy_prefix:
        steps.append(T.normalizers.Prepend(MARK if m.escape else " "))
    out.normalizer = T.normalizers.Sequence(steps)
    out.decoder = T.decoders.Sequence([T.decoders.Replace(MARK, " "), T.decoders.ByteFallback(), T.decoders.Fuse(), *([T.decoders.Strip(" ", 1, 0)] if m.dummy_prefix else [])])
    own = [p for p, k in zip(m.pieces, m.kinds, strict=True) if k == USER_DEFINED]
    if own:
        out.add_tokens([T.AddedToken(p, normalized=False, special=False) for p in own])
    return out


SEGMENT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Segments encoded in one string.
TOGETHER = 500
#: Fixed value of the library: what an unknown character costs beyond the worst score.
UNKNOWN_PENALTY = 10.0


def path_tables(m: Model) -> tuple[dict[str, np.float32], int, np.float32, dict[str, int]]:
    """What best_path looks up: scores of the pieces that may come from text, their longest, what an unknown character
    costs, and all ids."""
    scores = {p: np.float32(x) for p, x, k in zip(m.pieces, m.scores, m.kinds, strict=True) if k == NORMAL}
    return scores, max(map(len, scores), default=1), np.float32(min(scores.values(), default=0) - UNKNOWN_PENALTY), {p: i for i, p in enumerate(m.pieces)}


def best_path(m: Model, text: str, tables: tuple) -> list[int]:
    """Ids of a normalised text's likeliest pieces in single precision, summed up from the text's beginning, which is what
    decides between paths that are next to equally likely. Only pieces that may come from text are looked up."""
    scores, longest, unknown, ids = tables
    best: list[tuple[np.float32, int, bool] | None] = [(np.float32(0), 0, False), *[None] * len(text)]
    for at in range(len(text)):
        here = best[at][0]
        for end in range(at + 1, min(len(text), at + longest) + 1):
            if (own := scores.get(text[at:end])) is not None:
                if best[end] is None or here + own > best[end][0]:
                    best[end] = (here + own, at, True)
            elif end == at + 1 and (best[end] is None or here + unknown > best[end][0]):
                best[end] = (here + unknown, at, False)
    out: list[list[int]] = []
    at, was_unknown = len(text), False
    while at:
        _, begin, known = best[at]
        if known:
            out.append([ids[text[begin:at]]])
        elif m.byte_fallback:
            out.append([ids[f"<0x{b:02X}>"] for b in text[begin:at].encode()])
        elif not was_unknown:
            out.append([m.unk_id])
        at, was_unknown = begin, not known
    return [i for part in reversed(out) for i in part]


class Encoder:
    """Batches of texts to ids. Where pieces don't reach over white space markers, a batch's distinct segments are looked
    up, and those that a worker hasn't met go to the tokenizer as one batch, which it deals to its threads. At most `most`
    segments are remembered, or those of one batch."""

    def __init__(self, model: bytes, most: int = 150_000) -> None:
        import tokenizers as T

        self.model = m = Model.parse(model)
        self.whole, self.tokenizer = rebuild(m), rebuild(m)
        self.cut = cuttable(m)
        self.plain = not m.charsmap and not m.squeeze and m.escape
        self.most = most
        self.forget()
        if self.cut:
            self.tokenizer.normalizer = T.normalizers.Sequence([])
        # markers are turned back into spaces on whole texts: token by token that takes longer than all the rest
        self.whole.decoder = T.decoders.Sequence([T.decoders.ByteFallback(), T.decoders.Fuse()])
        #: Of a unigram model's paths some are next to equally likely: what decides is the model's own single precision.
        self.single = path_tables(m) if m.model_type == UNIGRAM and USER_DEFINED not in m.kinds else None
        self.bytes = np.array([1 if k == BYTE else len(p.encode()) if k == NORMAL else 1 << 40 for p, k in zip(m.pieces, m.kinds, strict=True)], np.int64)

    def forget(self) -> None:
        """known: the place of each remembered segment; its ids are those of flat from ends[place] to ends[place + 1]."""
        self.known: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encoded(self, names: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(names in another order, their ids one after the other, how many each has). TOGETHER segments are encoded in one
        string, as no piece reaches from one to the next; those of a string whose pieces don't give its bytes back, and
        names that aren't segments, are encoded by themselves."""
        plain = [s for s in names if self.cut and s[0] == MARK and s[-1] != MARK]
        units = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(["".join(u) for u in units], add_special_tokens=False)]
        done, parts, sizes = [], [], []
        for unit, ids in zip(units, lists, strict=True):
            flat = np.array(ids, np.int32)
            ends, last = np.cumsum(self.bytes[flat]), np.cumsum([len(s.encode()) for s in unit])
            until = np.searchsorted(ends, last)
            if len(ends) and until[-1] == len(ends) - 1 and np.array_equal(ends[until], last):
                done += unit
                parts.append(flat)
                sizes.append(np.diff(until, prepend=-1))
        known = set(done)
        rest = [s for s in names if s not in known]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        parts.append(np.fromiter(chain.from_iterable(lists), np.int32, int(sizes[-1].sum())))
        return done + rest, np.concatenate(parts), np.concatenate(sizes)

    def places(self, names: list[str]) -> np.ndarray:
        """Of each of the distinct names, its place among the remembered segments."""
        new = [s for s in names if s not in self.known]
        if len(self.known) + len(new) > self.most:
            self.forget()
            new = names
        new, ids, size = self.encoded(new)
        self.flat = np.concatenate([self.flat, ids])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
        return np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))

    def normal(self, text: str) -> str:
        m = self.model
        if not self.plain:
            return self.whole.normalizer.normalize_str(text)
        return MARK * (m.dummy_prefix and bool(text)) + text.replace(" ", MARK)

    def wanted(self, text: str) -> str:
        """What decoding gives back: the normalised text."""
        if self.plain:
            return text.replace(MARK, " ")
        found = self.normal(text)
        return (found.replace(MARK, " ") if self.model.escape else found)[bool(found) and self.model.dummy_prefix :]

    def segments(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(segment, number, names): the segments of all texts one after the other by their place in names, and how many
        each text has. Texts without doubled spaces or markers are split in one go."""
        n = len(texts)
        if self.plain and self.model.dummy_prefix:
            parts = pc.split_pattern(texts, " ")
            coded = parts.flatten().dictionary_encode()
            odd = pc.or_(pc.equal(coded.dictionary, ""), pc.match_substring(coded.dictionary, MARK)).to_numpy(zero_copy_only=False)
            at, number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
            names = pc.binary_join_element_wise(pa.scalar(MARK), coded.dictionary, pa.scalar("")).to_pylist() if len(coded.dictionary) else []
            doc = np.repeat(np.arange(n), number)
            slow = np.flatnonzero(np.bincount(doc, odd[at] if len(at) else None, minlength=n) > 0)
        else:
            at, number, names, doc, slow = np.zeros(0, np.int64), np.zeros(n, np.int64), [], np.zeros(0, np.int64), np.arange(n)
        if not len(slow):
            return at, number, names
        more = {s: i for i, s in enumerate(names)}
        lists = np.split(at, np.cumsum(number)[:-1])
        for i in slow:
            lists[i] = np.array([more.setdefault(s, len(more)) for s in SEGMENT.findall(self.normal(texts[int(i)].as_py()))], np.int64)
            number[i] = len(lists[i])
        return np.concatenate(lists), number, list(more)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin, and the end)."""
        if self.single is not None:
            lists = [np.array(best_path(self.model, self.normal(t), self.single), np.int32) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.int32), *lists]), np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
        if self.cut:
            segment, number, names = self.segments(texts)
            place = self.places(names)[segment]
        else:
            names = texts.to_pylist()
            self.forget()  # whole texts aren't worth remembering
            self.places(list(dict.fromkeys(names)))
            number, place = np.ones(len(texts), np.int64), np.array([self.known[t] for t in names], np.int64)
        begin = self.ends[place]
        own = self.ends[place + 1] - begin
        ends = np.cumsum(own)
        ids = self.flat[np.repeat(begin - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(number)])]
        return ids, bounds

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of whole id lists."""
        flat = ids.tolist()
        found = self.whole.decode_batch([flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], skip_special_tokens=False)
        texts = [t.replace(MARK, " ") for t in found]
        return [t[t.startswith(" ") :] for t in texts] if self.model.dummy_prefix else texts


def model_bytes(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, *, text_col: str = "text", ids: str = "ids", threads: int = THREADS, verify: bool = True) -> DataFrame:
    """docs with the ids of each text and, if verify, two columns more: parity (the sentencepiece library gives the same
    ids) and decodes (the whole ids, decoded, give the text back, as normalised).

    Null text: all three null; empty text: no ids. Whole texts are encoded, however long, and repeated rows alike. Of a
    unigram model's paths some are next to equally likely; its texts are segmented in the model's single precision, by a
    plain Viterbi pass, so that ids don't depend on verify. The model file's bytes are a few MB at most and go to the workers by
    broadcast. New columns get other names if docs has theirs: underscores are put before them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [fresh(docs, ids), *([fresh(docs, "parity"), fresh(docs, "decodes")] if verify else [])]
    kinds = ["array<int>", *(["boolean", "boolean"] if verify else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        import sentencepiece

        encoder = Encoder(shared.value)
        judge = sentencepiece.SentencePieceProcessor(model_proto=shared.value) if verify else None

        def differing(theirs: list[np.ndarray], found: np.ndarray, bounds: np.ndarray) -> list[int]:
            return [i for i, x in enumerate(theirs) if not np.array_equal(x, found[bounds[i] : bounds[i + 1]])]

        for batch in bounded(batches, 1 << 13, 2 << 20):
            column = batch.column(batch.schema.names.index(text_col))
            there = column.is_valid().to_numpy(zero_copy_only=False)
            texts = column.drop_null()
            found, bounds = encoder(texts)
            marks = []
            if verify:
                strings = texts.to_pylist()
                theirs = judge.encode(strings, num_threads=1, out_type="numpy")
                wrong = differing(theirs, found, bounds)
                same = np.ones(len(texts), bool)
                same[wrong] = False
                back = encoder.decode(found, bounds)
                marks = [same, np.array([b == encoder.wanted(t) for b, t in zip(back, strings, strict=True)], bool)]
            place = np.concatenate([[0], np.cumsum(there)])
            lists = pa.ListArray.from_arrays(pa.array(bounds[place], pa.int32()), pa.array(found, pa.int32()), mask=pa.array(~there))
            spread = [pa.array(np.concatenate([m, [False]])[np.minimum(place[:-1], len(m))], mask=~there) for m in marks]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, *spread], names=[*batch.schema.names, *names])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))])
    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, model: bytes, *, ids_col: str = "ids", text: str = "text") -> DataFrame:
    """tokens with the text that the ids give. Null ids: null; no ids: empty."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)
    name = fresh(tokens, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = rebuild(Model.parse(shared.value))
        for batch in bounded(batches):
            ids = batch.column(batch.schema.names.index(ids_col)).to_pylist()
            found = iter(tokenizer.decode_batch([x for x in ids if x is not None], skip_special_tokens=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None if x is None else next(found) for x in ids], pa.string())], names=[*batch.schema.names, name])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema), f"`{name}` string"])
    return tokens.mapInArrow(run, schema)
