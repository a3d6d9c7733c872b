import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from cadenza.llm import sentencepieces
from cadenza.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  two  spaces ", "\n\ttabs\r\n", "▁marks ▁▁ in▁text", "<s> </s> <unk> <0x41> x<0x0A>", "emoji 🏳️‍🌈 and \u0000 nul", "ﬁ ½ é é", "$ $$ $$$ $$ $", "word " * 50_000, "x" * 20_000]


@pytest.fixture(scope="module")
def model():
    return sentencepieces.model_bytes()


def test_whole_table_against_sentencepiece(spark, model):
    judge = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = table(spark, SF, "documents")
    rows = sentencepieces.encode(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(r.ids == judge.encode(r.text) and r.parity and r.decodes for r in rows if r.text is not None)


def proto(pieces, model_type, byte_fallback, normal=b"\x18\x01\x20\x01\x28\x01"):
    """A model file of pieces (text, score, kind); by default dummy prefix, squeezed and escaped white space."""
    size = lambda data: varint(len(data)) + data

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    out = b""
    for text, score, kind in pieces:
        out += b"\x0a" + size(b"\x0a" + size(text.encode()) + b"\x15" + np.float32(score).tobytes() + b"\x18" + varint(kind))
    trainer = b"\x18" + varint(model_type) + b"\x98\x02" + varint(int(byte_fallback))
    return out + b"\x12" + size(trainer) + b"\x1a" + size(normal)


def made_up(texts, model_type, byte_fallback):
    """Pieces by plain counts of substrings: no trained tokenizer, but scores with ties."""
    counts = Counter(w[i:j] for t in texts for w in ("▁" + t.replace(" ", " ▁")).split() for i in range(len(w)) for j in range(i + 1, min(len(w), i + 6) + 1) if "▁" not in w[i + 1 : j])
    letters = {c for t in texts for c in t.replace(" ", "▁") if c.isascii() or c == "▁"} - {"\n"}
    some = sorted(letters) + [p for p, n in counts.most_common(1500) if len(p) > 1]
    if model_type == sentencepieces.BPE:  # each piece needs two that make it
        have = set(letters)
        some = sorted(letters) + [p for p in sorted(some, key=len) if len(p) > 1 and any(p[:k] in have and p[k:] in have for k in range(1, len(p))) and not have.add(p)]
    pieces = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + ([(f"<0x{b:02X}>", 0, 6) for b in range(256)] if byte_fallback else [])
    rank = {p: -i for i, p in enumerate(some)}
    score = lambda p: rank[p] if model_type == sentencepieces.BPE else round(math.log((counts[p] + 1) / 1e6) * 4) / 4
    return proto([*pieces, *((p, score(p), 1) for p in some), ("never", 3, 5)], model_type, byte_fallback)


@pytest.mark.parametrize("byte_fallback", [False, True])
@pytest.mark.parametrize("model_type", [sentencepieces.UNIGRAM, sentencepieces.BPE])
def test_other_models_against_sentencepiece(spark, model_type, byte_fallback):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = made_up([r.text for r in docs.limit(60).collect() if r.text], model_type, byte_fallback)
    judge = sentencepiece.SentencePieceProcessor(model_proto=model)
    more = spark.createDataFrame([(-i, f"{t} never said" if t else t) for i, t in enumerate(ODD)], "doc_id long, text string")
    for r in sentencepieces.encode(docs.union(more), model).collect():
        assert (r.ids, r.parity) == ((None, None) if r.text is None else (judge.encode(r.text), True)), r.text[:99]
        assert r.decodes is None if r.text is None else r.decodes or judge.unk_id() in r.ids
    plain = sentencepieces.encode(docs, model, verify=False).collect()
    assert all(r.ids == judge.encode(r.text) for r in plain if r.text is not None)


def test_pieces_that_never_come_from_text():
    model = proto([("<unk>", 0, 2), ("<s>", 0, 3), ("▁", -3, 1), ("a", -2, 1), ("s", -2, 1), ("<", -2, 1), (">", -2, 1), ("aa", 9, 5)], sentencepieces.UNIGRAM, False)
    ids, bounds = sentencepieces.Encoder(model)(pa.array(["aa<s>", "", "zz a"]))
    assert (ids.tolist(), bounds.tolist()) == ([2, 3, 3, 5, 4, 6, 2, 0, 2, 3], [0, 6, 6, 10])


def test_slices(model):
    judge = sentencepiece.SentencePieceProcessor(model_proto=model)
    rows = [t for _ in range(40) for t in ODD[1:-2]] + [f"some näme {i} of  a täble" for i in range(900)]
    for at in (1, 300, 1000):
        part = pa.array(rows).slice(at, 400)
        ids, bounds = sentencepieces.Encoder(model)(part)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == judge.encode(part.to_pylist())


def test_few_segments_remembered(model):
    texts = pa.array(["a b c a", "", "d  e", "a b c a", "f g h i j k"])
    whole, small = sentencepieces.Encoder(model), sentencepieces.Encoder(model, most=3)
    for _ in range(2):
        for x, y in zip(whole(texts), small(texts), strict=True):
            assert x.tolist() == y.tolist()


def test_round_trip(spark, model):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    back = sentencepieces.decode(sentencepieces.encode(docs, model, verify=False), model, text="back")
    assert back.columns == ["doc_id", "text", "ids", "back"]
    assert all(r.back == r.text for r in back.collect() if r.text is not None)


def test_nulls_odd_texts_and_clashing_names(spark, model):
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate([*ODD, *ODD])], "doc_id long, text string, ids string, parity string")
    out = sentencepieces.encode(docs, model)
    assert out.columns == ["doc_id", "text", "ids", "parity", "_ids", "_parity", "decodes"]
    judge = sentencepiece.SentencePieceProcessor(model_proto=model)
    for r in out.collect():
        if r.text is None:
            assert r["_ids"] is None and r["_parity"] is None and r.decodes is None
        else:
            assert r["_ids"] == judge.encode(r.text) and r["_parity"] and r.decodes
    assert sentencepieces.encode(docs.filter("false"), model).count() == 0
