import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cadenza.llm import alignment, queries
from cadenza.llm.common import table

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "\n", "a", " lead", "trail ", "two  spaces   three", "tab\t here \n  indented\n\n x", "don't we're  'S 12345 £€", "nul \u0000 x", "nbsp x   wide",
    "▁mark", "a ▁ b", "emoji 🏳️‍🌈 日本語 テキスト é", "<|endoftext|> <s> </s> <unk> <0x41>", "x\x1c y \x85 z", "ﬁ ½ " * 50, "word " * 30_000, "q" * 3_000, "\r\n \r\n",
]


def char_bytes():
    """The usual table of byte-level vocabularies, built the usual way."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, n = list(own), 0
    for b in range(256):
        if b not in own:
            own.append(b)
            chars.append(256 + n)
            n += 1
    return {chr(c): b for c, b in zip(chars, own, strict=True)}


def brute(texts):
    """Whole texts, byte ranges of all tokens, all pairs of ranges."""
    a = Tokenizer.from_file(alignment.TOKENIZER_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_PATH)
    code, out = char_bytes(), []
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    for text in texts:
        if not text:
            out.append(None)
            continue
        x = [(i, bytes(code[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
            out.append(None)
            continue
        spans, at = [], 0
        for side in (x, y):
            own, at = [], 0
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, p = [], [0, 0]
        for end in common:
            parts = ["", ""]
            for k, side in enumerate(spans):
                q = next((n for n in range(p[k], len(side)) if side[n][2] > end), len(side))
                parts[k], p[k] = ",".join(str(i) for i, *_ in side[p[k] : q]), q
            groups.append("|".join(parts))
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        out.append((len(x), len(y), len(common), links, ";".join(groups)))
    counts = Counter(p for f in out if f for p in set(f[3]))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    rows = []
    for f in out:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            rows.append((*f[:3], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), hashlib.sha256(f[4].encode()).hexdigest()))
    return rows


def test_groups_and_links_by_hand():
    a, b = np.array([2, 5, 6]), np.array([4, 6])
    assert [x.tolist() for x in alignment.common_ends(a, b)] == [[6], [3], [2]]
    assert [x.tolist() for x in alignment.links_of(a, b)] == [[2, 4, 5, 6], [0, 1, 1, 2], [0, 0, 1, 1]]
    a, b = np.array([2, 4]), np.array([2, 3, 4])
    assert [x.tolist() for x in alignment.common_ends(a, b)] == [[2, 4], [1, 2], [1, 3]]
    assert alignment.written(pa.array(["1", "2"]), pa.array(["7", "8", "9"]), np.array([1, 1]), np.array([1, 2]), np.array([2])).to_pylist() == ["1|7;2|8,9"]


def test_units_with_lost_bytes():
    one = alignment.Aligner(alignment.tokenizer_json(), alignment.model_bytes())
    words = [f"w{i}" for i in range(700)] + ["a▁b", " ", "x"]
    at = one.places(words)
    sizes = one.sizes[at]
    assert (sizes[-3] == -1).all() and (np.delete(sizes, -3, 0) > 0).all()
    assert one.places(words[::-1]).tolist() == one.places(words).tolist()[::-1]


@pytest.mark.parametrize("block", [(1 << 13, 8 << 20), (7, 4_000)])
def test_query_against_whole_texts(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", block[0])
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block[1])
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(1, "a", "x", 1), (None, "don't we", None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, n_a int").unionByName(table(spark, SF, "documents").selectExpr("doc_id + 1000 AS doc_id", "text", "'' AS block", "0 AS n_a")).repartition(3)
    model, tokenizer = alignment.model_bytes(), alignment.tokenizer_json()
    got = alignment.summaries(docs, tokenizer, model).collect()
    given = docs.collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *w) for r, w in zip(given, brute([r.text for r in given]), strict=True))


def test_registered_query_is_whole(spark):
    got = queries.QUERIES["op13_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    docs = table(spark, SF, "documents").collect()
    want = {r.doc_id: w for r, w in zip(docs, brute([r.text for r in docs]), strict=True)}
    for r in got.collect():
        assert tuple(r)[1:] == want[r.doc_id]


def test_groups_of_rows_and_empty_table(spark):
    model, tokenizer = alignment.model_bytes(), alignment.tokenizer_json()
    docs = spark.createDataFrame([(1, "Hello  world", "g"), (2, None, None), (3, "▁", None)], "doc_id long, text string, groups string")
    got = {r.doc_id: r for r in alignment.aligned(docs, tokenizer, model).collect()}
    assert [i for g in got[1]._groups for i in g.b] == sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_PATH).encode("Hello  world") and got[1].groups == "g" and got[2]._groups is None and got[3]._groups is None
    assert alignment.summaries(docs.limit(0), tokenizer, model).count() == 0
