import hashlib
import math
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from cadenza.llm import linededup, quality, sentencepieces
from cadenza.llm.common import table
from tests.llm.test_mixing import levels

SF = "/root/testdata/sf0.001"


def drawn(docs, labels):
    """Ids that the quality draw keeps, by plain counting."""
    counts = [[quality.SMOOTH] * quality.BUCKETS for _ in range(2)]
    found = {i: quality.buckets(t).tolist() for i, t in docs.items()}
    for i, own in found.items():
        for b in own:
            counts[0][b] += 1
            counts[1][b] += labels.get(i) == 1
    totals = [sum(c) for c in counts]
    weight = {i: sum(math.log(counts[1][b] / totals[1]) - math.log(counts[0][b] / totals[0]) for b in own) * 16 / (len(own) + 16) for i, own in found.items()}
    known = sorted((weight[i], labels[i] == 1) for i in docs if i in labels)
    good = sum(g for _, g in known)
    best, cut = 0, -math.inf
    for n in range(1, len(known)):
        lost = sum(g for _, g in known[:n])
        if lost <= quality.MAY_LOSE * good and n - 2 * lost > best:
            best, cut = n - 2 * lost, (known[n - 1][0] + known[n][0]) / 2
    k = sum(w >= cut for w in weight.values())

    def key(i):
        u = (int(hashlib.md5(f"42:quality:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        return weight[i] - math.log(-math.log(u))

    return sorted(docs, key=lambda i: (-key(i), i))[:k]


def deduped(docs):
    """Texts without the lines that are aligned with any earlier document."""
    out = {}
    sides = {i: linededup.lines_of(t) for i, t in sorted(docs.items())}
    for i, b in sides.items():
        gone = {line for j, a in sides.items() if j < i for line in linededup.repeated(a, b)}
        out[i] = "\n".join(x for n, x in enumerate(docs[i].split("\n")) if n not in gone)
    return out


def firsts(docs):
    """The smallest id of each group that 5-word shingles at 0.8 connect."""
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    words = {i: t.translate(upper).encode().split() for i, t in docs.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} for i, w in words.items()}
    root = {i: i for i in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in docs:
        for j in docs:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i for i in docs if top(i) == i}


def test_whole_chain_against_brute_force(spark):
    rows = table(spark, SF, "documents").collect()
    docs, source = {r.doc_id: r.text for r in rows}, {r.doc_id: r.source for r in rows}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert len(docs) == len(rows)
    left = deduped({i: docs[i] for i in drawn(docs, labels)})
    kept = firsts(left)
    assert len(kept) < len(left) < len(docs) and any(left[i] != docs[i] for i in left)
    size = {i: len(left[i].encode().split()) for i in kept}
    sizes = Counter()
    for i in kept:
        sizes[source[i]] += size[i]
    target = levels(dict(sizes))
    got = corpus_pipeline.run(spark, SF).collect()
    times = Counter(r.doc_id for r in got)
    for i in kept:
        rate = target[source[i]] / sizes[source[i]]
        assert times[i] in (math.floor(rate + 1e-9), math.floor(rate) + 1)
    assert set(times) <= kept
    judge = sentencepiece.SentencePieceProcessor(model_proto=sentencepieces.model_bytes())
    for r in got:
        assert r.text == left[r.doc_id] and r.ids == judge.encode(r.text) and r.parity and r.decodes


def test_stages_return_documents(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


@pytest.mark.parametrize("rows", [[], [(1, "a good text of some words", "en", "s", 5, "x"), (1, "a good text of some words", "en", "s", 5, "x"), (2, None, None, None, None, None), (None, "no id", "en", "s", 1, ""), (3, "", "", "", 0, ""), (4, "long " * 30_000, "en", "t", 9, "y")]])
def test_nulls_repeats_and_clashing_names(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "_ids", "parity", "decodes"]
    # words of a source that is cut or taken again change how often a row comes, not what it says
    assert {(r.doc_id, r.text) for r in got.collect()} <= {(r[0], r[1]) for r in rows}
    assert not rows or got.count() > 0
