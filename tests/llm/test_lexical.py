import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cadenza.llm import lexical, queries
from cadenza.llm.common import table
from tests.oracle import compared

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    """Every query against every document, in Python's own whole numbers."""
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in tfs), sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = Counter()
    for item in {i for i, _ in items}:
        wanted = {t for i, x in items if i == item for t in terms(x)}
        scores = []
        for i, c in tfs:
            m = 50 + (50 * c.total() * n) // total if total else 50
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for rank, (s, null, i) in enumerate(sorted(scores)[:k], 1):
            out[(item, rank, None if null else i, -s)] += 1
    return out


def test_terms():
    odd = ["It's  A-B_c 42.5", "", None, "É é ÀB", "日本 x y \u0085z", "\u0000a\u007fb", "  "]
    column = pa.array(["skipped", *odd, "skipped"]).slice(1, len(odd))
    doc, term, tf, names = lexical.counted(column)
    got = [Counter() for _ in odd]
    for d, t, n in zip(doc, term, tf, strict=True):
        got[d][names[t]] += int(n)
    assert got == [Counter(terms(t)) for t in odd]


def test_bounds_are_never_below_scores():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "b", f"w{rng.randrange(3000)}"]) for _ in range(rng.choice([1, 20, 3000]))) for _ in range(60)] + ["a " * 400 + "b"]
    doc, term, tf, names = lexical.counted(pa.array(texts))
    of = [np.array(sorted(rng.sample(range(len(names)), 12))) for _ in range(8)]
    q = lexical.Queries(list(range(8)), {t: i for i, t in enumerate(names)}, np.arange(len(names)) % 900, of, 61, 60_000)
    sketches, n, most = [], np.bincount(doc, tf).astype(np.int64), np.zeros(61, np.int64)
    np.maximum.at(most, doc, tf)
    for d in range(61):
        own = doc == d
        width = int(lexical.widths(np.array([own.sum()]))[0])
        flat = np.zeros((2, width), np.uint8)
        for row in range(2):
            np.maximum.at(flat[row], lexical.spots(lexical.hashes(names)[term[own]], row, width), np.minimum(tf[own], 255).astype(np.uint8))
        sketches.append(flat.tobytes())
    bound = q.bounds(sketches, n, most)
    exact = q.frequencies(pa.array(texts))
    impact = q.weights * q.impacts(exact, q.norms(n)[:, None])
    scores = np.stack([impact[:, t].sum(axis=1) for t in of], axis=1)
    assert (bound >= scores).all() and (bound == scores).mean() > 0.3 and exact.max() > 255


@pytest.mark.parametrize(("k", "pairs"), [(5, 40), (50, 200_000)])
def test_search_against_all_pairs(spark, k, pairs):
    rng = random.Random(k)
    vocab = [f"w{int(300 * rng.random() ** 3)}" for _ in range(2000)]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 30, 200, 2000]))), "x", 0) for i in range(150)]
    docs += [(1000 + i, docs[7][1], None, None) for i in range(70)] + [docs[8]] * 3 + [(None, "w1 w2 w3", "x", 1), (500, None, None, None), (501, "?!", "", 2), (502, "W1 É " * 40_000, "", 2)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 5, 40])))) for i in range(12)] + [(3, "more w5 words"), (77, None), (78, "nowhere"), (None, "w1 w9")]
    given = spark.createDataFrame(docs, "doc_id long, text string, sketch string, n int").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, lexical.search(lexical.index(given), asked, k=k, pairs=pairs).collect()))
    assert got == brute([(d[0], d[1]) for d in docs], items, k)


def test_registered_query_is_whole_and_equals_sql(spark):
    got = queries.QUERIES["op12_lexical"](spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    docs, items = (table(spark, SF, t).collect() for t in ("documents", "benchmark"))
    rows = Counter(map(tuple, got.collect()))
    assert rows == brute([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items], 50)
    mine, theirs = compared(spark, queries.QUERIES["op12_lexical"], queries.ORACLES["op12_lexical"], SF)
    assert mine == theirs and len(mine) == rows.total()


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.index(docs.limit(0)), asked).count() == 0
    assert lexical.search(lexical.index(docs), asked.limit(0)).count() == 0
    assert lexical.search(lexical.index(docs), asked).collect()[0].score > 0
