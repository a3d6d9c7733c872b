import random

from cadenza.llm import linededup

SCHEMA = "doc_id long, text string, cut_id string, lines string"


def brute(rows, min_words):
    """Lines in a run of min_words words that an earlier document has too."""
    docs = sorted({(d, t) for d, t in rows if d is not None and t is not None})
    out = {}
    for n, (d, t) in enumerate(docs):
        lines = [x.strip() for x in t.split("\n")]
        gone = set()
        for e, u in docs[:n]:
            if e == d:
                continue
            other = [x.strip() for x in u.split("\n")]
            for i in range(len(lines)):
                for j in range(len(other)):
                    k = 0
                    while i + k < len(lines) and j + k < len(other) and lines[i + k] == other[j + k]:
                        k += 1
                    while k and not lines[i + k - 1]:
                        k -= 1
                    if k and lines[i] and sum(len(x.split()) for x in lines[i : i + k]) >= min_words:
                        gone |= set(range(i, i + k))
        out[d] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    line = lambda: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(50)) for _ in range(rng.choice([1, 3, 6, 12])))
    passages = [[line() for _ in range(rng.randint(1, 9))] for _ in range(12)]
    boiler = ["all rights reserved", "", "x"]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choice([*passages, [line() for _ in range(rng.randint(1, 5))], [rng.choice(boiler)]])
            lo = rng.randrange(len(p))
            parts += p[lo:] if rng.random() < 0.4 else p
        rows.append((d, "\n".join(parts)))
    got = linededup.dedup_lines(spark.createDataFrame([(d, t, "q", "r") for d, t in rows], SCHEMA))
    assert got.columns == ["doc_id", "text", "cut_id", "lines"]
    assert {r.doc_id: r.text for r in got.collect()} == brute(rows, 20)


def test_moved_and_repeated_blocks():
    p, q = [(i, 25) for i in (1, 2, 3)], [(i, 25) for i in (7, 8, 9)]
    side = lambda *parts: ([h for x in parts for h, _ in x], [w for x in parts for _, w in x])
    assert linededup.repeated(side(p, q), side(q, [(50, 9)], p)) == [0, 1, 2, 4, 5, 6]
    assert linededup.repeated(side(p, p), side(p, p, [(5, 30)], p)) == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert linededup.repeated(side([(1, 3)] * 500), side([(1, 3)] * 700)) == list(range(700))
    assert linededup.repeated(side([(1, 3), (2, 3)]), side([(1, 3), (2, 3)])) == []


def plain(a, b, min_words):
    """Patience diff of two texts over and over, without candidates, filters or extension: blocks of aligned lines."""
    x, y = ([t.strip() for t in u.split("\n")] for u in (a, b))
    gone = set()
    while True:
        left = [j for j in range(len(y)) if j not in gone]
        before = len(gone)
        for lo, hi in {(lo, hi) for lo in left for hi in left if lo <= hi and hi - lo + 1 == sum(lo <= k <= hi for k in left)}:
            piece = y[lo : hi + 1]
            for i in range(len(x) - len(piece) + 1):
                if x[i : i + len(piece)] == piece and sum(len(t.split()) for t in piece) >= min_words and piece[0] and piece[-1]:
                    gone |= set(range(lo, hi + 1))
        if len(gone) == before:
            return gone


def test_alignment_against_a_plain_one():
    rng = random.Random(11)
    for _ in range(150):
        pool = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.choice([4, 9, 21]))) for _ in range(12)] + [""]
        text = lambda: "\n".join(x for _ in range(3) for at in [rng.randrange(len(pool))] for x in pool[at : at + rng.randint(1, 6)])  # noqa: E731, B023
        a, b = text(), text()
        assert set(linededup.repeated(linededup.lines_of(a), linededup.lines_of(b))) == plain(a, b, 20)


def test_patience_is_a_common_subsequence_and_takes_unique_lines_first():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(14))] for _ in range(2))
        found = linededup.patience(a, b, lambda i, j: linededup.alike(a, b, i, j))  # noqa: B023
        assert all(a[i] == b[j] for i, j in found)
        assert all(p < r and q < s for (p, q), (r, s) in zip(found, found[1:], strict=False))
    assert linededup.patience([1, 2, 3, 4], [3, 9, 1, 2, 4], lambda i, j: 0) == [(0, 2), (1, 3), (3, 4)]


def test_only_what_is_aligned_goes(spark, monkeypatch):
    """A line between two aligned ones goes with their block; without an alignment nothing goes."""
    lines = [" ".join(f"{w}{i}" for i in range(25)) for w in "abc"]
    rows = [(1, "\n".join([lines[0], "", lines[1]]), "", ""), (2, "\n".join(["own", lines[0], "", lines[1]]), "", ""), (3, "\n".join([lines[1], "", lines[0]]), "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()} == {1: rows[0][1], 2: "own", 3: ""}
    monkeypatch.setattr(linededup, "patience", lambda *_: [])
    assert linededup.repeated(linededup.lines_of(rows[0][1]), linededup.lines_of(rows[1][1])) == []


def test_nulls_repeats_long_and_empty(spark):
    long = "\n".join(f"line {i} of a long text with some words" for i in range(20_000))
    rows = [(1, long, "", ""), (2, long + "\nand a tail", "", ""), (3, None, None, None), (3, "", "", ""), (None, long, "", ""), (4, "w " * 30, "", ""), (4, "w " * 30, "", "")]
    got = [(r.doc_id, r.text) for r in linededup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = [(1, long), (2, "and a tail"), (3, None), (3, ""), (None, long), (4, "w " * 30), (4, "w " * 30)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert linededup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_few_lines_that_repeat():
    """Where lines repeat over and over nothing is overlooked either."""
    rng = random.Random(5)
    for n in range(1500):
        pool = [" ".join(f"w{k}_{i}" for i in range(rng.choice([3, 5, 7, 11]))) for k in range(rng.choice([2, 3, 4]))] + ["", "z"]
        a, b = ("\n".join(rng.choices(pool, k=rng.randint(4, 26))) for _ in range(2))
        gone = set(linededup.repeated(linededup.lines_of(a), linededup.lines_of(b), 20))
        want = brute([(1, a), (2, b)], 20)[2]
        assert "\n".join(x for i, x in enumerate(b.split("\n")) if i not in gone) == want, n
