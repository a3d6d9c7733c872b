import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cadenza.llm import lm

SCHEMA = "doc_id long, text string, key int, score int"


def texts():
    rng = np.random.default_rng(5)
    a, b = [f"alpha{i}" for i in range(40)], [f"BETA{i}x" for i in range(40)]
    out = [(i, " ".join(rng.choice((a, b)[i % 2], 30)), 0, 0) for i in range(300)]
    return out + [(300, None, 0, 0), (301, "", 0, 0), (None, "alpha1 never", 0, 0), (302, "x " * 30_000, 0, 0), (7, "alpha1", 0, 0), (7, "alpha1", 0, 0)]


@pytest.mark.parametrize("known", [50_000, 20])
def test_counts_and_base(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    rows = texts()
    words = [[*(t or "").encode().lower().split(), b""] for _, t, *_ in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows]
    c = Counter(w for ws, o in zip(words, out, strict=True) if not o for w in ws)
    n, v = sum(c.values()), len(c)
    got = lm.scored(spark.createDataFrame(rows, SCHEMA)).collect()
    want = sorted((str(r[0]), o, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for r, ws, o in zip(rows, words, out, strict=True))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_words_of_slices():
    rng = np.random.default_rng(2)
    odd = [None, "", " ", "Ünï Çode É\u00a0x\u0085Y", "\x0b a\x0cB\r\nc\x1cd ", "ZZ " * 500]
    rows = [odd[i % 7] if i % 7 < 6 else " ".join(f"W{n}" for n in rng.integers(0, 50, 40)) for i in range(2000)]
    whole = pa.array(rows, pa.string())
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for at in (0, 1, 700, 1999):
        token, doc, words = lm.words_of(whole.slice(at, 600))
        names = np.array([*words.to_pylist()], object)
        for k, t in enumerate(rows[at : at + 600]):
            assert names[token[doc == k]].tolist() == [*(w.decode() for w in (t or "").translate(upper).encode().split()), ""]


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    got = lm.scored(spark.createDataFrame(texts()[:300], SCHEMA)).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_every_training_document_is_learnt_from(spark, monkeypatch):
    """The rounds' tasks see each training text once and no held-out one."""
    rows = [(i, f"own{i} and more", 0, 0) for i in range(200)] + [(3, "own3 and more", 0, 0), (None, "own-1 and more", 0, 0)]
    seen = []
    frame = type(spark.range(1))
    real = frame.coalesce

    def noted(self, n):
        if self.columns == ["ids"]:
            seen.extend(bytes(r.ids) for r in self.collect())
        return real(self, n)

    monkeypatch.setattr(frame, "coalesce", noted)
    got = lm.scored(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(seen) == sum(not r.held_out for r in got) and len(got) == 202
    assert all(len(x) == 2 * 4 for x in seen)


def plain_score(p, lex, counts, words):
    """log10 probability of a text, step by step and word by word."""
    f = {k: v.astype(float) for k, v in p.items()}
    known = {w: int(i) for w, i in zip(lex.words, lex.ids, strict=True)}
    h, before, out = np.zeros(lm.UNITS), lm.BOS, 0.0
    gate = lambda k, s: f["wx"][k][before] + s @ f["u"][k]
    for w in words:
        z, r = (0.5 * (1 + np.tanh(gate(k, h))) for k in (0, 1))
        h = h + z * (np.tanh(gate(2, r * h)) - h)
        i = known.get(w, lm.HEAD + lm.tail(w))
        q = np.exp(h @ f["wc"] + f["bc"])
        of = i // lm.MEMBERS if i < lm.HEAD else i - lm.HEAD + lm.HEAD // lm.MEMBERS
        out += math.log10(q[of] / q.sum())
        if i < lm.HEAD:
            q = np.exp(h @ f["wi"][of] + f["bi"][of])
            out += math.log10(q[i % lm.MEMBERS] / q.sum())
        else:
            out += math.log10((counts[w] + 0.5) / lex.tail_size[i - lm.HEAD])
        before = i
    return out


def test_score_against_a_plain_version(spark, monkeypatch):
    for name, value in (("HEAD", 64), ("BOS", 64 + 32), ("CLASSES", 2 + 32)):  # so that there are tail words
        monkeypatch.setattr(lm, name, value)
    docs = pa.array([t for _, t, *_ in texts()], pa.string())
    token, doc, words = lm.words_of(docs)
    names = words.to_pylist()
    c = Counter(names[t] for t in token)
    lex = lexicon_of(spark, c)
    p = lm.start(lex)
    known = {w: int(i) for w, i in zip(lex.words, lex.ids, strict=True)}
    ids = np.array([known.get(names[t], lm.HEAD + lm.tail(names[t])) for t in token], np.uint16)
    lists = [ids[doc == k] for k in range(len(docs))]
    trainer = lm.Trainer({"p": p, "squares": {k: np.full_like(v, 1e-4) for k, v in p.items()}})
    trainer.learn(lists)
    network = lm.score(trainer.p, lists) / math.log(10)
    for k in [0, 1, 2, 150, 300, 301, 302, 304]:
        own = [names[t] for t in token[doc == k]]
        tails = sum(math.log10((c[w] + 0.5) / lex.tail_size[lm.tail(w)]) for w in own if known.get(w, lm.HEAD) >= lm.HEAD)
        assert network[k] + tails == pytest.approx(plain_score(trainer.p, lex, c, own), rel=1e-4, abs=1e-3)


def lexicon_of(spark, counts):
    return lm.lexicon(spark.createDataFrame(list(counts.items()), "word string, c long"))


def test_probabilities_sum_to_one(spark):
    """Over the head's words, the tail's words and one unseen word in each tail class."""
    c = Counter({f"w{i}": 1 + 5000 // (i + 1) for i in range(3000)})
    lex = lexicon_of(spark, c)
    p = lm.start(lex)
    head = [w for w, i in zip(lex.words, lex.ids, strict=True) if i < lm.HEAD]
    assert len(head) == lm.HEAD
    states = np.repeat(np.random.default_rng(0).normal(size=(1, lm.UNITS)), lm.HEAD + lm.TAILS, 0).astype(np.float32)
    network = np.exp(lm.log_probs(p, states, np.arange(lm.HEAD + lm.TAILS))[0].astype(float))
    shares = np.full(lm.TAILS, 0.5)
    for w in c.keys() - set(head):
        shares[lm.tail(w)] += c[w] + 0.5
    assert np.allclose(shares, lex.tail_size)
    assert network[: lm.HEAD].sum() + (network[lm.HEAD :] * shares / lex.tail_size).sum() == pytest.approx(1, abs=1e-4)


def test_gradients():
    counts = np.zeros(1024)
    counts[:100] = 5
    lex = lm.Lexicon([], np.zeros(0, int), np.zeros(0, int), np.full(32, 3.0), counts, 500, 100)
    p = {k: v.astype(np.float64) for k, v in lm.start(lex).items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 100, (6, 3)), rng.integers(0, 100, (6, 3))
    x[0], x[3, 1], y[2, 2] = lm.BOS, lm.BOS, 1030

    def loss():
        s, _, memory = lm.forward(p, x, np.zeros((3, lm.UNITS)))
        return s, memory, -lm.log_probs(p, s.reshape(-1, lm.UNITS), y.reshape(-1))[0].sum()

    s, memory, _ = loss()
    grads = {}
    _, back = lm.log_probs(p, s.reshape(-1, lm.UNITS), y.reshape(-1), grads)
    lm.backward(p, memory, back.reshape(s.shape), x, grads)
    ids, rows = grads["wx"]
    grads["wx"] = np.zeros_like(p["wx"])
    grads["wx"][:, ids] = rows
    for name, at in (("u", (0, 3, 7)), ("u", (1, 3, 7)), ("u", (2, 2, 5)), ("wc", (1, 2)), ("wi", (0, 4, 3)), ("bi", (1, 2)), ("wx", (0, lm.BOS, 3)), ("wx", (1, x[1, 0], 2)), ("wx", (2, x[2, 1], 9))):
        old, eps = p[name][at], 1e-4
        p[name][at] = old + eps
        up = loss()[2]
        p[name][at] = old - eps
        down = loss()[2]
        p[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-6, rel=1e-4)


def test_state_is_carried_across_windows():
    lex = lm.Lexicon([], np.zeros(0, int), np.zeros(0, int), np.full(32, 3.0), np.full(1024, 5.0), 5120, 1024)
    p = lm.start(lex)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 1056, n).astype(np.uint16) for n in (100, 3, 1, 70, 33)]
    together = lm.score(p, docs)
    assert np.allclose(together, [lm.score(p, [d])[0] for d in docs], atol=1e-3)
    x = np.concatenate([[lm.BOS], docs[0][:-1]])[:, None]
    states, _, _ = lm.forward(p, x, np.zeros((1, lm.UNITS), np.float32))
    assert together[0] == pytest.approx(lm.log_probs(p, states[:, 0], docs[0].astype(int))[0].sum(), abs=1e-2)


def test_empty_table(spark):
    assert lm.scored(spark.createDataFrame([], SCHEMA)).count() == 0


def test_an_endings_hash_is_taken_once(monkeypatch):
    words = [f"w{i}{e}" for e in ("ab", "é", "\U0001f600") for i in range(2000)] + ["x", "é", ""]
    want = [lm.tail(w) for w in words]
    calls, real = [], zlib.crc32
    monkeypatch.setattr(lm.zlib, "crc32", lambda b: calls.append(b) or real(b))
    assert lm.tails(pa.array([*words, "cut off"], pa.string()).slice(1, len(words) - 1)).tolist() == want[1:]
    assert lm.tails(pa.array([], pa.string())).tolist() == []
    assert len(calls) == len({w.encode()[-2:] for w in words})


@pytest.mark.parametrize("learn", [False, True])
def test_head_classes_share_one_softmax(monkeypatch, learn):
    """However many classes the head tokens are of, exp is called for all at once; before, once a class."""
    lex = lm.Lexicon([], np.zeros(0, int), np.zeros(0, int), np.full(32, 3.0), np.full(1024, 5.0), 5120, 1024)
    p, rng = lm.start(lex), np.random.default_rng(3)
    states = rng.normal(size=(500, lm.UNITS)).astype(np.float32)
    p["wi"] = rng.normal(size=p["wi"].shape).astype(np.float32)
    targets = rng.integers(0, lm.HEAD + lm.TAILS, 500)
    one_by_one = [lm.log_probs(p, states[i : i + 1], targets[i : i + 1])[0][0] for i in range(500)]
    calls, real = [], np.exp
    monkeypatch.setattr(np, "exp", lambda *a, **k: calls.append(1) or real(*a, **k))
    found, back = lm.log_probs(p, states, targets, {} if learn else None)
    assert len(calls) == 2 and (back is not None) == learn
    assert np.allclose(found, one_by_one, atol=1e-4)


def test_gates_far_from_zero_are_whole():
    """Gates that exp can't reach the end of are 0 or 1, without a warning."""
    lex = lm.Lexicon([], np.zeros(0, int), np.zeros(0, int), np.full(32, 3.0), np.full(1024, 5.0), 5120, 1024)
    p = lm.start(lex)
    p["wx"][0], p["wx"][1] = -1000, 1000
    x = np.random.default_rng(4).integers(0, lm.HEAD, (5, 3))
    with np.errstate(all="raise", under="ignore"):
        states, last, _ = lm.forward(p, x, np.full((3, lm.UNITS), 0.5, np.float32))
    assert (states == 0.5).all() and (last == 0.5).all()
