"""Language-model scoring: a gated recurrent network with a class-factored output, next to a unigram base.

The HEAD most frequent tokens have input rows of their own and share classes of MEMBERS tokens, within which the network
has learnt weights; every other token belongs to one of TAILS classes by its last letters, within which counts of the
whole training corpus decide. So the network's size is fixed while what it knows of words grows with the corpus.

Texts become ids once, two bytes a token in the shared folder; training and scoring read these. Training is truncated
backpropagation through WINDOW steps, the state carried from window to window. Tasks of about UNIT tokens start from the
same weights and their results are averaged by tokens, for `rounds` rounds; a training document belongs to exactly one
round, so that together they learn from every document once.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import bounded, stash

HEAD, MEMBERS, TAILS, UNITS = 1024, 32, 32, 32
WINDOW, LANES, ROUNDS, UNIT, RATE, SEED = 32, 128, 4, 2_000_000, 0.06, 42
#: Updates that a task makes at least of the tokens it holds, where there are few: it takes fewer lanes then.
UPDATES = 16
#: Pieces of the weights, which are averaged side by side.
PIECES = 16
#: Words whose counts every task knows, at most; those of rarer ones are joined.
KNOWN = 50_000
#: Tokens gathered before they are scored, and lanes they are scored in: many, as behind the other lanes' ends the longest
#: document goes on alone.
GATHER, SCORE_LANES = 4_000_000, 256
BOS, CLASSES = HEAD + TAILS, HEAD // MEMBERS + TAILS
END = ""  # no word is empty
PARAMS = ("wx", "u", "wc", "bc", "wi", "bi")


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(token, document, words): for each token of the texts its place in words and the text's number. Words are
    lower-cased in A-Z and split at ASCII white space; each text's last token is the end, the last of words."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))  # no cast before ascii_lower: of a slice it reads other bytes
    coded = parts.flatten().dictionary_encode()
    at, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[at] if len(words) else np.zeros(0, bool)
    at, doc = at[there], doc[there]
    token = np.full(len(at) + len(texts), len(words), np.int64)
    token[np.arange(len(at)) + doc] = at
    ends = np.bincount(doc, minlength=len(texts)) + 1
    return token, np.repeat(np.arange(len(texts)), ends), pa.concat_arrays([words, pa.array([END], pa.string())])


def tail(word: str) -> int:
    return zlib.crc32(word.encode()[-2:]) % TAILS


def tails(words: pa.Array) -> np.ndarray:
    """tail of each word; an ending's hash is taken once, however many words have it."""
    ends = pc.binary_slice(words.cast(pa.binary()), -2).dictionary_encode()
    return np.array([zlib.crc32(end) % TAILS for end in ends.dictionary.to_pylist()], np.int64)[ends.indices.to_numpy(zero_copy_only=False)]


def tail_column(word: Column) -> Column:
    octets, n = word.cast("binary"), F.octet_length(word)
    return (F.crc32(F.substring(octets, F.greatest(n - 1, F.lit(1)), F.lit(2))) % TAILS).cast("int")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows of docs (text); tasks add up before the shuffle, so frequent words move little."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, 1 << 13, 4 << 20):
            token, _, words = words_of(batch.column(0))
            n = np.bincount(token, minlength=len(words))
            yield pa.RecordBatch.from_arrays([words, pa.array(n)], names=["word", "n"]).filter(pa.array(n > 0))

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Lexicon:
    """What every task knows of the vocabulary: a bounded number of words, and one sum for each tail class."""

    words: list[str]
    ids: np.ndarray
    counts: np.ndarray
    tail_size: np.ndarray  # per tail class: sum of counts + 0.5 for each of its words and for the unseen one
    head_counts: np.ndarray
    total: int
    distinct: int

    @property
    def whole(self) -> float:
        """log10 of what the base divides by."""
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))


def lexicon(counts: DataFrame) -> Lexicon:
    """From the table (word, c). At most KNOWN words and a sum a class reach the driver, whatever the vocabulary's size:
    words are taken from the most frequent sixteenth of an octave down, as long as whole ones fit."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    step = F.floor(F.log2("c") * 16).cast("int")
    sizes = sorted(((r.s, r.n) for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)  # under 1,024 rows
    fits = np.cumsum([n for _, n in sizes]) <= KNOWN
    least = sizes[int(fits.sum()) - 1][0] if fits.any() else 1 << 20
    top = sorted(((-r.c, r.word) for r in counts.filter(step >= least).collect()))  # at most KNOWN rows
    head = top[:HEAD]
    tails = np.full(TAILS, 0.5)
    for of, n, v in counts.groupBy(tail_column(F.col("word")).alias("t")).agg(F.sum("c"), F.count(F.lit(1))).collect():
        tails[of] += n + 0.5 * v
    for c, w in head:
        tails[tail(w)] -= 0.5 - c
    head_counts = np.zeros(HEAD)
    head_counts[: len(head)] = [-c for c, _ in head]
    ids = np.array([i if i < HEAD else HEAD + tail(w) for i, (_, w) in enumerate(top)], np.int64)
    return Lexicon([w for _, w in top], ids, np.array([-c for c, _ in top], np.int64), tails, head_counts, total, distinct)


def start(lex: Lexicon, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights before training: small at random, with biases that make the network a unigram model."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    members = (lex.head_counts + 0.5 * (lex.head_counts > 0)).reshape(-1, MEMBERS)
    sizes = np.concatenate([members.sum(1), lex.tail_size])
    with np.errstate(divide="ignore"):
        bias = np.maximum(np.log(members), -30)  # places without a word stay next to impossible
        classes = np.maximum(np.log(np.maximum(sizes, 0)), -30)
    return {
        "wx": small(3, BOS + 1, UNITS), "u": small(3, UNITS, UNITS), "wc": small(UNITS, CLASSES), "bc": (classes - classes.max()).astype(np.float32),
        "wi": small(HEAD // MEMBERS, UNITS, MEMBERS), "bi": (bias - bias.max(1, keepdims=True)).astype(np.float32),
    }


def lanes_of(docs: list[np.ndarray], most: int) -> list[list[int]]:
    """Documents dealt to lanes, the longest first and each to the shortest lane; longest lanes first."""
    heap = [(0, k) for k in range(min(most, len(docs)))]
    lanes: list[list[int]] = [[] for _ in heap]
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        n, k = heapq.heappop(heap)
        lanes[k].append(i)
        heapq.heappush(heap, (n + len(docs[i]), k))
    return sorted(lanes, key=lambda x: -sum(len(docs[i]) for i in x))


def windows(docs: list[np.ndarray], most: int, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(inputs, targets, document) of `steps` steps and the lanes that still go on; target -1 behind a lane's end."""
    lanes = lanes_of(docs, most)
    order = [i for lane in lanes for i in lane]
    if not order:
        return
    sizes = np.array([len(docs[i]) for i in order])
    target = np.concatenate([docs[i] for i in order]).astype(np.int32)
    source = np.concatenate([[BOS], target[:-1]]).astype(np.int32)
    source[np.cumsum(sizes) - sizes] = BOS
    of = np.repeat(np.array(order, np.int32), sizes)
    long = np.array([sum(len(docs[i]) for i in lane) for lane in lanes])
    begin = np.cumsum(long) - long
    for at in range(0, int(long[0]), steps):
        n = int((long > at).sum())
        t = at + np.arange(min(steps, int(long[0]) - at))[:, None]
        inside = t < long[:n]
        place = begin[:n] + np.minimum(t, long[:n] - 1)
        yield np.where(inside, source[place], BOS), np.where(inside, target[place], -1), of[place]


def forward(p: dict, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
    """States of all steps, the last one, and what the way back needs. A document's first step starts from zero.

    Gates are half of 1 + tanh, which is 1 / (1 + exp(-2 a)). A token's rows of wx stand in for biases, too."""
    u, uc = -2 * p["u"][:2], p["u"][2]
    gates = (-2 * p["wx"][:2]).reshape(-1, h.shape[1]).take(np.stack([x, x + p["wx"].shape[1]]), axis=0)
    c = p["wx"][2].take(x, axis=0)
    states, before, reset = np.empty_like(c), np.empty_like(c), np.empty_like(c)
    new = x == BOS
    any_new = new.any(1).tolist()
    some, wide = np.empty_like(c[0]), np.empty_like(gates[:, 0])
    with np.errstate(over="ignore"):  # 1 / (1 + inf) is 0
        for t, (h0, own, kept, out) in enumerate(zip(before, c, reset, states, strict=True)):
            h0[:] = h
            if any_new[t]:
                h0[new[t]] = 0
            gate = gates[:, t]
            np.matmul(h0, u, out=wide)
            wide += gate
            np.exp(wide, out=wide)
            wide += 1
            np.reciprocal(wide, out=gate)
            np.multiply(gate[1], h0, out=kept)
            np.matmul(kept, uc, out=some)
            own += some
            np.tanh(own, out=own)
            np.subtract(own, h0, out=out)
            out *= gate[0]
            out += h0
            h = out
    return states, h, (gates, c, before, reset, new)


def backward(p: dict, memory: tuple, d_states: np.ndarray, x: np.ndarray, grads: dict) -> None:
    (z, r), c, before, reset, new = memory
    back_z, back_r, back_c = (w.T.copy() for w in p["u"])
    # what a step's gradient is multiplied by, and then that gradient itself
    stay, dr, dc = 1 - z, 1 - r, c * c
    dz = c - before
    for factor in (stay, z, np.asarray(2, z.dtype)):
        dz *= factor
    for factor in (r, before, np.asarray(2, z.dtype)):
        dr *= factor
    np.subtract(1, dc, out=dc)
    dc *= z
    d, d_reset, some = (np.zeros_like(c[0]) for _ in range(3))
    any_new = new.any(1).tolist()
    for t in range(len(x) - 1, -1, -1):
        d += d_states[t]
        of_z, of_r, of_c = dz[t], dr[t], dc[t]
        of_c *= d
        of_z *= d
        np.matmul(of_c, back_c, out=d_reset)
        of_r *= d_reset
        d *= stay[t]
        d_reset *= r[t]
        d += d_reset
        np.matmul(of_z, back_z, out=some)
        d += some
        np.matmul(of_r, back_r, out=some)
        d += some
        if any_new[t]:
            d[new[t]] = 0
    flat = lambda a: a.reshape(-1, a.shape[-1])
    grads["u"] = np.stack([flat(before).T @ flat(dz), flat(before).T @ flat(dr), flat(reset).T @ flat(dc)])
    at = x.reshape(-1)
    order = np.argsort(at.astype(np.uint16), kind="stable")
    ids = at[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    sums = row_sums(np.concatenate([flat(g).take(order, axis=0) for g in (dz, dr, dc)], axis=1), first)
    grads["wx"] = (ids[first], sums.reshape(len(first), 3, -1).swapaxes(0, 1))


def row_sums(a: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of a from each place in first to the next; two columns at once, as one complex number."""
    pairs = a.view(np.result_type(a.dtype, np.complex64))
    return np.add.reduceat(pairs, first).view(a.dtype)


def log_probs(p: dict, states: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """log P(class) and, for head tokens, + log P(token | class) of each row; with grads also the states' gradient."""
    classes = np.where(targets < HEAD, targets // MEMBERS, targets - HEAD + HEAD // MEMBERS)

    def softmax(q: np.ndarray, own: np.ndarray) -> np.ndarray:
        """q (outcomes x rows) becomes probabilities, with grads less 1 at each row's own outcome, whose log is returned."""
        rows = np.arange(len(own))
        if len(own) and not -60 < float(q.min()) <= float(q.max()) < 60:  # then exp can neither overflow nor leave a sum of 0
            q -= q.max(0)
        out = q[own, rows]
        np.exp(q, out=q)
        total = q.sum(0)
        if grads is not None:
            q /= total
            q[own, rows] -= 1
        return out - np.log(total)

    q = p["wc"].T @ states.T
    q += p["bc"][:, None]
    out, back = softmax(q, classes), None
    if grads is not None:
        grads["wc"], grads["bc"] = (q @ states).T, q.sum(1)
        grads["wi"], grads["bi"] = np.zeros_like(p["wi"]), np.zeros_like(p["bi"])
        back = q.T @ p["wc"].T
    # head tokens by class: each class has its own weights, all else is done for all of them at once
    order = np.argsort(classes.astype(np.uint8), kind="stable")
    ends = np.searchsorted(classes[order], np.arange(HEAD // MEMBERS + 1))
    order = order[: ends[-1]]
    if not len(order):
        return out, back
    s, q = states.take(order, axis=0), np.empty((MEMBERS, len(order)), states.dtype)
    parts = [(k, slice(ends[k], ends[k + 1])) for k in np.flatnonzero(ends[1:] > ends[:-1]).tolist()]
    for k, part in parts:
        np.matmul(p["wi"][k].T, s[part].T, out=q[:, part])
    q += p["bi"].T.take(classes[order], axis=1)
    out[order] += softmax(q, targets[order] % MEMBERS)
    if grads is not None:
        d = np.empty_like(s)
        for k, part in parts:
            own = q[:, part]
            grads["wi"][k], grads["bi"][k] = (own @ s[part]).T, own.sum(1)
            np.matmul(own.T, p["wi"][k].T, out=d[part])
        back[order] += d
    return out, back


class Trainer:
    """Adagrad over windows. Its state is the weights, and for each the sum of squared gradients."""

    def __init__(self, state: dict, rate: float = RATE) -> None:
        self.p, self.squares = ({k: v.copy() for k, v in part.items()} for part in (state["p"], state["squares"]))
        self.rate, self.tokens = rate, 0

    def step(self, grads: dict, n: int) -> None:
        for k, g in grads.items():
            at, g = ((slice(None), g[0]), g[1]) if k == "wx" else (slice(None), g)
            g = g / np.float32(n)
            np.clip(g, -1, 1, out=g)
            squares = g * g
            squares += self.squares[k][at]
            self.squares[k][at] = squares
            np.sqrt(squares, out=squares)
            g *= self.rate
            g /= squares
            self.p[k][at] -= g

    def learn(self, docs: list[np.ndarray]) -> None:
        lanes = max(1, min(LANES, sum(map(len, docs)) // (WINDOW * UPDATES)))
        h = np.zeros((0, UNITS), np.float32)
        for x, y, _ in windows(docs, lanes, WINDOW):
            h = h[: x.shape[1]] if len(h) else np.zeros((x.shape[1], UNITS), np.float32)
            there = y >= 0
            states, h, memory = forward(self.p, x, h)
            grads: dict = {}
            n = int(there.sum())
            if n == y.size:
                _, flat = log_probs(self.p, states.reshape(n, -1), y.reshape(-1), grads)
                flat = flat.reshape(states.shape)
            else:
                flat = np.zeros_like(states)
                _, flat[there] = log_probs(self.p, states[there], y[there], grads)
            backward(self.p, memory, flat, x, grads)
            self.step(grads, n)
            self.tokens += n


def score(p: dict, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each document's classes and head tokens, whole documents with one state."""
    out = np.zeros(len(docs))
    h = np.zeros((0, UNITS), np.float32)
    for x, y, owner in windows(docs, SCORE_LANES, WINDOW):
        h = h[: x.shape[1]] if len(h) else np.zeros((x.shape[1], UNITS), np.float32)
        there = y >= 0
        states, h, _ = forward(p, x, h)
        found, _ = log_probs(p, states[there], y[there])
        out += np.bincount(owner[there], found, minlength=len(docs))
    return out


def id_lists(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b.as_py(), np.uint16) for b in column]


def packed_state(state: dict) -> list[bytes]:
    flat = np.concatenate([state[part][k].reshape(-1) for part in ("p", "squares") for k in PARAMS]).astype(np.float32)
    return [x.tobytes() for x in np.array_split(flat, PIECES)]


def unpacked_state(pieces: list[bytes], like: dict) -> dict:
    flat = np.frombuffer(b"".join(pieces), np.float32)
    shapes = [like[part][k].shape for part in ("p", "squares") for k in PARAMS]
    found = [v.reshape(s) for s, v in zip(shapes, np.split(flat, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), strict=True)]
    return {"p": dict(zip(PARAMS, found, strict=False)), "squares": dict(zip(PARAMS, found[len(PARAMS) :], strict=True))}


def train(coded: DataFrame, lex: Lexicon, *, rounds: int = ROUNDS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights after all rounds, from coded (part, held_out, ids): round i learns from the training texts whose part is i
    modulo `rounds`. One set of weights reaches the driver each round: the average over the tasks, which Spark takes."""
    spark = coded.sparkSession
    p = start(lex, seed)
    state = {"p": p, "squares": {k: np.full_like(v, 1e-4) for k, v in p.items()}}
    tasks = max(1, round(lex.total / rounds / UNIT))
    for i in range(rounds):
        now = spark.sparkContext.broadcast(state)
        # files are read together until there are as many tasks as units: each starts anew and sends whole weights
        some = coded.filter((F.pmod("part", F.lit(rounds)) == i) & ~F.col("held_out")).select("ids").coalesce(tasks)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            trainer, held, n = Trainer(now.value), [], 0
            for batch in batches:
                for ids in id_lists(batch.column(0)):
                    held.append(ids)
                    n += len(ids)
                    if n > 2 * UNIT:
                        trainer.learn(held)
                        held, n = [], 0
            if held:
                trainer.learn(held)
            if trainer.tokens:
                pieces = packed_state({"p": trainer.p, "squares": trainer.squares})
                yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([float(trainer.tokens)] * PIECES), pa.array(pieces, pa.binary())], names=["i", "n", "x"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            tokens: Counter = Counter()
            for batch in batches:
                for piece, n, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    sums[piece] = sums.get(piece, 0) + n * np.frombuffer(x, np.float32).astype(np.float64)
                    tokens[piece] += n
            if sums:
                means = [(v / tokens[k]).astype(np.float32).tobytes() for k, v in sums.items()]
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(means, pa.binary())], names=["i", "x"])

        means = some.mapInArrow(run, "i int, n double, x binary").repartition("i").mapInArrow(add, "i int, x binary").collect()
        if means:
            state = unpacked_state([bytes(r.x) for r in sorted(means, key=lambda r: r.i)], state)
        now.unpersist()
    return state["p"]


def coded_texts(rows: DataFrame, lex: Lexicon) -> DataFrame:
    """rows (doc_id, text, held_out, part) with, instead of the text, ids (two bytes a token) and what doesn't depend on
    the network: n_tokens, n_known, the base and the tail words' log10 shares of their classes, both without the words
    that the lexicon lacks, which `rest` lists with their numbers."""
    shared = rows.sparkSession.sparkContext.broadcast(lex)
    kind = rows.schema["doc_id"].dataType.simpleString()
    rest_type = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        vocabulary = pa.array(lex.words, pa.string())
        key = TaskContext.get().partitionId() << 33
        for batch in bounded(batches, 1 << 13, 4 << 20):
            n = batch.num_rows
            token, doc, words = words_of(batch.column(1))
            at = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            known = at >= 0
            count = np.where(known, lex.counts[at] if len(lex.counts) else 0, -1)
            ids = np.where(known, lex.ids[at] if len(lex.ids) else 0, -1)
            ids[~known] = HEAD + tails(words.filter(pa.array(~known)))
            bits = np.where(known, np.log10(np.maximum(count, 0) + 0.5), 0.0)
            is_tail = ids >= HEAD
            share = np.where(is_tail, bits - np.log10(lex.tail_size)[np.where(is_tail, ids - HEAD, 0)], 0.0)
            base = np.where(known, bits - lex.whole, 0.0)
            sums = [np.bincount(doc, v[token], minlength=n) for v in ((count > 0).astype(float), base, share)]
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
            lacking = ~known[token]
            pairs, times = np.unique(doc[lacking] * len(words) + token[lacking], return_counts=True)
            of, word = np.divmod(pairs, len(words))
            rest = pa.StructArray.from_arrays([words.take(pa.array(word)), pa.array(times, pa.int64())], fields=list(rest_type.value_type))
            rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), rest)
            flat = ids[token].astype(np.uint16)
            packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(key, key + n)), batch.column(0), batch.column(2), batch.column(3), pa.array(np.diff(ends), pa.int64()), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), packed, rest],
                names=["key", "doc_id", "held_out", "part", "n_tokens", "n_known", "base", "share", "ids", "rest"],
            )
            key += n

    schema = f"key long, doc_id {kind}, held_out boolean, part int, n_tokens long, n_known long, base double, share double, ids binary, rest array<struct<word:string,n:bigint>>"
    return rows.select("doc_id", "text", "held_out", "part").mapInArrow(run, schema)


def scored(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of docs.

    Texts are whole; null counts as empty and has the end token alone; repeated rows are learnt from and scored each. A
    null id isn't held out. Without any training text all counts are 0 and scores are those of the unseen word. Other
    columns of docs, whatever their names, aren't read.
    """
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 16)).cast("int")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"), part.alias("part"))
    counts = stash(word_counts(rows.filter(~F.col("held_out"))), "counts")
    lex = lexicon(counts)
    coded = stash(coded_texts(rows, lex), "coded")
    shared = spark.sparkContext.broadcast(train(coded, lex, seed=seed, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            found = score(shared.value, id_lists(rows.column(rows.num_columns - 1))) / np.log(10)
            held.clear()
            return pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(found)], names=[*rows.schema.names[:-1], "model"])

        for batch in bounded(batches):
            held.append(batch)
            if sum(b.column(b.num_columns - 1).nbytes for b in held) > 2 * GATHER:
                yield flush()
        if sum(b.num_rows for b in held):
            yield flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    keep = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base", "share"]
    own = coded.select(*keep, "ids").mapInArrow(run, f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, share double, model double")
    rest = coded.select("key", F.explode("rest").alias("r")).select("key", "r.word", "r.n").join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    bits = F.log10(c + 0.5)
    rest = rest.groupBy("key").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * (bits - lex.whole)).alias("more_base"), F.sum(F.col("n") * bits).alias("more_share"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    return own.join(rest, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("known")).cast("long").alias("n_known"), F.lit(int(lex.total)).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base")).alias("base_score"), (F.col("model") + F.col("share") + zero("more_share")).alias("score"),
    )
