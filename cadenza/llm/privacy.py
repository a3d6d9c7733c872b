"""Personal data: patterns find protected entities, and what the corpus knows about them finds the terms that give them away.

An entity (an address or number, in one spelling) has the information content log(N / n(e)): n(e) of N documents hold it.
A term next to it tells log(joint N / (n(t) n(e))) of that, the pointwise mutual information: `joint` documents hold the
term within WINDOW terms of the entity, n(t) hold it anywhere. The share told is the disclosure, 1 where a term is never
found without the entity. Terms whose disclosure reaches REMOVE are removed from the entity's surroundings, those from
GENERALISE on are replaced by their kind. Terms next to an entity in fewer than LEAST_TEXTS different texts tell nothing
yet. Everything is counted over all documents, and grows with the text: an occurrence has 2 WINDOW neighbours at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import bounded, stash
from cadenza.llm.lexical import coded

WINDOW, LEAST_TEXTS = 20, 3
GENERALISE, REMOVE = 0.75, 0.9
#: Kinds of spans, in order; the first four are patterns.
KINDS = ["email", "ip", "card", "phone", "generalised", "removed"]
#: Bits of the filter that tells which terms are worth counting: 1 MB, whatever the corpus. More terms pass it by chance the
#: more it holds; what decides is the join behind it.
FILTER_BITS = 1 << 23

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
NOT_DIGIT = re.compile("[^0-9]+")

Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each @ belongs to the run of characters before it, as far as no match has used them."""
    low, at = 0, text.find("@")
    while at >= 0:
        start, domain = at, DOMAIN.match(text, at + 1)
        if domain:
            while start > low and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                low = domain.end()
        at = text.find("@", max(at + 1, low))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by kind and start; matches that fail their check are dropped."""
    found = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def entity(kind: int, written: str) -> str:
    """One spelling of an entity: lower case, numbers without what stands between their digits."""
    if kind == 1:
        return "ip:" + ".".join(str(int(p)) for p in written.split("."))
    return f"{KINDS[kind]}:{written.translate(LOWER) if kind == 0 else NOT_DIGIT.sub('', written)}"


def terms_after(text: str, at: int, n: int) -> list[tuple[int, int]]:
    """The first n terms from `at` on."""
    out = []
    for m in TERM.finditer(text, at):
        out.append(m.span())
        if len(out) == n:
            break
    return out


def terms_before(text: str, at: int, n: int) -> list[tuple[int, int]]:
    """The last n terms before `at`; it looks back as far as they take."""
    size = 32 * n
    while True:
        low = max(0, at - size)
        found = [m.span() for m in TERM.finditer(text, low, at)]
        if low and found and found[0][0] == low:  # may be a part of a term
            found = found[1:]
        if not low or len(found) >= n:
            return found[-n:]
        size *= 4


def neighbours(text: str, spans: list[Span], window: int = WINDOW) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms around each span that overlap no span."""
    taken = sorted((s, e) for _, s, e in spans)
    starts, ends = np.array([s for s, _ in taken]), np.maximum.accumulate([e for _, e in taken]) if taken else None
    out = []
    for kind, start, end in spans:
        name = entity(kind, text[start:end])
        for s, e in terms_before(text, start, window) + terms_after(text, end, window):
            k = int(np.searchsorted(starts, e))
            if k == 0 or ends[k - 1] <= s:
                out.append((name, text[s:e].translate(LOWER), s, e))
    return out


FOUND = "row long, text_key binary, base array<struct<kind:int,start:int,end:int>>, near array<struct<entity:string,term:string,start:int,end:int>>"


def found(docs: DataFrame, text_col: str, *, window: int = WINDOW) -> DataFrame:
    """docs with the columns of FOUND: a number of the row, a key of its text, its spans and the terms around them; written
    to the shared folder, which fixes the numbers."""
    kinds = [pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))]
    kinds += [pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in bounded(batches):
            base, near, keys = [], [], []
            for text in batch.column(batch.schema.names.index(text_col)).to_pylist():
                spans = base_spans(text) if text else []
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                near.append([dict(zip(("entity", "term", "start", "end"), x, strict=True)) for x in neighbours(text, spans, window)] if spans else [])
                keys.append(xxhash.xxh3_128_digest(text.encode()) if spans else None)
            rows = pa.array(range(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, rows, pa.array(keys, pa.binary()), pa.array(base, kinds[0]), pa.array(near, kinds[1])], names=[*batch.schema.names, "row", "text_key", "base", "near"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), FOUND])
    return docs.mapInArrow(run, schema)


def term_filter(terms: DataFrame) -> np.ndarray:
    """A bit for the hash of each term. What reaches the driver are FILTER_BITS bits at most."""
    at = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    words = terms.select(F.shiftright(at, 5).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(31)).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in words:
        out[r.w] = r.b
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def holders(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(term, n): how many rows of docs hold each of the given terms. Texts are read once, terms that pass the filter are
    counted batch by batch, and only the given ones are left."""
    shared = docs.sparkSession.sparkContext.broadcast(term_filter(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in bounded(batches, 1 << 12):
            doc, at, names = coded(batch.column(0))
            hashed = np.fromiter((xxhash.xxh64_intdigest(s.encode(), 42) for s in names), np.uint64, len(names)).view(np.int64)
            passes = bits[np.mod(hashed, FILTER_BITS)]
            some = passes[at] if len(at) else np.zeros(0, bool)
            term = np.unique(doc[some] * max(1, len(names)) + at[some]) % max(1, len(names))
            n = np.bincount(term, minlength=len(names))
            kept = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in kept], pa.string()), pa.array(n[kept], pa.int64())], names=["term", "n"])

    counted = docs.select(text_col).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counted.join(terms, "term", "left_semi")


def disclosures(docs: DataFrame, rows: DataFrame, text_col: str, *, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """(entity, term, joint, texts, n_entity, n_term, disclosure): what each term tells of each entity that it stands next to
    in `least_texts` different texts or more."""
    total = rows.count()
    near = rows.filter(F.size("near") > 0)
    pairs = near.select("text_key", F.explode(F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term"))))).alias("p"))
    each = pairs.groupBy("p.entity", "p.term", "text_key").agg(F.count(F.lit(1)).alias("n"))
    each = stash(each.groupBy("entity", "term").agg(F.sum("n").alias("joint"), F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= least_texts), "pairs")
    of_entity = near.select(F.explode(F.array_distinct(F.transform("near", lambda x: x["entity"]))).alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    of_term = holders(docs, text_col, stash(each.select("term").distinct(), "terms")).withColumnRenamed("n", "n_term")
    known = each.join(of_entity, "entity").join(of_term, "term")
    content = F.log(F.lit(float(total)) / F.col("n_entity"))
    told = F.log(F.col("joint") * F.lit(float(total)) / (F.col("n_term").cast("double") * F.col("n_entity")))
    return known.withColumn("disclosure", F.when(content > 0, told / content))


def with_spans(docs: DataFrame, keep: list[str], *, text_col: str = "text", window: int = WINDOW, least_texts: int = LEAST_TEXTS, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """The kept columns of every row of docs with base (the patterns' spans) and spans (all of them): arrays of (kind, start,
    end), kind by its place in KINDS, in order."""
    rows = found(docs.select(*dict.fromkeys([*keep, text_col])), text_col, window=window)
    rows = stash(rows if text_col in keep else rows.drop(text_col), "found")
    told = disclosures(docs, rows, text_col, least_texts=least_texts).filter(F.col("disclosure") >= generalise)
    told = stash(told.select("entity", "term", F.when(F.col("disclosure") >= remove, 5).otherwise(4).alias("kind")), "disclosures")
    near = rows.filter(F.size("near") > 0).select("row", F.explode("near").alias("x")).select("row", "x.*")
    more = near.join(told, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("kind").alias("kind"))
    more = more.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    names = [c for c in rows.columns if c not in ("row", "text_key", "near")]
    out = rows.select("row", *names).join(more, "row", "left")
    return out.select(*names, F.array_sort(F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:int,start:int,end:int>>")))).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of docs: numbers of base spans, the SHA-256 of
    their list and the list of all spans, each kind:start:end, by kind and start, in code points.

    Null and empty texts have no spans. Repeated rows, and rows with one id or none, are returned one by one and count as
    documents; of equal texts one counts as a different text. Other columns are left out; an empty table gives no rows."""
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = with_spans(given, ["id"], **options)
    counts = [F.size(F.array_remove(F.transform("base", lambda s: s["kind"] != k), F.lit(True))).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    return rows.select("id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def rewritten(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by its kind; where spans overlap, the earlier start (the earlier kind) wins. Of a
    generalised term what stays is whether it is a number, a name (upper case first) or a word; removed terms go."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["kind"])):
        if s["start"] < at:
            at = max(at, s["end"])
            continue
        was = text[s["start"] : s["end"]]
        label = {4: "[NUMBER]" if was.isdigit() else "[NAME]" if was[0].isupper() else "[WORD]", 5: "[REMOVED]"}.get(s["kind"], f"[{KINDS[s['kind']].upper()}]")
        out += [text[at : s["start"]], label]
        at = s["end"]
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """docs with their texts rewritten: entities and generalised terms replaced by their kind, removed terms by [REMOVED]. Null
    stays null; all other columns stay as they are, whatever their names."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    given = docs.toDF(*names.values())
    rows = with_spans(given, list(names.values()), text_col=names[text_col], **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            at = batch.schema.names.index(names[text_col])
            texts = [t and rewritten(t, s) for t, s in zip(batch.column(at).to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield batch.select(list(names.values())).set_column(at, names[text_col], pa.array(texts, pa.string()))

    return rows.select(*names.values(), "spans").mapInArrow(run, given.schema).toDF(*docs.columns)


__all__ = ["KINDS", "base_spans", "disclosures", "neighbours", "report", "rewritten", "sanitise", "with_spans"]
