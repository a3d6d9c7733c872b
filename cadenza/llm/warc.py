"""WARC archives: written by Spark's text writer, one record a row, and read back as splits of any size.

Reading cuts the bytes at each place where a record could begin. Every such place is a candidate with the offset of its
successor, taken from its header; pointer jumping from the start of each file finds the candidates that a chain of
successors reaches. A magic string inside a payload isn't reached, and is joined back to the payload that has it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import bounded, shared_path, stash

MAGIC = "WARC/1.1\r\n"
BREAK = "\r\n\r\n"
#: Records of one archive file at most, so that no file outgrows what archives usually have.
RECORDS = 20_000
BASE16, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits at a time make four of the 32."""
    digest = F.sha1(payload)
    return F.translate(F.concat(*(F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8))), BASE16, BASE32)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def records(pages: DataFrame, *, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(record string): a response for each page (page_id, url, html), or a revisit where a smaller page_id has the
    same payload of min_bytes bytes or more. Null html is an empty payload; a null url leaves out the target; rows
    repeated with one page_id and payload are responses alike; a null page_id is larger than any other. A
    payload is one row's value, so at most 2 GB long; other columns, whatever their names, are left out."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html").cast("long"))
    first = rows.groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter(f"n > 1 AND bytes >= {int(min_bytes)}").select("digest", "first")
    rows = rows.join(first.hint("merge"), "digest", "left")
    later = F.col("first").isNotNull() & F.coalesce(F.col("page_id") > F.col("first"), F.lit(True))
    url = F.regexp_replace(F.col("url"), r"[\r\n]+", "%0A")
    head = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(later, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), record_id(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {date}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(later, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), record_id(F.col("first")))).otherwise(""),
        F.lit("\r\nContent-Length: "), F.when(later, F.lit(0)).otherwise(F.col("bytes")).cast("string"), F.lit(BREAK),
    )
    return rows.select(F.concat(head, F.when(later, "").otherwise(F.col("html"))).alias("record"))


def write(pages: DataFrame, path: str, *, compression: str | None = "gzip", **options) -> None:
    """Archive files under path. Each record ends in the blank lines that the writer puts behind a row."""
    writer = records(pages, **options).write.option("lineSep", BREAK).option("maxRecordsPerFile", RECORDS)
    (writer.option("compression", compression) if compression else writer).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, within, body): the bytes behind each magic string, and where they begin in the bytes of their split.
    Nothing is shuffled: a split's rows come in order, so their lengths are added up as they pass."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:  # files are split alike however often they are read
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    raw = spark.read.option("lineSep", MAGIC).text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for batch in bounded(batches):
            within = []
            for file, split, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.binary_length(batch.column(2)).to_pylist(), strict=True):
                if now != (file, split):
                    now, at = (file, split), 0
                within.append(at)
                at += n + len(MAGIC)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(within, pa.int64()), batch.column(2)], names=["file", "split", "within", "body"])

    return raw.mapInArrow(run, "file string, split long, within long, body binary")


def header(body: Column) -> Column:
    """The header as text: what comes before the first empty line."""
    return F.substring_index(body.cast("string"), BREAK, 1)


def named(head: Column, name: str) -> Column:
    found = F.regexp_extract(F.concat(F.lit("\n"), head, F.lit("\r\n")), rf"(?i)\n{name}:[ \t]*([^\r\n]*)\r", 1)
    return F.when(found != "", found)


def reachable(steps: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(file, at) of the candidates (file, at, next) that a chain of successors reaches from offset 0. A round doubles
    the hops that the pointers span, so a file of n records takes about log2(n) rounds."""
    jumps = stash(steps.select("file", "at", "next"), "jumps")
    found = jumps.filter("at = 0").select("file", "at")
    for _ in range(max_rounds):
        ahead = found.join(jumps.hint("merge"), ["file", "at"]).select("file", F.col("next").alias("at"))
        found = stash(found.union(ahead).distinct(), "found")
        hop = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jumps = stash(jumps.join(hop.hint("merge"), ["file", "next"]).select("file", "at", F.col("after").alias("next")), "jumps")
        if jumps.isEmpty():
            return found.join(steps.select("file", "at").hint("merge"), ["file", "at"], "left_semi")
    raise RuntimeError("a chain of records is too long")


def parsed(df: DataFrame, derive: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """df with what its column body says as a record; the derived columns are null if the payload goes beyond the body."""
    head = header(F.col("body"))
    df = df.withColumn("head", head).withColumn("head_bytes", F.octet_length("head").cast("long") + len(BREAK)).withColumn("length", named(F.col("head"), "Content-Length").try_cast("long"))
    whole = F.col("head_bytes") + F.col("length") <= F.octet_length("body")
    payload = F.when(whole, F.substring(F.col("body"), (F.col("head_bytes") + 1).cast("int"), F.col("length").cast("int")))
    names = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
    df = df.withColumns({c: named(F.col("head"), n) for c, n in names.items()} | {"whole": whole, "span": F.octet_length("body").cast("long")})
    df = df.withColumn("payload_digest", F.regexp_replace("payload_digest", "^sha1:", ""))
    return df.withColumns({c: f(payload) for c, f in derive.items()}).drop("head", "body")


def read(spark: SparkSession, path: str, derive: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """(file, offset, record_type, record_id, target_uri, payload_digest, refers_to, payload binary) per record.

    derive: columns made of the payload instead of it, so that payloads stay where they are read. A chain ends where a
    record is cut short or its length is wrong; records before that are kept. Files that don't begin with a record give
    none. Only payloads with a magic string inside are read again and joined.
    """
    derive = derive or {"payload": lambda p: p}
    out = ["record_type", "record_id", "target_uri", "payload_digest", "refers_to", *derive]
    found = stash(parsed(pieces(spark, path), derive), "candidates")
    splits = found.groupBy("file", "split").agg(F.sum(F.col("span") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = stash(splits.select("file", "split", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")), "splits")
    at = F.col("start") + F.col("within") - len(MAGIC)
    light = found.select("file", "split", "within", "head_bytes", "length", "whole").join(splits, ["file", "split"]).withColumn("at", at).filter("at >= 0")
    light = stash(light.withColumn("next", F.col("at") + len(MAGIC) + F.col("head_bytes") + F.col("length") + len(BREAK)), "offsets")
    kept = reachable(light.filter("next IS NOT NULL")).withColumn("real", F.lit(True))
    order = Window.partitionBy("file").orderBy("at")
    places = light.join(kept.hint("merge"), ["file", "at"], "left")
    places = places.withColumn("owner", F.last(F.when(F.col("real"), F.struct("at", "whole")), ignorenulls=True).over(order))
    places = stash(places.filter("owner IS NOT NULL AND (real OR NOT owner.whole)").select("file", "split", "within", "at", "real", "owner"), "places")
    key = ["file", "split", "within"]
    single = found.join(places.filter("real AND owner.whole").select(*key, F.col("at").alias("offset")).hint("merge"), key).select("file", "offset", *out)
    needed = stash(places.filter("NOT owner.whole").select(*key, "at", F.col("owner.at").alias("offset")), "needed")
    parts = pieces(spark, path).join(needed, key).groupBy("file", "offset").agg(F.array_sort(F.collect_list(F.struct("at", "body"))).alias("parts"))  # the pieces of one record
    joined = F.aggregate(F.slice("parts", 2, F.size("parts")), F.col("parts")[0]["body"], lambda a, p: F.concat(a, F.lit(MAGIC).cast("binary"), p["body"]))
    many = parsed(parts.select("file", "offset", joined.alias("body")), derive).filter("whole").select("file", "offset", *out)
    return single.union(many)


def page_number(record: Column) -> Column:
    return F.regexp_extract(record, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the archives of pages to the shared folder and reads them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to, intact (the payload read has the digest that its header states). A revisit's size is that
    of the record it refers to."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path, **options)
    derive = {"bytes": lambda p: F.octet_length(p).cast("long"), "own_digest": base32_sha1}
    found = stash(read(spark, path, derive).select(
        page_number(F.col("record_id")).alias("page_id"), "bytes", "payload_digest", "own_digest", "record_type", page_number(F.col("refers_to")).alias("refers_to")
    ), "records")
    full = found.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("bytes").alias("full_bytes"), F.col("own_digest").alias("full_digest")).dropDuplicates(["refers_to", "full_digest"])
    full = full.withColumnRenamed("full_digest", "payload_digest")
    out = found.join(full.hint("merge"), ["refers_to", "payload_digest"], "left")
    revisit = F.col("record_type") == "revisit"
    return out.select(
        "page_id", F.when(revisit, F.col("full_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
        F.when(revisit, F.col("full_bytes").isNotNull()).otherwise(F.col("own_digest") == F.col("payload_digest")).alias("intact"),
    )
