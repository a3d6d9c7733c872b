import base64
import hashlib

from cadenza.llm import warc

SCHEMA = "page_id long, url string, html string, digest int"


def expected(rows):
    first = {}
    for i, _, html, _ in rows:
        h = html or ""
        first[h] = min((x for x in (first.get(h), i) if x is not None), default=None)
    out = set()
    for i, _, html, _ in rows:
        h = html or ""
        later = first[h] is not None and i != first[h]
        out.add((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if later else "response", first[h] if later else None))
    return out


def test_round_trip(spark):
    fake = f"x\r\n\r\n{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/", "<p>hé</p>", 0), (2, None, "<p>hé</p>", 0), (3, "u", None, 0), (4, "u", "", 0), (5, f"u{warc.MAGIC}", fake, 0), (6, "u", fake * 3, 0), (7, "u", fake, 0), (8, "u", warc.MAGIC, 0), (9, "u", "\r\n\r\n", 0), (10, "u", "long " * 100_000, 0), (None, "u", "nobody", 0), (11, "u", "twice", 0), (11, "u", "twice", 0)]
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    assert {tuple(r)[:5] for r in got} == expected(rows)


def test_splits_and_broken_chains(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"{i} {warc.MAGIC}" * (i % 7), 0) for i in range(300)], SCHEMA)
    warc.write(pages.coalesce(1), str(tmp_path / "w"), compression=None)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = warc.read(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 300
    body = {r.record_id: bytes(r.payload).decode() for r in got if r.record_type == "response"}
    assert all(v == f"{k[10:-1]} {warc.MAGIC}" * (int(k[10:-1]) % 7) for k, v in body.items())
    whole = next((tmp_path / "w").glob("part*")).read_bytes()
    (tmp_path / "cut").write_bytes(whole[: len(whole) * 2 // 3])
    assert 0 < warc.read(spark, str(tmp_path / "cut")).count() < 300
    (tmp_path / "junk").write_bytes(b"junk" + whole)
    assert warc.read(spark, str(tmp_path / "junk")).count() == 0


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
