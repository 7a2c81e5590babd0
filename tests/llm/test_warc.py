import hashlib
import re

import duckdb
import pytest

from pagemill.llm.common import shared_dir
from pagemill.llm.warc import OP5_SQL, op5_warc, read_archive, write_archive

BIG = "<p>" + "x" * 1200
PAGES = [(1, "http://a/", BIG), (2, "http://b/", BIG), (3, "http://c/", "small"), (4, None, "small"), (5, "http://d/", None), (6, "http://e/\r\nX: y", ""), (7, "http://é/", "naïve 😀" * 200), (7, "http://é/", "naïve 😀" * 200), (None, "http://n/", BIG), (8, "http://a/", BIG), (8, "http://z/", BIG)]


def archive(spark, rows):
    path = shared_dir(spark)
    write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    return read_archive(spark, path)


def parse(record):
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
    assert len(rest) - 4 == int(fields[b"Content-Length"])
    return fields, rest[:-4].partition(b"\r\n\r\n")[2]


def test_round_trip(spark):
    rows = archive(spark, PAGES).collect()
    assert len(rows) == len(PAGES)
    ids = [parse(bytes(r["record"]))[0][b"WARC-Record-ID"] for r in rows]
    assert len(set(ids)) == len(ids)
    payloads = sorted(hashlib.sha1((h or "").encode()).hexdigest() for _, _, h in PAGES)
    assert sorted(r["payload_digest"] for r in rows) == payloads
    for r in rows:
        fields, body = parse(bytes(r["record"]))
        assert fields[b"WARC-Payload-Digest"].decode() == "sha1:" + hashlib.sha1(bytes(r["payload"])).hexdigest()
        if r["record_type"] == "response":
            assert body == bytes(r["payload"]) and r["refers_to"] is None
        else:
            assert body == b"" and fields[b"WARC-Refers-To"] in ids
    big = [r for r in rows if r["payload_bytes"] == len(BIG)]
    assert sum(r["record_type"] == "response" for r in big) == 1
    assert {r["refers_to"] for r in big if r["record_type"] == "revisit"} == {8}
    assert sum(r["record_type"] == "revisit" for r in rows if r["page_id"] == 7) == 1


def test_any_url_comes_back(spark):
    """Control characters and line separators neither forge fields nor get lost."""
    forged = ["\u0085WARC-Payload-Digest: sha1:00", "\u2028WARC-Refers-To: <urn:page:999:x>", "\r\nWARC-Refers-To: <urn:page:999:x>\r\n\r\nbody", "http://x/\r\n\r\n"]
    urls = [None, "", " ", "http://é/%0A?a=b%20c", "http://a/ b", "x" * 100_000, *forged, *(f"http://a/{chr(c)}b{chr(c)}" for c in [*range(1, 33), 0, 127, *range(128, 161), 0x2028, 0x2029, 0xFEFF, 0x3000])]
    pages = [(i, u, BIG if i % 2 else "small") for i, u in enumerate(urls)]
    rows = archive(spark, pages).collect()
    assert {r["page_id"]: r["url"] for r in rows} == dict(enumerate(urls)) and len(rows) == len(urls)
    last = max(i for i, _, _ in pages if i % 2)
    for r in rows:
        fields, _ = parse(bytes(r["record"]))
        assert fields[b"WARC-Record-ID"].startswith(b"<urn:page:%d:" % r["page_id"])
        assert r["refers_to"] == (last if r["page_id"] % 2 and r["page_id"] != last else None)


def test_payloads_are_stored_once(spark):
    path = shared_dir(spark)
    write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in PAGES})


def test_damage_is_found(spark):
    path, bad = shared_dir(spark), shared_dir(spark)
    write_archive(spark.createDataFrame(PAGES, "page_id long, url string, html string"), path)
    spark.read.parquet(f"{path}/headers").write.parquet(f"{bad}/headers")
    spark.read.parquet(f"{path}/payloads").selectExpr("sha256", "cast(concat(decode(payload, 'utf-8'), '!') as binary) payload").write.parquet(f"{bad}/payloads")
    with pytest.raises(Exception, match="does not match"):
        read_archive(spark, bad).collect()


def test_empty_table(spark):
    assert archive(spark, []).collect() == []


def test_query_equals_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = sorted(duck.execute(OP5_SQL).fetchall())
    assert sorted(tuple(r) for r in op5_warc(spark, sf_dir).collect()) == want
    assert all(re.fullmatch("[0-9a-f]{40}", r[2]) for r in want)
