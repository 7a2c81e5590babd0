"""Content-addressed WARC archive: payload bytes once, exact record headers beside them.

``payloads`` holds each distinct payload under its SHA-256, ``headers`` one row per record with
the bytes that stand before the payload (WARC header and HTTP header).  Records are rebuilt by
joining the two; stored bytes are digested anew on the way and checked against their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shared_dir

CRLF = "\r\n"
#: Holds the UTF-8 of a URL with control characters, blanks or line separators in Base64.
EXACT_URL = "X-Exact-Target-URI"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*fields: Column) -> Column:
    """Null fields drop out."""
    return F.concat(F.concat_ws(CRLF, *fields), F.lit(CRLF + CRLF))


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


#: Characters that stand percent-encoded in a header line; the exact URL is kept beside it.
_UNSAFE = r"[\x00-\x20\x7F-\xA0\u2028\u2029\uFEFF]"


def _header_url(url: Column) -> Column:
    encoded = lambda c: F.regexp_replace(F.hex(F.encode(c, "utf-8")), "(..)", "%$1")
    spelt = F.array_join(F.transform(F.split(url, ""), lambda c: F.when(c.rlike(_UNSAFE), encoded(c)).otherwise(c)), "")
    return F.when(url.rlike(_UNSAFE), spelt).otherwise(url)


def _record_id(page: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), copy.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``path/headers`` and ``path/payloads`` for pages (page_id, url, html).

    Null html is an empty payload, a null url leaves out its header line, and a url of any
    characters is read back as it was.  Of equal payloads of
    at least ``min_revisit_bytes`` the largest page_id (null counts as smallest; of repeated
    rows the first url, then the first copy) is the response and the others revisit it.  Other
    columns of the input are not read.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload"), F.sha2(body, 256).alias("sha256"))
    rows.groupBy("sha256").agg(F.any_value("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{path}/payloads")

    light = rows.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
    # identical rows are counted once and numbered afterwards, so that no window gathers the records of one payload
    light = light.groupBy(*light.columns).agg(F.count("*").alias("n"))
    best = light.groupBy("sha256").agg(F.max(F.struct(F.col("page_id"), F.xxhash64("url").alias("u"))).alias("best"))
    light = light.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int")))).join(best, "sha256")
    first = F.col("page_id").eqNullSafe(F.col("best.page_id")) & (F.xxhash64("url") == F.col("best.u")) & (F.col("copy") == 0)
    revisit = (F.col("n_bytes") >= min_revisit_bytes) & ~first
    # copies of one page under several urls get ids of their own
    tag = lambda u: F.lower(F.hex(u))
    own, of = (_record_id(p, F.concat(tag(u), F.lit("."), c.cast("string"))) for p, u, c in ((F.col("page_id"), F.xxhash64("url"), F.col("copy")), (F.col("best.page_id"), F.col("best.u"), F.lit(0))))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    warc = _lines(
        F.lit("WARC/1.1"), _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _field("WARC-Record-ID", own), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _header_url(F.col("url"))), F.when(F.col("url").rlike(_UNSAFE), _field(EXACT_URL, F.translate(F.base64(F.encode("url", "utf-8")), CRLF, ""))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, _field("WARC-Refers-To", of)), F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"), _field("Content-Length", block.cast("string")),
    )
    light.select(F.concat(warc, http).cast("binary").alias("header"), "sha256").write.option("compression", "zstd").parquet(f"{path}/headers")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: header, payload, record (the exact WARC record) and what the header says.

    ``payload_digest`` and ``payload_bytes`` are taken from the stored bytes.  A payload whose
    bytes do not give its key, or do not agree with a record's header, is an error.
    """
    stored = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("sha256"), F.sha1("payload")).otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("sha256"))))
    stored = stored.select("sha256", checked.alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload")
    lines = F.split(F.substring_index(F.decode("header", "utf-8"), CRLF + CRLF, 1), CRLF)

    def said(name: str) -> Column:
        """The rest of the header's line of this name, null if it has none."""
        return F.substring(F.get(F.filter("_lines", lambda line: line.startswith(f"{name}: ")), F.lit(0)), len(name) + 3, 1 << 30)

    page = lambda name: F.regexp_extract(said(name), "^<urn:page:([^:]*):", 1).try_cast("long")
    url = F.coalesce(F.decode(F.unbase64(said(EXACT_URL)), "utf-8"), said("WARC-Target-URI"))
    headers = spark.read.parquet(f"{path}/headers").withColumn("_lines", lines)
    headers = headers.select("header", "sha256", page("WARC-Record-ID").alias("page_id"), url.alias("url"), said("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"), said("WARC-Payload-Digest").alias("_said"))
    joined = headers.join(stored, "sha256")
    agreed = F.when(F.concat(F.lit("sha1:"), F.col("payload_digest")) == F.col("_said"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record's header and its payload differ")))
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("page_id", "url", "record_type", "refers_to", "payload_bytes", agreed.alias("payload_digest"), "header", "payload", F.concat("header", block, F.lit((CRLF + CRLF).encode())).alias("record"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages in the shared folder and read the records back."""
    path = shared_dir(spark)
    write_archive(read_table(spark, sf_dir, "pages"), path, min_revisit_bytes=1000)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
         max(page_id) OVER (PARTITION BY body) AS best
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM d
"""
