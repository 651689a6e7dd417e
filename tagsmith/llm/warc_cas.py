"""WARC archive with content-addressed payloads.

The archive is a folder with two Parquet tables:

* ``payloads`` (key, payload): the payload bytes, stored once per SHA-256 key;
* ``records`` (key, header): for every record its exact bytes up to the
  payload (WARC header, blank line and HTTP header).

A record is ``header + payload + CRLF CRLF``; a revisit record ends after its
header, and its payload is found by the same key.  Only DataFrame functions
are used; the payload table is the distributed, atomically committed store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base-32 SHA-1 of a binary column (160 bits, 32 digits)."""
    digest = F.sha1(payload)
    parts = []
    for i in range(4):  # 40 bits at a time
        v = F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(BASE32), F.shiftright(v, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
                  for j in range(8)]
    return F.concat(*parts)


def _uuid(text: Column) -> Column:
    h = F.md5(text.cast("binary"))
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing when the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), _uuid(F.concat(F.lit("page:"), page_id.cast("string"))), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                  id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per row of ``pages`` below ``path``.

    Of the rows with equal payloads of at least ``min_bytes`` bytes, those with
    the smallest id are ``response`` records, the others ``revisit`` records
    that refer to it; shorter payloads are all ``response``.  Null html is an
    empty payload.  A null id sorts after all others (a group of null ids only
    is all ``response``), a null url leaves out its header line, line breaks
    in a url are percent-encoded.  Repeated rows give a record each.  Other
    columns are ignored; an empty table gives an empty archive.

    Keys are verified when the groups are formed: rows of one key must agree
    in length and in SHA-1, else the job fails."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.regexp_replace(F.regexp_replace(F.col(url_col).cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
                        payload.alias("payload")) \
        .withColumn("key", F.sha2("payload", 256)).withColumn("sha1", base32_sha1(F.col("payload"))) \
        .withColumn("n", F.octet_length("payload").cast("long"))
    # copies are combined before the shuffle: one payload per key and task
    rows.groupBy("key").agg(F.any_value("payload").alias("payload")).write.parquet(f"{path}/payloads")
    lean = rows.drop("payload")
    first = lean.groupBy("key").agg(
        F.min("page_id").alias("first"),
        ((F.min("n") == F.max("n")) & (F.min("sha1") == F.max("sha1"))).alias("same"))
    page, first_id = F.col("page_id"), F.col("first")
    whole = (F.col("n") < min_bytes) | page.eqNullSafe(first_id)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(CRLF * 2))
    block = F.octet_length(http) + F.when(whole, F.col("n")).otherwise(F.lit(0))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(whole, "response").otherwise("revisit"), F.lit(CRLF),
        _line("WARC-Record-ID", F.coalesce(_record_id(page), F.lit("<urn:uuid:00000000-0000-0000-0000-000000000000>"))),
        _line("WARC-Page-ID", page.cast("string")),
        _line("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {date}{CRLF}"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(~whole, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("WARC-Refers-To", F.when(~whole, _record_id(first_id))),
        _line("WARC-Refers-To-Page-ID", F.when(~whole, first_id.cast("string"))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("Content-Length", block.cast("string")), F.lit(CRLF), http)
    lean.join(first, "key").select(
        "key", F.when(F.col("same"), header).otherwise(F.raise_error(F.lit("two payloads share a SHA-256 key")))
        .cast("binary").alias("header")).write.parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload): every record of the archive joined with its payload
    by content key.  Each stored payload is hashed again and must match its
    key, else the job fails."""
    stored = spark.read.schema("key string, payload binary").parquet(f"{path}/payloads")
    sound = stored.select("key", F.when(F.sha2("payload", 256) == F.col("key"), F.col("payload"))
                          .otherwise(F.raise_error(F.lit("a stored payload does not match its key"))).alias("payload"))
    records = spark.read.schema("key string, header binary").parquet(f"{path}/records")
    return records.join(sound, "key").select("header", "payload")


def record_bytes(header: Column, payload: Column) -> Column:
    """The exact bytes of a record as a WARC file holds them."""
    body = F.when(field(header, "WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(payload)
    return F.concat(header, body, F.lit(CRLF * 2).cast("binary"))


def field(header: Column, name: str) -> Column:
    """Value of a WARC header line, null when absent."""
    found = F.regexp_extract(F.decode(header, "UTF-8"), rf"(?s)^WARC/1\.1\r\n(?:[^\r\n]*\r\n)*?{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def archive_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the archive, from the bytes read back: page_id,
    payload_bytes, payload_digest (recomputed from the payload and checked
    against the header), record_type, refers_to."""
    rec = read_archive(spark, path)
    digest = base32_sha1(F.col("payload"))
    told = F.substring(field(F.col("header"), "WARC-Payload-Digest"), 6, 32)
    return rec.select(
        field(F.col("header"), "WARC-Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        digest.alias("sha1"), told.alias("told"),
        field(F.col("header"), "WARC-Type").alias("record_type"),
        field(F.col("header"), "WARC-Refers-To-Page-ID").cast("long").alias("refers_to")).select(
        "page_id", "payload_bytes",
        F.when(F.col("sha1") == F.col("told"), F.col("sha1"))
        .otherwise(F.raise_error(F.lit("payload digest differs from the header"))).alias("payload_digest"),
        "record_type", "refers_to")
