"""WARC archives with revisit records for repeated payloads.

Headers (page id, payload digest, length) are grouped by digest, so one row per
digest and task crosses the shuffle however often a payload repeats; pages whose
digest belongs to a later page become ``revisit`` records that refer to it and
carry no payload.  Spark's text writer stores the records: a record is a header,
a blank line and the UTF-8 payload, and the writer's line separator is the two
line ends that close a record.  ``read_archives`` parses by Content-Length, so
payloads may hold any text, record separators included.

Defined results: a null html is an empty payload; payloads shorter than
``min_bytes`` are never deduplicated; a null url is written as an empty target;
a null page_id cannot be referred to and its row is always a response; repeated
page ids with equal payload all become the response of their group; an empty
table gives an archive without records.
"""

from __future__ import annotations

import gzip
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

CRLF = "\r\n"
#: fixed by the format
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_FROM, BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: payload bytes that one archive aims at (a reading task holds one archive in memory)
ARCHIVE_BYTES = 8 << 20


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 10 hex digits are 40 bits, or 8 base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_FROM, BASE32_TO)


def resolve_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Only headers are shuffled by digest; the payloads move once, when they meet the revisits by page.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("payload"))
    rows = (rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", base32_sha1(F.col("payload").cast("binary"))))
    headers = (rows.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
               .select("page_id", "payload_digest"))
    originals = headers.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"),
                                                      F.count(F.lit(1)).alias("_pages"))
    # only digests that repeat need the join
    revisits = (headers.join(originals.filter("_pages > 1").drop("_pages"), "payload_digest")
                .filter(F.col("refers_to") != F.col("page_id")).distinct())
    joined = rows.join(revisits, ["page_id", "payload_digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    return (joined.withColumn("record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")))
            .withColumn("payload", F.when(revisit, F.lit("")).otherwise(F.col("payload"))))


def _one_line(value: Column) -> Column:
    """A header value: line ends would end the header."""
    return F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\r\n]+", " ")


def record_text(date: str) -> Column:
    """One WARC record without its closing separator; headers are made anew for every record."""
    def line(name: str, value) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    page = _one_line(F.col("page_id"))
    revisit = F.col("record_type") == "revisit"
    identity = F.concat(F.lit("<urn:page:"), page, F.lit(">"))
    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", identity),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length("payload").cast("string")),
        F.lit(CRLF), F.col("payload"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records as gzip archives of about ``archive_bytes`` of payload each.

    Every task writes archives of as many records as make up that size on average.
    """
    sizes = pages.agg(F.avg(F.octet_length(F.coalesce(F.col("html"), F.lit("")))).alias("mean")).first()
    records = max(1, int(archive_bytes // ((sizes["mean"] or 0) + 512)))
    (resolve_revisits(pages, min_bytes).select(record_text(date).alias("value"))
     .write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records).text(path))


_READ = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def parse_records(data: bytes):
    """(headers, payload) of each record of an archive; walks by Content-Length."""
    at, end = 0, len(data)
    while at < end:
        stop = data.index(b"\r\n\r\n", at)
        head = data[at:stop].decode("utf-8").split(CRLF)
        if head[0] != VERSION:
            raise ValueError(f"not a WARC record at byte {at}")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head[1:])
        size = int(fields["Content-Length"])
        body = stop + 4
        if data[body + size:body + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is not closed")
        yield fields, data[body:body + size]
        at = body + size + 4


def _page_of(identity: str | None) -> int | None:
    if identity is None:
        return None
    number = identity.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _parse(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])
    for batch in batches:
        for content in batch.column(0):
            rows = [(_page_of(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Type"],
                     h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["WARC-Payload-Length"]),
                     _page_of(h.get("WARC-Refers-To")), body)
                    for h, body in parse_records(gzip.decompress(content.as_buffer().to_pybytes()))]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``; one archive at a time is in memory."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_parse, _READ)


def op4_warc_revisits(pages: DataFrame) -> DataFrame:
    """Write one record per page, then report what the archives hold."""
    spark = pages.sparkSession
    path = scratch_dir(spark, f"warc-{uuid.uuid4().hex[:6]}")
    write_archives(pages, path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql() -> str:
    digits = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    chars = " || ".join(
        f"substr({digits}, CAST((('0x' || substr(h, {1 + 10 * i}, 10))::BIGINT >> {35 - 5 * j}) & 31 AS INTEGER) + 1, 1)"
        for i in range(4) for j in range(8))
    return f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (SELECT page_id, payload_bytes, {chars} AS payload_digest FROM hashed),
owners AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM owners"""
