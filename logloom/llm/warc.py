"""A content-addressed WARC archive.

Payload bytes are written once per digest, record headers for every record; the
records come back by joining the two. The digest is SHA-256, and a second hash and
the length must agree for all payloads under one digest, or writing fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shorter payloads are stored once as well, but their records never refer to another one.
REVISIT_FROM = 1000
DATE = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    """Folders of the two tables of an archive."""

    headers: str
    payloads: str


def _line(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value; line ends in values are escaped."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, folder: str) -> Archive:
    """Write one record per row of ``pages(page_id, url, html)``.

    A null html is an empty payload, a null url leaves out the target line. Of the
    records with one payload of at least ``REVISIT_FROM`` bytes that with the largest
    page_id is the response, the others are revisits that refer to it; rows that
    repeat that id are responses too. A record with a null page_id is a response
    without an id. An empty table gives empty tables; other columns are not read.
    """
    archive = Archive(f"{folder}/headers", f"{folder}/payloads")
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).select("*", F.sha2("payload", 256).alias("digest"))
    stored = rows.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.min(F.xxhash64("payload")).alias("lo"),
        F.max(F.xxhash64("payload")).alias("hi"),
        F.min(F.length("payload")).alias("short"),
        F.max(F.length("payload")).alias("long"),
    )
    agree = (F.col("lo") == F.col("hi")) & (F.col("short") == F.col("long"))
    checked = F.when(agree, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("different payloads under "), F.col("digest"))))
    stored.select("digest", checked.alias("payload")).write.mode("errorifexists").parquet(archive.payloads)

    narrow = rows.select("page_id", "url", "digest", F.sha1("payload").alias("sha1"), F.length("payload").cast("long").alias("n"))
    owners = narrow.where(F.col("n") >= REVISIT_FROM).groupBy("digest").agg(F.max("page_id").alias("owner"))
    owned = narrow.join(owners, "digest", "left")
    revisit = F.coalesce(F.col("page_id") < F.col("owner"), F.lit(False))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("owner")))),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("Content-Type", F.when(~revisit, F.lit("text/html; charset=utf-8"))),
        _line("Content-Length", F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("n"))),
        F.lit("\r\n"),
    )
    owned.select("digest", header.alias("header")).write.mode("errorifexists").parquet(archive.headers)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """``(header, block, payload)`` of every record: the block as written, the payload it stands for."""
    headers, payloads = spark.read.parquet(archive.headers), spark.read.parquet(archive.payloads)
    block = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return headers.join(payloads, "digest").select("header", block.alias("block"), "payload")


def record_bytes() -> Column:
    """A record of ``read_archive`` as it stands in a WARC file."""
    return F.concat(F.encode(F.col("header"), "UTF-8"), F.col("block"), F.lit(b"\r\n\r\n"))


def field(name: str) -> Column:
    """The value of a header line; null if there is none."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def parse_records(records: DataFrame) -> DataFrame:
    """Fields of each record; fails if a payload or a length is not what the header says."""
    number = F.lit(r"<urn:page:(-?\d+)>")
    sha1 = F.sha1("payload")
    right = (F.concat(F.lit("sha1:"), sha1) == field("WARC-Payload-Digest")) & (
        F.length("block").cast("long") == field("Content-Length").cast("long")
    )
    digest = F.when(right, sha1).otherwise(F.raise_error(F.lit("a record does not match its header")))
    return records.select(
        F.regexp_substr(F.regexp_substr(field("WARC-Record-ID"), number), F.lit(r"-?\d+")).cast("long").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.regexp_substr(F.regexp_substr(field("WARC-Refers-To"), number), F.lit(r"-?\d+")).cast("long").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"),
    )


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
    CASE WHEN strlen(coalesce(html, '')) >= 1000 THEN max(page_id) OVER (PARTITION BY coalesce(html, '')) END AS owner
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < owner THEN owner END AS refers_to
FROM p
"""
