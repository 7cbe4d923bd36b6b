"""Content-addressed WARC archive.

Two tables in one folder: ``payloads`` holds every distinct payload once under
its SHA-256, ``headers`` holds the exact header bytes of every record.  Of
records with equal payloads of at least ``revisit_bytes`` bytes the one with the
smallest page id is a ``response``; the others are ``revisit`` records that
refer to it.  Smaller payloads are all responses (still stored once).  A record is
reconstructed by joining its header with its payload: header, blank line, payload
(none in a revisit), two line ends.  The payload's digest is computed again on
reading; one that differs from its address fails the read.

Equal payloads collapse in a partial aggregation before the shuffle; the join that
reads them back is a plain equi-join, which adaptive execution splits where
one digest has many records.

Defined results: null html is the empty payload; null ids come last in "smallest" (a group
without ids has only responses); rows that repeat the smallest id are all
responses; an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardscan.llm.common import table, work_path

REVISIT_BYTES = 100
URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header(date: str) -> Column:
    """The header block of a record, from page_id, url, digest, payload_bytes, record_type, refers_to."""
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\x00-\x20]", "%20")
    own = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit(f"WARC-Record-ID: <{URN}"), own, F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit(f"WARC-Refers-To: <{URN}"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))  # concat_ws leaves nulls out


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES,
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` (page_id, url, html) into ``path``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("payload")).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256))
    store = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_id"))
    store.select("digest", F.col("payload").cast("binary").alias("payload"), "first_id").write.option(
        "compression", "zstd").parquet(f"{path}/payloads")
    first = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "first_id")
    records = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    records = records.join(first, "digest")
    revisit = ((F.col("payload_bytes") >= revisit_bytes) & F.col("first_id").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    typed = records.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col("first_id")))
    typed.select("digest", _header(date).cast("binary").alias("header")).write.option(
        "compression", "zstd").parquet(f"{path}/headers")


def _field(name: str, pattern: str) -> Column:
    got = F.regexp_extract(F.col("header").cast("string"), rf"\n{name}: {pattern}\r\n", 1)
    return F.when(got != "", got)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: ``page_id, url, record_type, refers_to, digest, payload`` (resolved for
    revisits, verified) and ``record``, its exact bytes."""
    headers = spark.read.parquet(f"{path}/headers")
    store = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    sha = F.sha2("payload", 256)
    checked = store.select("digest", F.when(sha == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest"))).cast("binary")).alias("payload"))
    got = headers.join(checked, "digest")
    return got.select(
        _field("WARC-Record-ID", f"<{URN}(.*)>").cast("long").alias("page_id"),
        _field("WARC-Target-URI", "(.*)").alias("url"),
        _field("WARC-Type", "(.*)").alias("record_type"),
        _field("WARC-Refers-To", f"<{URN}(.*)>").cast("long").alias("refers_to"),
        _field("WARC-Payload-Digest", "sha256:(.*)").alias("digest"), "payload",
        F.concat("header", F.when(_field("WARC-Type", "(.*)") == "revisit", F.lit(b"")).otherwise(F.col("payload")),
                 F.lit(b"\r\n\r\n")).alias("record"))


def op2_content_addressed_warc(spark, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM f"""
