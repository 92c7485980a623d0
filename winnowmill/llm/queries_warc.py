"""Fixity audit of the pages as WARC records against a replica with damage by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .warc import FILE_BYTES, audit, laid_out, warc_record

SQL = rf"""
WITH records AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
      || 'WARC-Record-ID: <urn:uuid:' || md5(page_id::VARCHAR) || '>' || chr(13) || chr(10)
      || 'WARC-Date: 2026-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
      || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
      || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
      || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
files AS (SELECT greatest(1, ceil(sum(strlen(record)) / {FILE_BYTES}.0))::BIGINT AS n FROM records),
placed AS (
  SELECT *, (page_id % n)::BIGINT AS file,
         coalesce(sum(strlen(record)) OVER (PARTITION BY page_id % n ORDER BY page_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM records, files),
damaged AS (
  SELECT *, CASE page_id % 500 WHEN 7 THEN replace(record, 'Content-Type', 'Content-type')
                               WHEN 11 THEN left(record, 100) ELSE record END AS other
  FROM placed)
SELECT file, "offset", CASE page_id % 500 WHEN 13 THEN 'missing' ELSE 'corrupt' END AS status,
       strlen(record)::BIGINT AS kept_length,
       CASE WHEN page_id % 500 <> 13 THEN strlen(other) END::BIGINT AS replica_length,
       sha256(record) AS kept_digest, CASE WHEN page_id % 500 <> 13 THEN sha256(other) END AS replica_digest
FROM damaged WHERE page_id % 500 IN (7, 11, 13)
"""


@query(SQL)
def op5_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged records of a replica that has changed, cut and lost ones."""
    number = F.md5(F.col("page_id").cast("string").cast("binary"))
    record = warc_record(F.col("url"), number, F.lit("2026-01-01T00:00:00Z"), F.col("html"))
    pages = table(spark, folder, "pages")
    records = pages.select(F.coalesce("page_id", F.lit(0)).alias("page_id"), record.alias("record"))
    size = records.agg(F.sum(F.octet_length("record"))).first()[0] or 0
    # Places are laid out from the lengths alone; the records follow by key.
    lengths = records.select("page_id", F.octet_length("record").alias("length"))
    places = laid_out(lengths, "page_id", "length", max(1, -(-size // FILE_BYTES)))
    # Pages that repeat a number share a place.
    places = places.groupBy("page_id").agg(F.min("file").alias("file"), F.min("offset").alias("offset"))
    kept = records.join(places, "page_id")
    kind = F.col("page_id") % 500
    text = F.col("record").cast("string")
    other = (
        F.when(kind == 7, F.replace(text, F.lit("Content-Type"), F.lit("Content-type")).cast("binary"))
        .when(kind == 11, F.substring("record", 1, 100))
        .otherwise(F.col("record"))
    )
    return audit(kept, kept.where(kind != 13).withColumn("record", other))
