"""The URL filter over all pages. The tree is not for SQL; tests compare with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .urls import filter_urls, host_and_path

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def page_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Pages show documents, whose number is in their path; a page is bad if that document is toxic or poor."""
    host, path = host_and_path(F.col("url"))
    pages = table(spark, folder, "pages").select(host.alias("host"), path.alias("path"))
    pages = pages.withColumn("shown", F.regexp_extract("path", r"^/[a-z]{2}/(\d{1,18})", 1).try_cast("bigint"))
    labels = table(spark, folder, "labels").select(
        "doc_id", F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0).alias("bad")
    )
    return pages.distinct().join(labels, F.col("shown") == F.col("doc_id")).select("host", "path", "bad")


@query()
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return filter_urls(table(spark, folder, "pages"), page_labels(spark, folder), RULES)
