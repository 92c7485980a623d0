"""Sharding of all documents. The order is random, so there is no SQL; tests compare it with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .sharding import shard, shard_of

SHARDS, SEED = 8, 1


@query()
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, digests taken from the written records."""
    rows = shard(table(spark, folder, "documents"), "doc_id", "text", SHARDS, SEED)
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), SHARDS + 1, SEED).alias("grown_shard"),
    )
