"""The mix of all documents. Random permutations decide, so there is no SQL; tests compare it with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import mix
from .registry import query, table


@query()
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of every document, with the size and the target of its source."""
    mixed, plan, rows = mix(table(spark, folder, "documents"))
    taken = mixed.groupBy(F.col("source").alias("s"), "doc_start").agg(F.sum("n_words").alias("taken"))
    # Documents without words are never taken; they share their place with the next one.
    own = F.when(F.col("__size") > 0, F.col("__start"))
    rows = rows.join(taken, F.col("__source").eqNullSafe(F.col("s")) & (own == F.col("doc_start")), "left")
    rows = rows.join(plan, F.col("__source").eqNullSafe(plan["source"]))
    return rows.select(
        "doc_id",
        F.col("__size").alias("size"),
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )
