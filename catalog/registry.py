"""Names of queries, their Spark form and their SQL form."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowmill.plans.lineage import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE_SQL[key] = sql.strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The same rows on all cores: a small file is one partition, however long the work on its rows takes."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which all executors can reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def rounded(col: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


def rounded_array(col: Column | str, digits: int = 6) -> Column:
    return F.transform(F.col(col) if isinstance(col, str) else col, lambda v: F.round(v, digits))


# --- stand-ins shared by several queries, in both forms -------------------------------------------


def dataset(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a labeled dataset: the label is the language."""
    return table(spark, folder, "documents").select(
        "doc_id", "text", F.col("lang").alias("label"), "source", "n_chars"
    )


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Audit decisions: toxic documents are excluded, those of low quality go to review."""
    return table(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, "exclude").alias("action"),
        F.when(F.col("quality") == 0, "review").alias("corrected_label"),
    )


DECISIONS = """
decisions AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'exclude' END AS action,
         CASE WHEN quality = 0 THEN 'review' END AS corrected_label
  FROM labels)
"""

NORMALIZED = r"trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g'))"

CLEANSET = f"""
cleanset AS (
  SELECT doc_id, CASE WHEN source < 'src15' THEN 'real' ELSE 'synthetic' END AS real_or_synthetic,
         (n_chars % 100) / 100.0::DOUBLE AS label_issue_score,
         count(*) OVER (PARTITION BY {NORMALIZED}) > 1 AS is_near_duplicate,
         CASE WHEN count(*) OVER (PARTITION BY {NORMALIZED}) > 1
              THEN min(doc_id) OVER (PARTITION BY {NORMALIZED}) END AS near_duplicate_cluster_id
  FROM documents)
"""


def cleanset(spark: SparkSession, folder: str) -> DataFrame:
    from winnowmill.operators.near_duplicates import exact_duplicates

    docs = table(spark, folder, "documents")
    rows = docs.select(
        "doc_id",
        F.when(F.col("source") < "src15", "real").otherwise("synthetic").alias("real_or_synthetic"),
        ((F.col("n_chars") % 100) / F.lit(100.0)).alias("label_issue_score"),
    )
    return rows.join(exact_duplicates(docs, "doc_id", "text"), "doc_id")


def square_probs(spark: SparkSession, folder: str) -> DataFrame:
    """Squares of the unit vectors: 64 class probabilities that add up to one."""
    square = F.transform("embedding", lambda x: x.cast("double") * x.cast("double"))
    return table(spark, folder, "embeddings").select("vec_id", "label", square.alias("probs"))


SQUARE_CLASSES = [f"c{i}" for i in range(64)]
SQUARES = """
squares AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE) AS probs,
         list_transform(range(64), lambda i: 'c' || i) AS classes
  FROM embeddings)
"""
