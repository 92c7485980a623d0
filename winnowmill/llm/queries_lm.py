"""Language-model scores of all documents. The model is not for SQL; tests compare with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .lm import score_documents
from .registry import query, table


@query()
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Base score and model score of every document."""
    return score_documents(table(spark, folder, "documents"))
