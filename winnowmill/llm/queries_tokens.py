"""Token counts of all documents. The tokenizer is not for SQL; tests compare with a tokenizer library."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .tokens import TOKENIZER_FOLDER, piece_vocabulary, token_counts


@query()
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under a unigram model over the pieces of a public tokenizer."""
    vocabulary, unknown = piece_vocabulary(os.path.join(TOKENIZER_FOLDER, "piece_bpe_32k.model"))
    return token_counts(table(spark, folder, "documents"), vocabulary, unknown, keep=["doc_id"])
