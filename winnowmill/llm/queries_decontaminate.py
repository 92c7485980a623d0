"""Benchmark decontamination of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .registry import query, table

_WORDS = r"""list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

SQL = f"""
WITH texts AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT item_id, least(10, len(words)) AS n, array_to_string(words[i : i + 9], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0)),
grams AS (
  SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i
        FROM texts, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
found AS (SELECT DISTINCT doc_id, i, g.n, item_id FROM grams g JOIN windows w ON g.n = w.n AND g.win = w.win),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(item_list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts t LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""


@query(SQL)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Hit words and items of every document."""
    rows = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
