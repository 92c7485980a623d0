"""Near-duplicates over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .near import near_duplicates
from .registry import query, table

SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, words[i] || ' ' || words[i + 1] AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM texts WHERE len(words) >= 2)
  UNION ALL SELECT doc_id, words[1] FROM texts WHERE len(words) = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * shared >= 80 * (m.n + n.n - shared)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r),
parts AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT p.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, component_id, p.doc_id = component_id AS kept
FROM parts p LEFT JOIN sizes s USING (doc_id)
"""


@query(SQL)
def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document: two-word shingles, similarity 0.8."""
    return near_duplicates(table(spark, folder, "documents"), words=2, percent=80)
