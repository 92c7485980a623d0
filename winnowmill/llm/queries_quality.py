"""The quality cascade over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .quality import BASE_RULES, FEATURES, quality_cascade
from .registry import query, table

SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts WHERE len(words) >= 8)),
repeated AS (
  SELECT doc_id, unnest(starts) AS i
  FROM (SELECT doc_id, win, list(i) AS starts FROM windows GROUP BY doc_id, win HAVING count(*) > 1)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM repeated)
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)),
                             lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM texts),
features AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM texts t JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 40 * n_words
            OR 10 * word_chars < 15 * n_words OR 10 * word_chars > 300 * n_words
            OR 100 * n_dup_lines > 10 * n_words) AS kept
FROM features
"""


@query(SQL)
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of every document; the base rules are part of the cascade."""
    rows = quality_cascade(table(spark, folder, "documents"), "text", complete=True)
    size, repeat = BASE_RULES
    failed = size.fails(rows["n_words"], rows["n_words"]) | repeat.fails(rows["n_repeat_words"], rows["n_words"])
    return rows.select("doc_id", *FEATURES, failed.alias("base_failed"), "kept")
