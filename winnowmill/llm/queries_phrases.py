"""Collocations of every language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .phrases import collocations
from .registry import query, table

SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
texts AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS p, count(*) AS f
  FROM texts, (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i) r GROUP BY ALL),
words AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.p, c.k, a, c.w, pos, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM candidates c, LATERAL (SELECT unnest(range(1, c.k)) AS pos) s
  JOIN grams x ON x.lang = c.lang AND x.p = array_to_string(c.w[1 : pos], ' ')
  JOIN grams y ON y.lang = c.lang AND y.p = array_to_string(c.w[pos + 1 :], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, pos) = 1),
around AS (
  SELECT lang, p, max(a) AS a FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS p, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, c.p) AS rank
  FROM lowest c LEFT JOIN around b ON b.lang = c.lang AND b.p = c.p AND c.k = 2
  WHERE coalesce(100 * b.a < 50 * c.a, true))
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""


@query(SQL)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 phrases of two or three words of each language."""
    return collocations(table(spark, folder, "documents"))
