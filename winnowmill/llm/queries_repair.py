"""Structure repair of damaged conversations."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .repair import COUNTS, repair_conversations, sha256_of

EMPTY = hashlib.sha256(b"").hexdigest()

#: A step of the program, as SQL: the ways (cost, audit, repaired) into each state past one more row.
SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM given, range(CASE WHEN d = 3 THEN 2 ELSE 1 END) WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         rtrim(text, E' \t\n\x0b\x0c\r') AS body FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS r, CASE WHEN body = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS r0
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (r0 IS NOT NULL AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
-- Ways into the four states (nothing, after s, after u, after a) with inserts after them; lists, so that none is empty.
steps(conv_id, i, o, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, [{'c': 0, 'e': '', 'x': ''}],
         [{'c': 0, 'e': '', 'x': ''}][1:0], [{'c': 0, 'e': '', 'x': ''}][1:0], [{'c': 0, 'e': '', 'x': ''}][1:0] FROM counted
  UNION ALL
  SELECT conv_id, i, list_sort(o)[1:1], list_sort(s)[1:1], list_sort(u)[1:1], list_sort(a)[1:1] FROM (
    SELECT w.conv_id, j.i,
      list_transform(o, lambda w: {'c': w.c + 4, 'e': w.e || 'D', 'x': w.x}) AS o,
      list_concat(list_transform(s, lambda w: {'c': w.c + 4, 'e': w.e || 'D', 'x': w.x}),
        list_transform(CASE WHEN stays AND r = 's' THEN o ELSE o[1:0] END,
          lambda w: {'c': w.c + more, 'e': w.e || 'K', 'x': w.x || chr(10) || role || ':' || text})) AS s,
      list_concat(list_transform(u1, lambda w: {'c': w.c + 4, 'e': w.e || 'D', 'x': w.x}),
        list_transform(CASE WHEN stays AND r = 'u' THEN to_u ELSE o[1:0] END,
          lambda w: {'c': w.c + more, 'e': w.e || 'K', 'x': w.x || chr(10) || role || ':' || text}),
        list_transform(CASE WHEN stays THEN to_u ELSE o[1:0] END,
          lambda w: {'c': w.c + 3 + more, 'e': w.e || 'R', 'x': w.x || chr(10) || 'user:' || text})) AS u,
      list_concat(list_transform(a1, lambda w: {'c': w.c + 4, 'e': w.e || 'D', 'x': w.x}),
        list_transform(CASE WHEN stays AND r = 'a' THEN u1 ELSE o[1:0] END,
          lambda w: {'c': w.c + more, 'e': w.e || 'K', 'x': w.x || chr(10) || role || ':' || text}),
        list_transform(CASE WHEN stays THEN u1 ELSE o[1:0] END,
          lambda w: {'c': w.c + 3 + more, 'e': w.e || 'R', 'x': w.x || chr(10) || 'assistant:' || text})) AS a
    FROM (
      SELECT *, list_concat(o, s, a1) AS to_u FROM (
        SELECT *, list_concat(a, list_transform(u1, lambda w: {'c': w.c + 3, 'e': w.e || 'I', 'x': w.x || chr(10) || 'assistant:'})) AS a1
        FROM (SELECT *, list_concat(u, list_transform(list_concat(o, s, a),
                lambda w: {'c': w.c + 3, 'e': w.e || 'I', 'x': w.x || chr(10) || 'user:'})) AS u1 FROM steps))) w
    JOIN (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more
          FROM judged) j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1)),
ends AS (
  SELECT conv_id, list_sort(list_concat(o, a, list_transform(list_concat(u, list_transform(list_concat(o, s, a),
           lambda w: {'c': w.c + 3, 'e': w.e || 'I', 'x': w.x || chr(10) || 'user:'})),
           lambda w: {'c': w.c + 3, 'e': w.e || 'I', 'x': w.x || chr(10) || 'assistant:'})))[1] AS best
  FROM steps JOIN counted USING (conv_id) WHERE i = n)
SELECT g.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.e, '') AS audit, sha256(coalesce(best.x[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM g.conv_id
"""


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults that depend on conversation and turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("d"))
    rows = rows.where("d <> 0").withColumn("n", F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("d") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))


@query(SQL)
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation after damage."""
    rows = table(spark, folder, "conversations")
    summary, repaired = repair_conversations(damaged(rows))
    digests = sha256_of(repaired).withColumnRenamed("conv", "__of")
    out = rows.select("conv_id").distinct().join(summary, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    out = out.join(digests, F.col("conv_id").eqNullSafe(F.col("__of")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return out.select(
        "conv_id", *[zero(c) for c in (*COUNTS, "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(EMPTY)).alias("repaired_sha256"),
    )
