"""Prompts, regular expressions, closed vocabularies, label lists and dates."""

from pyspark.sql import functions as F

from winnowmill.functions import text, typing
from winnowmill.operators import scoring

from .registry import query, rounded, table


@query("SELECT p_partkey, 'Part ' || p_name || ' {' || p_brand || '} of size ' || p_size || '.' AS prompt FROM part")
def render_prompt_format(spark, sf):
    part = table(spark, sf, "part")
    prompt = text.render_prompt(part, "Part {p_name} {{{p_brand}}} of size {p_size}.")
    return part.select("p_partkey", prompt.alias("prompt"))


@query("""
SELECT p_partkey, 'Part [' || rpad(p_brand, 12, ' ') || '] size ' || lpad(p_size::VARCHAR, 4, '0') || ' number '
  || format('{:,}', p_partkey * 1000) || ' at ' || format('{:.2f}', round(p_retailprice, 2)) || '|' || lpad(left(p_name, 5), 8, '*') AS prompt
FROM part
""")
def render_prompt_spec(spark, sf):
    part = table(spark, sf, "part").withColumn("n", F.col("p_partkey") * 1000)
    part = part.withColumn("price", F.round("p_retailprice", 2))
    prompt = text.render_prompt(
        part, "Part [{p_brand:12}] size {p_size:04d} number {n:,} at {price:.2f}|{p_name:*>8.5s}"
    )
    return part.select("p_partkey", prompt.alias("prompt"))


@query("SELECT c_custkey, 'Customer ' || c_name || 's segment costs $5: ' || c_mktsegment AS prompt FROM customer")
def render_prompt_template(spark, sf):
    customer = table(spark, sf, "customer")
    prompt = text.render_prompt(customer, "Customer ${c_name}s segment costs $$5: $c_mktsegment", style="template")
    return customer.select("c_custkey", prompt.alias("prompt"))


@query("""
SELECT p_partkey, 'Your answer must exactly match one of the following values: [yes, no {maybe}].' || chr(10) || 'Is ' || p_name || ' red?' AS prompt
FROM part
""")
def optimize_prompt(spark, sf):
    part = table(spark, sf, "part")
    prompt = text.render_prompt(part, "Is {p_name} red?", prefix=text.options_prefix(["yes", "no {maybe}"]))
    return part.select("p_partkey", prompt.alias("prompt"))


@query("SELECT doc_id, list_extract(regexp_extract_all(text, '([a-z]+)ing\\b', 1), 1) AS stem, list_extract(regexp_extract_all(text, '[0-9]{3,}'), 1) AS number FROM documents")
def regex_extract(spark, sf):
    # In ASCII letters only, as the two engines disagree on word ends next to other letters.
    return table(spark, sf, "documents").select(
        "doc_id",
        text.regex_extract_first("text", r"(?P<stem>[a-z]+)ing(?![0-9A-Za-z_])").alias("stem"),
        text.regex_extract_first("text", "[0-9]{3,}").alias("number"),
    )


@query(r"SELECT p_partkey, regexp_replace(regexp_replace(p_name, '(\w+) (\w+)', '\2 of \1', 'g'), 'bolt', '$bolt', 'g') AS name FROM part")
def regex_replace_chain(spark, sf):
    pairs = [(r"(\w+) (?P<second>\w+)", r"\g<second> of \1"), ("bolt", "$bolt")]
    return table(spark, sf, "part").select("p_partkey", text.regex_replace_chain("p_name", pairs).alias("name"))


@query("SELECT page_id, list_extract(regexp_extract_all(url, 'page=([0-9]+)', 1), 1) AS page, regexp_replace(url, '^https?://', '', 'g') AS bare FROM pages")
def process_regex(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        text.process_regex("url", "page=([0-9]+)").alias("page"),
        text.process_regex("url", ("^https?://", "")).alias("bare"),
    )


OPTIONS = ["the", "Erst", "under", "and"]
_FOUND = "list_extract(regexp_extract_all(text, '(?i)(the|erst|under|and)'), -1)"


@query(f"""
SELECT conv_id, turn, CASE lower({_FOUND}) WHEN 'the' THEN 'the' WHEN 'erst' THEN 'Erst' WHEN 'under' THEN 'under' WHEN 'and' THEN 'and' END AS choice,
       {_FOUND} AS as_written FROM conversations
""")
def constrain_exact(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        text.constrain_outputs("text", OPTIONS, fallback=False).alias("choice"),
        text.constrain_outputs("text", OPTIONS, canonical=False, fallback=False).alias("as_written"),
    )


def _matched(pairs: str) -> str:
    """CTE ``matched (k, m)``: characters in matching blocks of the texts x and y of each k of ``pairs``."""
    return f"""
pairs AS ({pairs}),
parts(k, x, y, m) AS (
  SELECT k, x, y, 0::BIGINT FROM pairs
  UNION ALL
  SELECT k, CASE WHEN side = 0 THEN substr(x, 1, -best.i - 1) ELSE substr(x, best.n - best.i) END,
         CASE WHEN side = 0 THEN substr(y, 1, -best.j - 1) ELSE substr(y, best.n - best.j) END,
         CASE WHEN side = 0 THEN best.n ELSE 0 END
  FROM (
    SELECT k, x, y, list_max(flatten(list_transform(range(1, length(x) + 1), lambda i: list_transform(
             list_filter(range(1, length(y) + 1), lambda j: substr(x, i, 1) = substr(y, j, 1)),
             lambda j: {{'n': list_max(list_filter(range(1, least(length(x) - i, length(y) - j) + 2),
                                                  lambda n: substr(x, i, n) = substr(y, j, n))), 'i': -i, 'j': -j}})))) AS best
    FROM parts WHERE x <> '' AND y <> '') s, range(2) t(side)
  WHERE best IS NOT NULL),
matched AS (SELECT k, sum(m) AS m FROM parts GROUP BY k)"""


FALLBACK = ["widgets, red", "small rings", "hot geer", "other"]


# Each part name is rated once; no option is named in one.
@query(f"""
WITH RECURSIVE names AS (SELECT DISTINCT p_name FROM part),
options AS (SELECT unnest({FALLBACK}) AS o, unnest([1, 2, 3, 4]) AS place),
{_matched("SELECT p_name || '|' || o AS k, p_name AS x, o AS y FROM names, options")},
rated AS (
  SELECT p_name, o, place, 2.0::DOUBLE * m / (length(p_name) + length(o)) AS s
  FROM names, options JOIN matched ON k = p_name || '|' || o),
best AS (SELECT p_name, arg_max(o, s * 1000 - place / 1000.0) AS o, max(s) AS s FROM rated GROUP BY p_name)
SELECT p_partkey, CASE WHEN s < 0.5 THEN 'other' ELSE o END AS choice FROM part JOIN best USING (p_name)
""")
def constrain_fallback(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.constrain_outputs("p_name", FALLBACK).alias("choice"))


@query(f"""
WITH RECURSIVE {_matched("SELECT p_partkey AS k, p_name AS x, lower(p_type) || ' widget ring' AS y FROM part")}
SELECT p_partkey, round(2.0::DOUBLE * m / (length(p_name) + length(p_type) + 12), 6) AS ratio FROM part JOIN matched ON k = p_partkey
""")
def similarity_ratio(spark, sf):
    other = F.concat(F.lower("p_type"), F.lit(" widget ring"))
    return table(spark, sf, "part").select("p_partkey", rounded(text.similarity_ratio(F.col("p_name"), other)).alias("ratio"))


@query("SELECT event_id, [event_type, 'a,b', CAST(user_id AS VARCHAR), ''] AS labels FROM events")
def split_labels(spark, sf):
    line = F.concat("event_type", F.lit(',"a,b",'), F.col("user_id").cast("string"), F.lit(","))
    return table(spark, sf, "events").select("event_id", text.split_labels(line).alias("labels"))


@query("SELECT o_orderkey, epoch(o_orderdate)::BIGINT + o_orderkey % 86400 AS seconds FROM orders")
def http_date(spark, sf):
    orders = table(spark, sf, "orders")
    moment = F.timestamp_seconds(
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400
    )
    written = F.date_format(moment, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    return orders.select("o_orderkey", F.unix_seconds(text.parse_http_date(written)).alias("seconds"))


@query("SELECT event_id, value, value BETWEEN 0 AND 1 AS in_range FROM events")
def unit_range(spark, sf):
    return table(spark, sf, "events").select("event_id", "value", typing.in_unit_range("value").alias("in_range"))


# Each text is repeated so that the service limits are met by some and broken by others.
@query("""
WITH long AS (SELECT doc_id, repeat(text, 80) AS prompt, repeat(text, 12) AS response FROM documents),
sized AS (SELECT doc_id, length(prompt) / 4.0 AS p, length(response) / 4.0 AS r FROM long)
SELECT doc_id, CASE WHEN p > 70000 THEN 'Error executing query at index ' || doc_id || ': Prompt length exceeds maximum length of 70000 tokens'
  WHEN r > 15000 THEN 'Error executing query at index ' || doc_id || ': Response length exceeds maximum length of 15000 tokens'
  WHEN p + r > 70000 THEN 'Error executing query at index ' || doc_id || ': Prompt and response combined length exceeds maximum combined length of 70000 tokens'
  END AS message FROM sized
""")
def length_limits(spark, sf):
    long = table(spark, sf, "documents").select(
        "doc_id", F.repeat("text", F.lit(80)).alias("prompt"), F.repeat("text", F.lit(12)).alias("response")
    )
    error = scoring.length_error("prompt", "response", "doc_id")
    return long.select("doc_id", error["message"].alias("message"))
