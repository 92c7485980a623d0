"""Casts, conformity, profiles and label checks, and the files that carry them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from winnowmill.functions import typing
from winnowmill.operators import schema
from winnowmill.sources import readers, writers

from .registry import query, rounded, scratch, table

# Texts as an untyped file would hold them, derived from line items.
UNTYPED = """
untyped AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS quantity, CAST(l_discount AS VARCHAR) AS discount,
         CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'N' THEN '0.0' ELSE 'maybe' END AS returned,
         CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || ' +0200'
              ELSE CAST(epoch(l_shipdate)::BIGINT AS VARCHAR) END AS shipped
  FROM lineitem)
"""


def untyped(spark, sf):
    items = table(spark, sf, "lineitem")
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_discount").cast("string").alias("discount"),
        F.when(F.col("l_returnflag") == "A", "Yes").when(F.col("l_returnflag") == "N", "0.0").otherwise("maybe").alias("returned"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.date_format(shipped, "yyyy-MM-dd HH:mm:ss"), F.lit(" +0200")))
        .otherwise(F.unix_seconds(F.to_utc_timestamp(shipped, "UTC")).cast("string"))
        .alias("shipped"),
    )


CAST_SQL = {
    "integer": "CASE WHEN try_cast({c} AS DOUBLE) = floor(try_cast({c} AS DOUBLE)) THEN try_cast({c} AS DOUBLE)::BIGINT END",
    "float": "try_cast({c} AS DOUBLE)",
    "boolean": "CASE WHEN lower({c}) IN ('true','t','yes','1','1.0') THEN true WHEN lower({c}) IN ('false','f','no','0','0.0') THEN false END",
    "datetime": "CASE WHEN regexp_matches({c}, '^[0-9]+$') THEN {c}::BIGINT ELSE epoch(strptime({c}, '%Y-%m-%d %H:%M:%S %z'))::BIGINT END",
}


@query(f"WITH {UNTYPED} SELECT l_orderkey, l_linenumber, discount, {CAST_SQL['integer'].format(c='quantity')} AS quantity, "
       f"{CAST_SQL['integer'].format(c='discount')} AS whole_discount FROM untyped")
def cast_integer(spark, sf):
    return untyped(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "discount",
        typing.cast_integer("quantity").alias("quantity"),
        typing.cast_integer("discount").alias("whole_discount"),
    )


@query(f"WITH {UNTYPED} SELECT l_orderkey, l_linenumber, {CAST_SQL['float'].format(c='discount')} AS discount, "
       f"{CAST_SQL['float'].format(c='returned')} AS returned FROM untyped")
def cast_float(spark, sf):
    return untyped(spark, sf).select(
        "l_orderkey", "l_linenumber", typing.cast_float("discount").alias("discount"), typing.cast_float("returned").alias("returned")
    )


@query(f"WITH {UNTYPED} SELECT l_orderkey, l_linenumber, {CAST_SQL['boolean'].format(c='returned')} AS returned FROM untyped")
def cast_boolean(spark, sf):
    return untyped(spark, sf).select("l_orderkey", "l_linenumber", typing.cast_boolean("returned").alias("returned"))


@query("""
SELECT o_orderkey, epoch(date_trunc('day', o_orderdate))::BIGINT AS us, epoch(date_trunc('day', o_orderdate))::BIGINT AS named,
       (o_orderkey % 4000)::BIGINT AS seconds FROM orders
""")
def cast_datetime_patterns(spark, sf):
    """Dates in the American form, with a month's name, and small numbers of seconds."""
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("us"),
        F.date_format("o_orderdate", "MMM d yyyy").alias("named"),
        (F.col("o_orderkey") % 4000).cast("string").alias("seconds"),
    )
    patterns = ["MM/dd/yyyy", "MMM d yyyy"]
    return texts.select("o_orderkey", *[F.unix_seconds(typing.cast_datetime(c, patterns)).alias(c) for c in texts.columns[1:]])


@query(f"WITH {UNTYPED} SELECT l_orderkey, l_linenumber, {CAST_SQL['datetime'].format(c='shipped')} AS shipped FROM untyped")
def cast_datetime(spark, sf):
    return untyped(spark, sf).select(
        "l_orderkey", "l_linenumber", F.unix_seconds(typing.cast_datetime("shipped")).alias("shipped")
    )


OVERRIDES = [
    {"name": "quantity", "column_type": "integer"},
    {"name": "discount", "column_type": "float"},
    {"name": "returned", "column_type": "boolean"},
    {"name": "l_linenumber", "column_type": "string"},
]


@query(f"""
WITH {UNTYPED} SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  {CAST_SQL['integer'].format(c='quantity')} AS quantity, {CAST_SQL['float'].format(c='discount')} AS discount,
  {CAST_SQL['boolean'].format(c='returned')} AS returned, shipped FROM untyped
""")
def schema_overrides(spark, sf):
    return schema.apply_schema_overrides(untyped(spark, sf), OVERRIDES)


@query(f"""
WITH {UNTYPED}
SELECT 'quantity' AS column_name, 'integer' AS column_type, count(*) AS n_rows, count(*) FILTER (WHERE quantity IS NULL) AS n_null,
       count(*) FILTER (WHERE quantity IS NOT NULL AND {CAST_SQL['integer'].format(c='quantity')} IS NULL) AS n_invalid FROM untyped
UNION ALL SELECT 'discount', 'integer', count(*), count(*) FILTER (WHERE discount IS NULL),
       count(*) FILTER (WHERE discount IS NOT NULL AND {CAST_SQL['integer'].format(c='discount')} IS NULL) FROM untyped
UNION ALL SELECT 'returned', 'boolean', count(*), count(*) FILTER (WHERE returned IS NULL),
       count(*) FILTER (WHERE returned IS NOT NULL AND {CAST_SQL['boolean'].format(c='returned')} IS NULL) FROM untyped
UNION ALL SELECT 'shipped', 'datetime', count(*), count(*) FILTER (WHERE shipped IS NULL), 0 FROM untyped
""")
def type_conformity(spark, sf):
    legacy = {
        "quantity": {"data_type": "integer", "feature_type": "numeric"},
        "discount": {"data_type": "integer", "feature_type": "categorical"},
        "returned": {"data_type": "boolean", "feature_type": "boolean"},
        "shipped": {"data_type": "string", "feature_type": "datetime"},
    }
    return schema.type_conformity(untyped(spark, sf), legacy)


WORDS = """
spelled AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN 'None' WHEN 'click' THEN 'null' WHEN 'error' THEN ''
                   WHEN 'signup' THEN NULL ELSE event_type END AS word FROM events)
"""


@query(f"""
WITH {WORDS}
SELECT event_id, word IS NULL OR word IN ('None', 'none', 'null', 'NULL') AS is_missing, word IS NULL OR word = '' AS is_blank
FROM spelled
""")
def missing_tokens(spark, sf):
    kind = F.col("event_type")
    word = F.when(kind == "view", "None").when(kind == "click", "null").when(kind == "error", "")
    word = word.when(kind == "signup", F.lit(None)).otherwise(kind)
    df = table(spark, sf, "events").select("event_id", word.alias("word"))
    return df.select(
        "event_id", typing.is_missing(df, "word").alias("is_missing"), typing.is_blank(df, "word").alias("is_blank")
    )


def _profile(name: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({name}) AS n_null, "
        f"count(DISTINCT {name}) AS n_distinct, round(avg(length({name})), 6) AS avg_length FROM documents"
    )


@query(" UNION ALL ".join(_profile(c) for c in ("text", "lang", "source")))
def profile_columns(spark, sf):
    profile = schema.profile_columns(table(spark, sf, "documents"), ["text", "lang", "source"])
    return profile.withColumn("avg_length", rounded("avg_length"))


@query("""
SELECT count(*) AS n_classes, count(*) FILTER (WHERE n >= 5) AS n_large_classes, count(*) FILTER (WHERE n >= 5) >= 2 AS has_minimal_diversity
FROM (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source)
""")
def label_diversity(spark, sf):
    return schema.label_diversity(table(spark, sf, "documents"), "source")


LISTS = "lists AS (SELECT doc_id, CASE WHEN n_chars > 9000 THEN lang || ',' ELSE lang || ',' || source END AS labels FROM documents)"


def label_lists(spark, sf):
    short = F.concat("lang", F.lit(","))
    listed = F.when(F.col("n_chars") > 9000, short).otherwise(F.concat(short, "source"))
    return table(spark, sf, "documents").select("doc_id", listed.alias("labels"))


@query(f"""
WITH {LISTS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE len(list_filter(string_split(labels, ','), lambda i: trim(i) = '')) > 0) AS n_invalid,
  count(*) FILTER (WHERE len(list_filter(string_split(labels, ','), lambda i: trim(i) = '')) > 0) = 0 AS is_valid FROM lists
""")
def multilabel_validity(spark, sf):
    return schema.multilabel_validity(label_lists(spark, sf), "labels")


@query("""
SELECT 'source' AS label_column, 'multi-class' AS task, count(DISTINCT source) AS n_unique,
       CASE WHEN count(DISTINCT source) < 2 THEN 'fewer than 2 unique values' END AS problem FROM documents
""")
def validate_label_column(spark, sf):
    return schema.validate_label_column(table(spark, sf, "documents"), "source", "multi-class")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def select_features(spark, sf):
    return schema.select_features(table(spark, sf, "customer"), "c_mktsegment")


@query("SELECT text FROM documents")
def select_text_column(spark, sf):
    return schema.select_text_column(table(spark, sf, "documents"))


IDS = """
ids AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN md5(text)
    WHEN lang = 'de' THEN '{' || md5(text) || '}'
    WHEN lang = 'fr' THEN 'urn:uuid:' || substr(md5(text), 1, 8) || '-' || substr(md5(text), 9)
    ELSE md5(text) || 'f' END AS uid FROM documents)
"""


@query(f"WITH {IDS} SELECT doc_id, uid, lang <> 'es' AS well_formed FROM ids JOIN documents USING (doc_id)")
def uuid_check(spark, sf):
    digest, lang = F.md5("text"), F.col("lang")
    uid = (
        F.when(lang == "en", digest)
        .when(lang == "de", F.concat(F.lit("{"), digest, F.lit("}")))
        .when(lang == "fr", F.concat(F.lit("urn:uuid:"), F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 24)))
        .otherwise(F.concat(digest, F.lit("f")))
    )
    ids = table(spark, sf, "documents").select("doc_id", uid.alias("uid"))
    return ids.withColumn("well_formed", typing.well_formed_uuid("uid"))


@query("""
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS l_shipdate FROM lineitem
""")
def isoformat_temporal(spark, sf):
    return schema.isoformat_temporal(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END AS ts FROM events",
       name="isoformat_fractions")
def isoformat_fractions(spark, sf):
    return schema.isoformat_temporal(table(spark, sf, "events").select("event_id", "ts"))


@query("""
WITH files AS (SELECT page_id, url || '/photo' || CASE WHEN page_id < 100 THEN '.JPG' WHEN length(url) > 40 THEN '.png' ELSE '.gif' END AS path FROM pages)
SELECT page_id, CASE WHEN path LIKE '%.JPG' THEN '.jpeg' WHEN path LIKE '%.png' THEN '.png' END AS extension FROM files
""")
def image_extension(spark, sf):
    ending = F.when(F.col("page_id") < 100, ".JPG").when(F.char_length("url") > 40, ".png").otherwise(".gif")
    paths = table(spark, sf, "pages").select("page_id", F.concat("url", F.lit("/photo"), ending).alias("path"))
    return paths.select("page_id", typing.image_extension("path").alias("extension"))


@query("SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE, 6)) AS vector FROM embeddings")
def read_vectors(spark, sf):
    vectors = readers.read_vectors(table(spark, sf, "embeddings"), "vec_id", "embedding", "vector")
    return vectors.withColumn("vector", F.transform("vector", lambda v: F.round(v, 6)))


@query("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf):
    return readers.row_count(table(spark, sf, "lineitem"))


@query("""
WITH cells AS (
  SELECT unnest(['text', 'lang', 'source']) AS column_name, unnest([text, lang, source]) AS value FROM documents)
SELECT column_name, count(*) AS n_rows, (count(*) - count(value)) AS n_null, round(avg(length(value)), 6) AS avg_length,
       true AS distinct_is_close, true AS median_is_close
FROM cells GROUP BY column_name
""")
def profile_merged(spark, sf):
    """Profiles of each source's documents, stored and merged; estimates are held against exact counts."""
    docs = table(spark, sf, "documents")
    names = ["text", "lang", "source"]
    path = scratch(spark, "profiles")
    for remainder in range(3):
        part = docs.where(F.pmod("doc_id", F.lit(3)) == remainder)
        schema.profile_sketches(part, names).write.mode("append").parquet(path)
    merged = schema.read_sketches(schema.merge_sketches(spark.read.parquet(path)), [0.45, 0.55])
    exact = schema.profile_columns(docs, names).select(F.col("column_name").alias("of"), F.col("n_distinct").alias("exact"))
    lengths = docs.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.length(c).alias("n")) for c in names])))
    median = lengths.groupBy("c").agg(F.percentile("n", 0.5).alias("median"))
    both = merged.join(exact, F.col("column_name") == F.col("of")).join(median, F.col("column_name") == F.col("c"))
    low, high = F.get("length_quantiles", F.lit(0)), F.get("length_quantiles", F.lit(1))
    return both.select(
        "column_name", "n_rows", "n_null", rounded("avg_length").alias("avg_length"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("distinct_is_close"),
        F.col("median").between(low, high).alias("median_is_close"),
    )


# --- files: each table goes out through a writer and comes back through a reader ------------------


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def csv_round_trip(spark, sf):
    path = scratch(spark, "documents") + ".csv"
    writers.export_results_csv(table(spark, sf, "documents"), path)
    return readers.load_dataset(spark, path)


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_round_trip(spark, sf):
    path = scratch(spark, "conversations") + ".jsonl"
    writers.write_json_records(table(spark, sf, "conversations"), path)
    return readers.read_json_records(spark, path, lines=True, row_id=None).select("conv_id", "turn", "role", "text")


def _files_of(rows, per_file: int, key: str):
    """Rows dealt to files of at most ``per_file`` by their key: ``(part, key, json)``, json being a row's object."""
    part = F.floor(F.col(key) / per_file).alias("part")
    return rows.select(part, F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("json"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source, n_chars FROM documents")
def json_keyed(spark, sf):
    """Files of one object each, keyed by document, and back through variants."""
    path = scratch(spark, "keyed")
    entry = F.concat(F.to_json(F.array("key")).substr(F.lit(2), F.length(F.to_json(F.array("key"))) - 2), F.lit(":"), "json")
    files = _files_of(table(spark, sf, "documents").withColumn("id", F.lit("x")), 100, "doc_id").groupBy("part")
    whole = F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ",\n"), F.lit("}")).alias("value")
    files.agg(whole).write.partitionBy("part").text(path)
    back = readers.read_json_keyed(spark, path + "/*")
    return back.select("id", "text", "lang", "source", "n_chars")


@query("SELECT conv_id, turn, role, text, conv_id * 1000 + turn - min(conv_id * 1000 + turn) OVER (PARTITION BY conv_id) AS ahead FROM conversations")
def json_array_with_row_ids(spark, sf):
    """Files of one array each, a conversation in one; the row ids count on inside a file."""
    path = scratch(spark, "arrays")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.to_json(F.struct("*")).alias("json"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("turn", "json"))), lambda e: e["json"])
    value = F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("value")
    # The bytes are few, the files many: adaptive execution would let one task write them all.
    rows = rows.repartition(4 * spark.sparkContext.defaultParallelism, "conv_id")
    rows.groupBy(F.col("conv_id").alias("part")).agg(value).write.partitionBy("part").text(path)
    schema = "conv_id bigint, turn bigint, role string, text string"
    back = readers.read_json_records(spark, path + "/*", schema).withColumn("id", F.col("id").cast("bigint"))
    first = Window.partitionBy("conv_id")
    return back.select("conv_id", "turn", "role", "text", (F.col("id") - F.min("id").over(first)).alias("ahead"))


@query("SELECT doc_id, CASE WHEN quality = 0 THEN 'review' ELSE 'fine' END AS clean_label, quality::DOUBLE AS label_quality FROM labels")
def read_audit_columns(spark, sf):
    path = scratch(spark, "audit") + ".parquet"
    stored = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 0, "review").otherwise("fine").alias("clean_label"),
        F.col("quality").cast("double").alias("label_quality"),
        F.lit("x").alias("action"),
    )
    writers.write_results(stored, path)
    return readers.read_audit_columns(spark, path, "doc_id")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 1")
def load_table(spark, sf):
    """A table by the name of its connector and options."""
    found = readers.load_table(spark, "parquet", path=f"{sf}/customer.parquet")
    return found.where("c_custkey % 3 = 1").select("c_custkey", "c_mktsegment")
