"""Subsets, positions and column families."""

from pyspark.sql import functions as F

from winnowmill.operators import rows
from winnowmill.plans.positions import with_row_position

from .registry import DECISIONS, decisions, query, table


@query("SELECT doc_id, lang, row_number() OVER (ORDER BY source, doc_id) - 1 AS row_position FROM documents")
def row_position(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return with_row_position(docs, "row_position", ["source", "doc_id"]).drop("source")


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_position FROM lineitem")
def row_position_ranges(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = with_row_position(items, "row_position", keys)
    return out.select("l_orderkey", "l_linenumber", "row_position")


@query("SELECT min(p) AS first, max(p) AS last, count(DISTINCT p) AS n FROM (SELECT row_number() OVER () - 1 AS p FROM lineitem)")
def row_position_file_order(spark, sf):
    numbered = with_row_position(table(spark, sf, "lineitem").select("l_orderkey"), "p")
    return numbered.agg(F.min("p").alias("first"), F.max("p").alias("last"), F.countDistinct("p").alias("n"))


@query("""
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS p FROM documents)
WHERE p >= 20 AND p < 150
""")
def positional_subset(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rows.positional_subset(docs, (20, 150), ["n_chars", "doc_id"]).drop("n_chars")


@query("""
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS p,
  count(*) OVER () AS n FROM documents) WHERE p IN (7, 3, 150) OR p = n - 1
""")
def positional_list(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return rows.positional_subset(docs, [7, 3, -1, 150], ["n_chars", "doc_id"]).drop("n_chars")


@query("SELECT doc_id - 1 AS doc_id, quality, toxic FROM labels")
def shift_row_id(spark, sf):
    return rows.shift_row_id(table(spark, sf, "labels"), "doc_id")


@query("SELECT doc_id, CASE WHEN quality = 0 THEN 'review' ELSE 'fine' END AS clean_label, quality::DOUBLE AS label_quality, toxic = 1 AS is_outlier FROM labels")
def select_audit_columns(spark, sf):
    audit = table(spark, sf, "labels").select(
        "toxic",
        F.when(F.col("toxic") == 1, "exclude").alias("action"),
        (F.col("toxic") == 1).alias("is_outlier"),
        F.col("quality").cast("double").alias("label_quality"),
        F.when(F.col("quality") == 0, "review").otherwise("fine").alias("clean_label"),
        "doc_id",
    )
    return rows.select_audit_columns(audit, "doc_id")


@query(f"WITH {DECISIONS} SELECT doc_id, corrected_label FROM decisions")
def drop_action(spark, sf):
    return rows.drop_action(decisions(spark, sf))


@query(f"WITH {DECISIONS} SELECT * FROM decisions WHERE action IS NULL OR action <> 'exclude'")
def filter_excluded(spark, sf):
    return rows.filter_excluded(decisions(spark, sf))


@query(f"WITH {DECISIONS} SELECT * FROM decisions ORDER BY doc_id")
def sort_by_id(spark, sf):
    return rows.sort_by_id(decisions(spark, sf), "doc_id")


@query("""
SELECT count(*) AS n, 0::BIGINT AS low, count(*) - 1 AS high, count(*) AS distinct_positions,
       sum(n_chars)::BIGINT AS payload FROM documents
""")
def row_position_shuffled(spark, sf):
    """Positions of a table that has just been shuffled: contiguous, and no row is lost."""
    shuffled = table(spark, sf, "documents").repartition("lang", "source")
    out = with_row_position(shuffled, "p")
    return out.agg(
        F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high"),
        F.count_distinct("p").alias("distinct_positions"), F.sum("n_chars").alias("payload"),
    )


@query("SELECT doc_id, lang FROM documents ORDER BY md5(doc_id::VARCHAR || '4'), doc_id LIMIT 3")
def preview_sample(spark, sf):
    return rows.preview_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", seed=4)


@query("SELECT doc_id, 'a' AS topic, 0.5::DOUBLE AS topic_trustworthiness_score, lang AS kept_raw FROM documents")
def drop_details(spark, sf):
    wide = table(spark, sf, "documents").select(
        "doc_id",
        F.lit("a").alias("topic"),
        F.lit(0.5).alias("topic_trustworthiness_score"),
        F.col("text").alias("topic_raw"),
        F.col("source").alias("topic_log"),
        F.col("lang").alias("kept_raw"),
    )
    return rows.drop_detail_columns(wide)
