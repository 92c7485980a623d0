"""Progress and history of jobs; a user's events are one job, an order is one job of its customer."""

from pyspark.sql import functions as F

from winnowmill.operators import jobs

from .registry import query, rounded, table


@query("""
WITH s AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN value END AS score FROM events)
SELECT user_id, count(*) AS num_rows, count(score) AS processed_rows, round(avg(score), 6) AS average_trustworthiness_score,
  CASE WHEN count(score) = 0 THEN 'CREATED' WHEN count(score) < count(*) THEN 'RUNNING' ELSE 'SUCCEEDED' END AS status
FROM s GROUP BY user_id
""")
def job_progress(spark, sf):
    scored = table(spark, sf, "events").select(
        "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("score")
    )
    return jobs.job_progress(scored, "score", "user_id").withColumn(
        "average_trustworthiness_score", rounded("average_trustworthiness_score")
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS score
FROM orders WHERE o_orderstatus <> 'P' ORDER BY o_orderdate
""")
def score_history(spark, sf):
    history = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("score")
    )
    return jobs.score_history(history, "o_orderdate", "score")


@query("""
SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ready' WHEN 'O' THEN 'not ready' ELSE 'error: paused' END AS readiness
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_job(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("PAUSED")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", status.alias("status"))
    latest = jobs.latest_job(orders, "o_custkey", "o_orderdate", "o_orderkey")
    return latest.select("o_custkey", "o_orderkey", jobs.readiness("status", F.lit("ENRICHMENT")).alias("readiness"))
