"""Positions, skew-safe joins, components and lineage cuts."""

import random

import pytest
from pyspark.sql import functions as F

from winnowmill.plans import skew
from winnowmill.plans.components import connected_components
from winnowmill.plans.lineage import durable
from winnowmill.plans.positions import with_row_position


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_positions_follow_the_order_and_are_contiguous(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 3).alias("g")).repartition(7)
    rows = with_row_position(df, "p", ["g", "k"]).orderBy("p").collect()
    assert [r.p for r in rows] == list(range(1000))
    assert [(r.g, r.k) for r in rows] == sorted((r.g, r.k) for r in rows)


def test_positions_with_one_value_in_the_order_column_use_several_partitions(spark):
    df = spark.range(20_000).withColumn("same", F.lit(1)).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_row_position(df, "p", "same")
        assert out.select(F.spark_partition_id()).distinct().count() > 1
        assert out.agg(F.min("p"), F.max("p"), F.countDistinct("p")).first() == (0, 19_999, 20_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_positions_need_no_single_partition_exchange(spark):
    out = with_row_position(spark.range(100).repartition(3), "p")
    assert "SinglePartition" not in plan(out)
    assert out.agg(F.countDistinct("p"), F.max("p")).first() == (100, 99)


def test_group_values_reach_hot_cold_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") < 1500, "hot").when(F.col("id") < 2900, F.concat(F.lit("k"), (F.col("id") % 200))).alias("key")
    )
    groups = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    out = skew.attach_group_values(rows, groups, "key", "n", "id")
    expected = rows.join(groups, "key", "left").select("id", "key", "n", "low")
    assert out.count() == 3000
    assert out.select("id", "key", "n", "low").exceptAll(expected).count() == 0
    inner = skew.attach_group_values(rows, groups.where("n < 1000"), "key", "n", "id", how="inner")
    assert inner.count() == 1400


@pytest.mark.parametrize("hot", ["text", None])
def test_hot_and_null_keys_spread_over_the_shuffle(spark, hot):
    key = F.when(F.col("id") % 3 > 0, F.lit(hot)).otherwise(F.col("id").cast("string"))
    rows = durable(spark.range(24_000).select("id", key.alias("key")))
    groups = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = skew.attach_group_values(rows, groups, "key", "n", "id")
        assert "SortMergeJoin [__place" in out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.where("n = 16000").count() == (16_000 if hot else 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 24_000 and max(sizes) < 4_000


def _components(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


def test_components_of_random_graphs_chains_and_stars(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    pairs = [p for p in pairs if p[0] != p[1]]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert got == _components(pairs)


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_durable_cuts_lineage(spark):
    kept = durable(spark.range(10).withColumn("x", F.col("id") * 2))
    assert "ExistingRDD" in plan(kept) and kept.count() == 10


def test_positions_of_a_shuffled_input_lose_no_row(spark):
    """Wide rows after a shuffle: counting a pruned plan once dropped whole partitions."""
    df = spark.range(60_000).select("id", F.repeat(F.lit("x"), 300).alias("wide"), (F.col("id") % 97).alias("k"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        got = with_row_position(df.repartition("k"), "p")
        row = got.agg(F.count("*"), F.min("p"), F.max("p"), F.count_distinct("p"), F.sum("id")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert tuple(row) == (60_000, 0, 59_999, 60_000, 60_000 * 59_999 // 2)
