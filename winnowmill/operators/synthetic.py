"""How a synthetic dataset compares with the real one it imitates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import attach_group_values

CLASS_NAMES = ("synthetic", "real")


def example_counts(df: DataFrame, col: str = "real_or_synthetic", names: tuple[str, str] = CLASS_NAMES) -> DataFrame:
    """One row: real rows, and all remaining rows as synthetic."""
    n_real = F.count_if(F.col(col) == names[1])
    return df.agg(n_real.alias("n_real"), (F.count("*") - n_real).alias("n_synthetic"))


def two_class_check(df: DataFrame, col: str = "real_or_synthetic") -> DataFrame:
    """One row: number of distinct values, null counted as a value, and whether there are exactly two."""
    return (
        df.groupBy(col)
        .agg(F.count("*").alias("n"))
        .agg(F.count("*").alias("n_values"))
        .withColumn("has_two_classes", F.col("n_values") == 2)
    )


def score_synthetic_dataset(
    df: DataFrame,
    col: str = "real_or_synthetic",
    names: tuple[str, str] = CLASS_NAMES,
    check: bool = True,
) -> DataFrame:
    """One row with the four scores and the two counts.

    unrealistic, unrepresentative: 1 - mean label issue score of the synthetic, of the real rows.
    unvaried, unoriginal: share of synthetic rows in a near-duplicate cluster without, with a real row.

    The rows shuffle once, as partial sums per cluster; everything outside a cluster is one group of
    partial sums. With ``check``, classes other than exactly the two names fail the query.
    """
    synthetic, real = names
    is_synthetic = F.coalesce(F.col(col) == synthetic, F.lit(False))
    is_real = F.coalesce(F.col(col) == real, F.lit(False))
    near = F.coalesce(F.col("is_near_duplicate"), F.lit(False)) & F.col("near_duplicate_cluster_id").isNotNull()
    score = F.col("label_issue_score").cast("double")
    clusters = (
        df.select(
            F.when(near, F.col("near_duplicate_cluster_id")).alias("cluster"),
            is_synthetic.alias("s"),
            is_real.alias("r"),
            score.alias("score"),
        )
        .groupBy("cluster")
        .agg(
            F.count("*").alias("n"),
            F.count_if("s").alias("n_s"),
            F.count_if("r").alias("n_r"),
            F.sum(F.when(F.col("s"), F.col("score"))).alias("sum_s"),
            F.count(F.when(F.col("s"), F.col("score"))).alias("scored_s"),
            F.sum(F.when(F.col("r"), F.col("score"))).alias("sum_r"),
            F.count(F.when(F.col("r"), F.col("score"))).alias("scored_r"),
        )
    )
    in_cluster = F.col("cluster").isNotNull()
    totals = clusters.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("n_s"), F.lit(0)).alias("n_s"),
        F.coalesce(F.sum("n_r"), F.lit(0)).alias("n_r"),
        F.try_divide(F.sum("sum_s"), F.sum("scored_s")).alias("mean_s"),
        F.try_divide(F.sum("sum_r"), F.sum("scored_r")).alias("mean_r"),
        F.count_if(in_cluster).alias("n_clusters"),
        F.coalesce(F.sum(F.when(in_cluster & (F.col("n_r") == 0), F.col("n_s"))), F.lit(0)).alias("alone"),
        F.coalesce(F.sum(F.when(in_cluster & (F.col("n_r") > 0), F.col("n_s"))), F.lit(0)).alias("mixed"),
    )

    def share(count: str):
        return F.when(F.col("n_clusters") == 0, F.lit(0.0)).otherwise(
            F.try_divide(F.col(count).cast("double"), F.col("n_s"))
        )

    if check:
        two = (F.col("n_s") > 0) & (F.col("n_r") > 0) & (F.col("n_s") + F.col("n_r") == F.col("n"))
        message = f"column {col} must hold exactly the two classes {synthetic!r} and {real!r}"
        totals = totals.withColumn(
            "n", F.when(two, F.col("n")).otherwise(F.raise_error(F.lit(message)).cast("bigint"))
        )
    return totals.select(
        (1 - F.col("mean_s")).alias("unrealistic"),
        (1 - F.col("mean_r")).alias("unrepresentative"),
        share("alone").alias("unvaried"),
        share("mixed").alias("unoriginal"),
        F.col("n_r").alias("n_real"),
        (F.col("n") - F.col("n_r")).alias("n_synthetic"),
    )


def cluster_contains_other(
    df: DataFrame,
    id_col: str,
    target: str = CLASS_NAMES[0],
    col: str = "real_or_synthetic",
    contains: bool = True,
) -> DataFrame:
    """Near-duplicate rows of class ``target`` whose cluster holds (or not) a row of another class."""
    near = df.where(F.col("is_near_duplicate") & F.col("near_duplicate_cluster_id").isNotNull())
    other = F.coalesce(F.col(col) != target, F.lit(False))
    clusters = near.groupBy("near_duplicate_cluster_id").agg(
        F.count("*").alias("__n"), F.bool_or(other).alias("__has_other")
    )
    rows = near.where(F.col(col) == target)
    flagged = attach_group_values(rows, clusters, "near_duplicate_cluster_id", "__n", id_col)
    return flagged.where(F.col("__has_other") == contains).select(*df.columns)
