"""Joining rows to per-group values when one group may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Any key outside the HOT_KEYS largest groups holds less than 1/HOT_KEYS of the rows, and the
# broadcast side never has more than HOT_KEYS rows, whatever the size of the data.
HOT_KEYS = 1000


def attach_group_values(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    size: str,
    spread_by: str,
    how: str = "left",
) -> DataFrame:
    """Left (or inner) join ``rows`` to ``groups`` on ``key`` without piling a hot group onto one task.

    ``groups`` has one row per key and its row count in ``size``. The largest groups are joined by a
    bounded broadcast, so their rows stay where they are; in the shuffle join that follows they carry
    a salt taken from ``spread_by`` (a row identifier), which matches nothing and spreads them evenly.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    values = [c for c in groups.columns if c != key]
    packed = groups.select(
        F.col(key).alias("__key"), F.col(size).alias("__size"), F.struct(*values).alias("__cold")
    )
    hot = (
        packed.orderBy(F.desc("__size"), F.asc("__key"))
        .limit(HOT_KEYS)
        .select(F.col("__key").alias("__hot_key"), F.col("__cold").alias("__hot"))
    )
    tagged = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot_key"), "left")
    salt = F.when(F.col("__hot_key").isNull() & F.col(key).isNotNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(spread_by), F.lit(1_000_003)) + 1
    )
    # Key and salt are one struct: as two equalities the constant salt of the cold side would be
    # turned into a plain condition, and the rows would be shuffled by the key alone.
    tagged = tagged.withColumn("__place", F.struct(F.col(key).alias("k"), salt.cast("int").alias("s")))
    cold = packed.select(
        F.struct(F.col("__key").alias("k"), F.lit(0).alias("s")).alias("__cold_place"), "__cold"
    )
    joined = tagged.join(cold, F.col("__place") == F.col("__cold_place"), "left")
    picked = F.coalesce(F.col("__hot"), F.col("__cold"))
    out = joined.select(*rows.columns, picked.alias("__picked"))
    if how == "inner":
        out = out.where(F.col("__picked").isNotNull())
    return out.select(*rows.columns, *[F.col("__picked")[v].alias(v) for v in values])
