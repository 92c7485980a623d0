"""Contiguous 0-based row positions without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import durable

_LOCAL_INDEX_BITS = 33  # layout of monotonically_increasing_id: partition above, row index below


def _offsets(df: DataFrame, group: str) -> DataFrame:
    """Running row offset per group; one small row per group passes the driver."""
    counts = sorted((r[group], r["n"]) for r in df.groupBy(group).agg(F.count("*").alias("n")).collect())
    starts = [0, *accumulate(n for _, n in counts)]
    rows = [(g, s) for (g, _), s in zip(counts, starts)]
    return df.sparkSession.createDataFrame(rows, f"{group} bigint, __offset bigint")


def _numbered(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Position = index within the partition + rows of all partitions before it."""
    local_mask = (1 << _LOCAL_INDEX_BITS) - 1
    tagged = df.withColumn("__mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("__part", F.shiftright("__mid", _LOCAL_INDEX_BITS))
    local = F.col("__mid").bitwiseAND(F.lit(local_mask))
    # A partition that was not counted fails the job; an inner join would drop its rows.
    start = F.coalesce("__offset", F.raise_error(F.lit("a partition changed between counting and numbering")))
    return tagged.join(F.broadcast(_offsets(tagged.select("__part"), "__part")), "__part", "left").select(
        *columns, (local + start.cast("bigint")).cast("bigint").alias(name)
    )


def with_row_position(
    df: DataFrame, name: str = "row_position", order_by: Sequence[str] | str | None = None
) -> DataFrame:
    """Add the 0-based position of each row as ``name``.

    The rows are kept in the checkpoint folder, so that counting and numbering see the same partitions,
    and numbered per partition. With ``order_by`` they are range-partitioned and sorted before; ties are
    ordered by a hash of the row, which also lets a frequent key span several partitions. Without it,
    the position follows the order of the partitions, for a file scan that of the files.
    """
    if order_by is None:
        return _numbered(durable(df), df.columns, name)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    ordered = df.withColumn("__tie", F.xxhash64(*df.columns))
    ordered = ordered.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie")
    return _numbered(durable(ordered.drop("__tie")), df.columns, name)
