"""WARC records, and a Merkle audit that finds damage between replicas of an archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Bytes of a lowest offset range. A record has a header of over 100 bytes, so few begin in one.
RANGE_BYTES = 64 << 10
FAN_OUT = 16
FILE_BYTES = 64 << 20


def warc_record(url: Column, identifier: Column, date: Column, body: Column) -> Column:
    """A WARC/1.0 resource record as bytes: header, an empty line, the body, two line ends."""
    body = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:"), F.coalesce(identifier, F.lit("")),
        F.lit(">\r\nWARC-Date: "), date, F.lit("\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def laid_out(records: DataFrame, key_col: str, length_col: str, files: int) -> DataFrame:
    """``records`` plus ``file`` and ``offset``: keys are dealt over ``files`` files and follow one another.

    Equal keys are ordered by length; a null key counts as 0.
    """
    key = F.coalesce(F.col(key_col), F.lit(0))
    placed = records.withColumn("file", F.pmod(key, F.lit(files)).cast("int"))
    order = Window.partitionBy("file").orderBy(F.col(key_col), length_col)
    before = F.sum(length_col).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(before, F.lit(0)).cast("bigint"))


def leaves(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``(file, offset, length, digest)`` of records at ``(file, offset)``; a null record is an empty one.

    Records that claim the same place are one leaf: the digest of their sorted digests.
    """
    data = F.coalesce(F.col(record_col), F.lit("").cast("binary"))
    hashed = records.select("file", "offset", F.octet_length(data).cast("bigint").alias("length"), F.sha2(data, 256).alias("digest"))
    return hashed.groupBy("file", "offset").agg(
        F.sum("length").alias("length"),
        F.when(F.count("*") == 1, F.min("digest"))
        .otherwise(F.sha2(F.array_join(F.sort_array(F.collect_list("digest")), "").cast("binary"), 256))
        .alias("digest"),
    )


def _above(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes over ``width`` neighbouring ranges: the hash of the children's numbers and digests in order."""
    child = F.struct("range", "digest")
    text = F.array_join(
        F.transform(F.sort_array(F.collect_list(child)), lambda c: F.concat_ws(":", c["range"], c["digest"])), "\n"
    )
    return nodes.groupBy("file", F.floor(F.col("range") / width).cast("bigint").alias("parent")).agg(
        F.sha2(text.cast("binary"), 256).alias("digest")
    ).select("file", F.col("parent").alias("range"), "digest")


def tree(leaf_rows: DataFrame, levels: int) -> list[DataFrame]:
    """Levels of one tree per file, lowest first: records by offset, ranges of RANGE_BYTES, FAN_OUT of these, ..."""
    nodes = leaf_rows.select("file", F.col("offset").alias("range"), F.concat_ws("/", "digest", "length").alias("digest"))
    out = [nodes]
    for level in range(levels):
        nodes = stored(_above(nodes, RANGE_BYTES if level == 0 else FAN_OUT), "warc-tree")
        out.append(nodes)
    return out


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes ``(file, range)`` whose digests differ, or that only one side has."""
    a = left.select(F.col("file").alias("fa"), F.col("range").alias("ra"), F.col("digest").alias("da"))
    b = right.select(F.col("file").alias("fb"), F.col("range").alias("rb"), F.col("digest").alias("db"))
    both = a.join(b, (F.col("fa") == F.col("fb")) & (F.col("ra") == F.col("rb")), "full")
    return both.where(~F.col("da").eqNullSafe(F.col("db"))).select(
        F.coalesce("fa", "fb").alias("file"), F.coalesce("ra", "rb").alias("range")
    )


def audit(kept: DataFrame, replica: DataFrame, record_col: str = "record") -> DataFrame:
    """``(file, offset, status, kept_length, replica_length, kept_digest, replica_digest)`` of damaged records.

    Both tables hold ``(file, offset, record)``. Records are hashed, then ordered offset ranges, up to a
    root per file. The roots of both replicas are compared, and below a node that differs its children,
    level by level, down to the records: ``corrupt`` if both have one, ``missing`` or ``extra`` if the
    replica has none or only the replica has one. Undamaged branches are not looked at again.

    Hashes are made in one pass over each replica, and only digests are shuffled. A node has at most
    FAN_OUT children, a lowest range those records that begin in it, so no file or table is ever in one
    place. Nulls in ``file`` or ``offset`` count as 0. Empty tables are fine on either side.
    """
    at = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("file", "offset")]
    sides = [
        stored(leaves(t.select(*at, F.col(record_col).alias("record"))), "warc-leaves") for t in (kept, replica)
    ]
    last = max((side.agg(F.max("offset")).first()[0] or 0) for side in sides)
    levels, width = 1, RANGE_BYTES
    while last // width:  # until one range covers a file
        levels, width = levels + 1, width * FAN_OUT
    left, right = (tree(side, levels) for side in sides)
    differing = _differing(left[-1], right[-1])
    for level in range(levels - 1, -1, -1):
        span = RANGE_BYTES if level == 0 else FAN_OUT
        parents = stored(differing, "warc-differing").select(F.col("file").alias("pf"), F.col("range").alias("pr"))
        below = [
            nodes.join(
                parents, (F.col("file") == F.col("pf")) & (F.floor(F.col("range") / span) == F.col("pr")), "left_semi"
            )
            for nodes in (left[level], right[level])
        ]
        differing = _differing(*below)
    places = stored(differing, "warc-differing").withColumnRenamed("range", "offset")
    named = [
        side.select("file", "offset", F.col("length").alias(f"{n}_length"), F.col("digest").alias(f"{n}_digest"))
        for n, side in zip(("kept", "replica"), sides)
    ]
    rows = places.join(named[0], ["file", "offset"], "left").join(named[1], ["file", "offset"], "left")
    status = F.when(F.col("replica_digest").isNull(), "missing").when(F.col("kept_digest").isNull(), "extra")
    return rows.select(
        "file", "offset", status.otherwise("corrupt").alias("status"), "kept_length", "replica_length",
        "kept_digest", "replica_digest",
    )
