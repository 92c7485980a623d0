"""Two-pass external shuffle into shards: seeded scatter into memory-sized buckets, Fisher-Yates inside each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import col, packed, scratch_folder, unpacked, unused

BUCKET_BYTES = 32 << 20
#: Bound of the table of buckets, which is broadcast (16 MB); beyond it buckets grow.
MAX_BUCKETS = 1 << 20


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard of a key: the one whose hash with the key is highest.

    A further shard changes only the keys whose highest hash is its own, and these move into it.
    """
    weights = F.array(*[F.struct(F.xxhash64(F.lit(seed), F.lit(s), key), F.lit(s).alias("s")) for s in range(shards)])
    return F.array_max(weights)["s"]


def _shuffled(seed: int):
    """Rows of one bucket in random order: sorted by content, then permuted by Fisher-Yates."""

    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        # Rows with the same hash are copies of one row, so what is written does not depend on arrival.
        by = np.argsort(rows.column("order").to_numpy(), kind="stable")
        name = f"{seed}/{key[0].as_py()}/{key[1].as_py()}"
        random = np.random.default_rng(xxhash.xxh3_64_intdigest(name.encode()))
        partner = random.integers(0, np.arange(1, len(by) + 1))
        for i in range(len(by) - 1, 0, -1):
            j = partner[i]
            by[i], by[j] = by[j], by[i]
        out = rows.select(["row", "shard", "bucket", "part"]).take(pa.array(by))
        return out.append_column("place", pa.array(np.arange(len(by), dtype=np.int64)))

    return shuffle


def shard(
    docs: DataFrame,
    key_col: str = "doc_id",
    size_col: str = "text",
    shards: int = 8,
    seed: int = 1,
    bucket_bytes: int = BUCKET_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """All columns of ``docs`` plus ``shard`` and ``slot`` (gapless from 0 in each shard), read back from files.

    The law is the key: ``key_col`` and the number of shards decide a row's shard, and one more shard
    takes rows only into itself. Inside a shard the order is random and depends on the rows and ``seed``
    only.

    Pass one sums the bytes of ``size_col``, which gives the number of buckets, and the bytes of each
    bucket. A bucket is a hash of the whole row, so a key that fills a third of the table is dealt over
    all buckets of its shard; a bucket that is still too large can only hold copies of one row, and is
    dealt into parts by the rows' numbers, which cannot be seen afterwards. Pass two scatters the rows,
    permutes each bucket in memory and writes it below ``folder`` (a new one in the shared folder
    if None), partitioned by shard. Places are then turned into slots by the buckets' row counts.

    Rows with a null key are one key. Rows are neither dropped nor merged; equal rows and keys are kept.
    An empty table gives an empty result. Columns called ``shard`` or ``slot`` are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    bucket, part, place = (unused(docs, f"__{n}") for n in ("bucket", "part", "place"))
    size = F.coalesce(F.octet_length(col(size_col).cast("string")), F.lit(0)) + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    per_shard = int(min(max(1, -(-total // (shards * bucket_bytes))), MAX_BUCKETS // shards))
    rows = docs.select(
        packed(docs, kept),
        F.monotonically_increasing_id().alias("number"),
        size.alias("bytes"),
        F.xxhash64(F.lit(seed), *[_hashable(docs, c) for c in kept]).alias("order"),
        shard_of(col(key_col), shards, seed).alias("shard"),
    )
    # The order inside a bucket is that of the hash; the bucket is a remix of it.
    spread = F.pmod(F.xxhash64("order"), F.lit(per_shard)).cast("int")
    rows = rows.withColumn("bucket", F.col("shard") * per_shard + spread)
    heavy = rows.groupBy("bucket").agg(F.sum("bytes").alias("all")).where(F.col("all") > 4 * bucket_bytes)
    # At most one row per bucket, so never more than MAX_BUCKETS.
    heavy = F.broadcast(heavy.select(F.col("bucket").alias("b"), F.ceil(F.col("all") / bucket_bytes).alias("n")))
    dealt = F.coalesce(F.pmod(F.xxhash64("number"), F.col("n")), F.lit(0)).cast("int")
    rows = rows.join(heavy, F.col("bucket") == F.col("b"), "left").withColumn("part", dealt)
    rows = rows.select("row", "shard", "bucket", "part", "order")
    numbers = [StructField(n, IntegerType()) for n in ("shard", "bucket", "part")]
    schema = StructType([rows.schema["row"], *numbers, StructField("place", LongType())])
    shuffled = rows.groupBy("bucket", "part").applyInArrow(_shuffled(seed), schema).select(
        *unpacked(kept), "shard", F.col("bucket").alias(bucket), F.col("part").alias(part), F.col("place").alias(place)
    )
    folder = folder or scratch_folder(spark, "shards")
    shuffled.write.partitionBy("shard").parquet(folder)
    written = spark.read.schema(shuffled.schema).parquet(folder)
    counts = written.groupBy("shard", bucket, part).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy(bucket, part).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("rows").over(before), F.lit(0))
    offsets = counts.select(F.col(bucket).alias("b"), F.col(part).alias("p"), offset.alias("offset"))
    placed = written.join(F.broadcast(offsets), (F.col(bucket) == F.col("b")) & (F.col(part) == F.col("p")))
    slot = F.col("offset") + F.col(place)
    return placed.select(*[col(c) for c in kept], "shard", slot.cast("bigint").alias("slot"))


def _hashable(docs: DataFrame, name: str) -> Column:
    kind = docs.schema[name].dataType.simpleString()
    return F.to_json(F.struct(col(name))) if "map<" in kind or "variant" in kind else col(name)
