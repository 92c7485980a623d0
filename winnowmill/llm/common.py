"""Helpers shared by the operators: words of byte strings, hashed words, stages in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import ensure_checkpoint_dir

SPACE_CLASS = r"[\x20\x09-\x0D]"
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier, the golden ratio in 64 bits


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which the driver and all executors reach."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there: lineage ends, lost executors cost nothing."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front until no column is called so (letter case does not count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """The column of exactly this name, also if it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, names: list[str]) -> Column:
    """The columns of these names as one struct, so that their names can be any in Arrow functions."""
    return (F.struct(*[col(n) for n in names]) if names else F.struct(F.lit(0))).alias("row")


def unpacked(names: list[str]) -> list[Column]:
    """The columns that ``packed`` put into ``row``."""
    return [F.col("row").getField(n).alias(n) for n in names]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where lambdas inside ``body`` refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _marked(rows: DataFrame, key: Column, wanted: DataFrame, words: int) -> DataFrame:
    """``(row, maybe)``: all columns of ``rows`` as one, and whether the key may be in the first column of ``wanted``.

    A bit array of the wanted keys, ``words`` rows of 64 bits and so of a fixed size, is broadcast.
    """
    hashed = wanted.toDF("key").select(F.xxhash64("key").alias("h"))
    word, bit = lambda h: F.pmod(F.shiftright(h, 6), F.lit(words)), lambda h: h.bitwiseAND(63).cast("int")
    # Shifting by a column is an SQL function only.
    table = hashed.select(word(F.col("h")).alias("word"), bit(F.col("h")).alias("bit")).groupBy("word")
    table = table.agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).withColumnRenamed("word", "of_word")
    marked = rows.select(packed(rows, rows.columns), F.xxhash64(key).alias("h"))
    marked = marked.select("row", word(F.col("h")).alias("word"), bit(F.col("h")).alias("bit"))
    marked = marked.join(F.broadcast(table), F.col("word") == F.col("of_word"), "left")
    return marked.select("row", F.coalesce(F.expr("shiftright(bits, bit) & 1L = 1L"), F.lit(False)).alias("maybe"))


def likely_in(rows: DataFrame, key: Column, wanted: DataFrame, words: int = 1 << 18) -> DataFrame:
    """Rows whose key may be wanted: none that is goes missing, few others stay for an exact join to shuffle.

    Columns of any name stay as they are.
    """
    return _marked(rows, key, wanted, words).where("maybe").select(*unpacked(rows.columns))


def without(rows: DataFrame, name: str, gone: DataFrame, words: int = 1 << 18) -> DataFrame:
    """Rows whose column ``name`` is not in the one column of ``gone``; null is in none.

    Only rows whose key may be gone are shuffled for the exact anti-join. Columns of any name stay as they are.
    """
    marked = _marked(rows, col(name), gone, words)
    own = F.col("row").getField(name)
    checked = marked.where("maybe").join(gone.toDF("gone_key"), own == F.col("gone_key"), "left_anti")
    return marked.where("NOT maybe").unionByName(checked).select(*unpacked(rows.columns))


def pieces(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[tuple[int, list]]:
    """Runs of values of a binary column, about ``limit`` bytes each: (first row, values). No row is left out."""
    values = batch.column(column)
    start, size = 0, 0
    for row in range(len(values)):
        value = values[row]
        size += value.as_buffer().size if value.is_valid else 0
        if size >= limit:
            yield start, values.slice(start, row + 1 - start).to_pylist()
            start, size = row + 1, 0
    if start < len(values):
        yield start, values.slice(start).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words. Remembers up to ``LIMIT`` words and then starts anew, so memory is bounded."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def scrambled(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits (products wrap)."""
    values = (values ^ (values >> np.uint64(32))) * MIX
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))
