"""A self-join inside keys that may be hot: rows meet in bounded blocks, and only links leave a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512  # rows of a key that meet as many others in one task
LEAST = 8  # of its keys a row carries the first ones, so that a pair is compared under one key only
NEVER = np.iinfo(np.int64).max  # fills the lists of rows with fewer keys
_FIRST = [f"t{i}" for i in range(LEAST)]


def beside_leaders(members: DataFrame) -> DataFrame:
    """Members ``(key, node)`` beside the smallest node of their key, each pair once, BLOCK of them in a place."""
    leaders = members.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("rows")).where("rows > 1")
    led = members.join(leaders, "key").where("node <> leader").select("leader", "node").distinct()
    blocks = led.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    others = led.join(blocks, "leader").withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")))
    heads = blocks.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    place = F.xxhash64("leader", "i").alias("place")
    rows = others.select(place, "node", F.lit(False).alias("minor")).unionByName(
        heads.select(place, F.col("leader").alias("node"), F.lit(True).alias("minor"))
    )
    zero = F.lit(0).cast("bigint")
    return rows.withColumns({"part": F.col("node"), "major": zero, "key": zero} | {t: F.lit(int(NEVER)) for t in _FIRST})


def across_parts(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members ``(key, node)`` of keys that hold several parts ``(node, component)``, in places of BLOCK by BLOCK rows.

    Those outside the largest part of their key, its minor rows, come beside all others.
    """
    placed = members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("rows"))
    mixed = sizes.groupBy("key").agg(
        F.max_by("part", F.struct("rows", "part")).alias("major"), F.sum("rows").alias("all_rows"), F.max("rows").alias("most")
    )
    placed = placed.join(mixed.where("all_rows > most"), "key")
    least = placed.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("key")), 1, LEAST).alias("least"))
    first = [F.coalesce(F.get("least", F.lit(i)), F.lit(int(NEVER))).alias(t) for i, t in enumerate(_FIRST)]
    placed = placed.join(least.select("node", *first), "node")
    own, steps = F.xxhash64("node"), lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    blocks, minors = F.ceil(F.col("all_rows") / BLOCK), F.ceil((F.col("all_rows") - F.col("most")) / BLOCK)
    one = placed.withColumn("minor", F.lit(False)).withColumn("i", F.pmod(own, blocks)).withColumn("j", steps(minors))
    two = placed.where("part <> major").withColumn("minor", F.lit(True))
    two = two.withColumn("j", F.pmod(own, minors)).withColumn("i", steps(blocks))
    return one.unionByName(two).select(F.xxhash64("key", "i", "j").alias("place"), "node", "minor", "part", "major", "key", *_FIRST)


def runs(batches: Iterator[pa.RecordBatch], rows_at_once: int = 2 * BLOCK) -> Iterator[pa.Table]:
    """Whole places of rows sorted by ``place``, as many together as the largest place may have rows."""
    waiting = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        place = rows.column("place").to_numpy()
        last = int(np.searchsorted(place, place[-1])) if len(place) else 0
        at = 0
        while at < last:
            end = int(np.searchsorted(place, place[min(at + rows_at_once, last - 1)], side="right"))
            yield rows.slice(at, end - at)
            at = end
        waiting = rows.slice(last)
    if waiting is not None and len(waiting):
        yield waiting


def first_meeting(own: np.ndarray, others: np.ndarray, key: int) -> np.ndarray:
    """Whether ``key`` may be the first one in common, by the lists of first keys (LEAST of each row).

    A common key up to the end of both lists is in both. Where there is none, any later one may be the first.
    """
    common = np.where(np.isin(others, own), others, NEVER).min(axis=1)
    known = (common != NEVER) & (common <= np.minimum(others[:, -1], own[-1]))
    return ~known | (common == key)


def meetings(rows: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """For each minor row of each place, the other rows of the place that it is to be compared with."""
    get = {c: rows.column(c).to_numpy() for c in ("place", "minor", "node", "part", "major", "key")}
    first = np.stack([rows.column(t).to_numpy() for t in _FIRST], axis=1)
    starts = np.searchsorted(get["place"], get["place"])
    others = np.cumsum(~get["minor"])  # others of a place stand before its minor rows
    ends = others - np.where(starts > 0, others[starts - 1], 0) + starts
    for p in np.flatnonzero(get["minor"]):
        q = np.arange(starts[p], ends[p])
        q = q[(get["part"][q] != get["part"][p]) & ((get["part"][q] == get["major"][p]) | (get["node"][p] < get["node"][q]))]
        if len(q):
            q = q[first_meeting(first[p], first[q], get["key"][p])]
        if len(q):
            yield int(p), q


def links(
    dealt: DataFrame, values: DataFrame, linked: Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]
) -> DataFrame:
    """Links ``(a, b)``, a < b, between dealt rows; ``values`` has one row per node.

    ``linked`` gets the rows of a run, with their values, and returns the test of one row against some others.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches):
            node, test, pairs = rows.column("node").to_numpy(), linked(rows), []
            for p, q in meetings(rows):
                q = q[test(p, q)]
                pairs.append(np.stack([np.minimum(node[p], node[q]), np.maximum(node[p], node[q])]))
            if pairs:
                a, b = np.concatenate(pairs, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return _placed(dealt, values).mapInArrow(scan, "a bigint, b bigint").distinct()


def _placed(dealt: DataFrame, values: DataFrame) -> DataFrame:
    """Dealt rows with their values, each place whole and in order."""
    return dealt.join(values, "node").repartition("place").sortWithinPartitions("place", "minor")


def likely(
    dealt: DataFrame, values: DataFrame, maybe: Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]
) -> DataFrame:
    """The dealt rows that have a possible partner in their place, for ``links`` with larger values.

    ``maybe`` is as ``linked`` of ``links``, a necessary condition on small values. A pair that meets it keeps both of its rows.
    """
    names = dealt.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches):
            kept, test = np.zeros(len(rows), bool), maybe(rows)
            for p, q in meetings(rows):
                q = q[test(p, q)]
                kept[q] = True
                kept[p] |= len(q) > 0
            if kept.any():
                yield from rows.select(names).filter(pa.array(kept)).combine_chunks().to_batches()

    return _placed(dealt, values).mapInArrow(scan, ", ".join(f"{n} {kind}" for n, kind in dealt.dtypes))
