"""Connected components: contraction inside each task, then parents and pointer jumps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import written

EDGES_AT_ONCE = 1 << 20  # edges that a task contracts together with the forest of those before


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the edges that is not the smallest of its component, and that smallest node."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y, low = place[: len(u)], place[len(u) :], np.arange(len(nodes))
    while True:
        a, b = low[x], low[y]
        apart = a != b
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(low, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(low, low[low]):
            low = low[low]
    moved = low != np.arange(len(nodes))
    return nodes[moved], nodes[low[moved]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of this task as a forest, one row per node that has a smaller one."""
    held, size, u, v = [], 0, np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= EDGES_AT_ONCE:
            u, v = forest(np.concatenate([u, *[h[0] for h in held]]), np.concatenate([v, *[h[1] for h in held]]))
            held, size = [], 0
    u, v = forest(np.concatenate([u, *[h[0] for h in held]]), np.concatenate([v, *[h[1] for h in held]]))
    for start in range(0, len(u), EDGES_AT_ONCE):
        part = slice(start, start + EDGES_AT_ONCE)
        yield pa.RecordBatch.from_arrays([pa.array(u[part]), pa.array(v[part])], names=["u", "v"])


def _parents(edges: DataFrame) -> DataFrame:
    """``(u, v, others)``: per node its smallest neighbour below it, and the other ones.

    A node has no more of these than there were tasks to contract its edges.
    """
    local = edges.mapInArrow(_contracted, "u bigint, v bigint")
    found = local.groupBy("u").agg(F.min("v").alias("v"), F.collect_set("v").alias("others"))
    return written(found.withColumn("others", F.array_remove("others", F.col("v"))), "components")


def _fingerprint(parents: DataFrame) -> tuple:
    others = F.sum(F.size("others"))
    return tuple(parents.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), others).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Rows ``(node, component)`` for every node of the edge list; component = smallest node in it.

    Nodes are whole numbers; an edge with a null end, or from a node to itself, links nothing. Each task
    first contracts the edges that it has to a forest, so only forests are shuffled. A round gives every
    node its smallest neighbour below it as parent, links its other ones to that parent, and lets each
    node jump to the parent of its parent; then tasks contract again. The number of rounds grows with the
    logarithm of the longest path. A node that very many hang on is on the side of the join that may
    be split or stay in place, and takes part once. Each round is written to the checkpoint folder.
    """
    current = _parents(
        edges.select(F.col(left).cast("bigint").alias("u"), F.col(right).cast("bigint").alias("v")).where("u <> v")
    )
    seen = _fingerprint(current)
    while seen[0]:
        above = current.select(F.col("u").alias("__u"), F.col("v").alias("__v"))
        jumped = current.join(above, F.col("v") == F.col("__u"), "left")
        jumped = jumped.select("u", F.coalesce("__v", "v").alias("v"))
        aside = current.where(F.size("others") > 0).select(F.explode("others").alias("u"), "v")
        current = _parents(jumped.union(aside))
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
