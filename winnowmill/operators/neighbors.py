"""Nearest neighbours by cosine, and what an audit derives from them."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import InvalidInput
from ..plans.lineage import written
from ..plans.positions import with_row_position

# Two blocks of vectors and the matrix of their similarities fit easily into a Python worker.
BLOCK_ROWS = 2048
# Vectors of a cell, as long as there are no more than MAX_PIVOTS cells; pivots travel to every task.
CELL_ROWS = 1024
MAX_PIVOTS = 1024
# Similarities are compared after rounding, so that equal pairs tie whatever the order of summation.
SIMILARITY_DIGITS = 9
# Cells are skipped only beyond this many radians: rounded similarities near 1 are that far apart.
SLACK = 1e-4
# Queries that a task holds while vectors stream past them; there are about GROUPS such groups until they are full.
GROUP_ROWS = 1 << 16
GROUPS = 24
LEAST_GROUP = 256
NO_ID = np.iinfo(np.int64).max  # stands for a null id


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    norms[norms == 0] = 1.0
    return matrix / norms


def _best(ids: np.ndarray, others: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``sims`` the columns of the k best others, ties by id, the row itself left out."""
    sims = np.where(ids[:, None] == others[None, :], -np.inf, sims)
    order = np.lexsort((np.broadcast_to(others, sims.shape), -sims), axis=1)[:, :k]
    rows = np.repeat(np.arange(len(ids)), order.shape[1])
    columns = order.ravel()
    keep = np.isfinite(sims[rows, columns])
    return rows[keep], columns[keep]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; all have the length of the first."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _visited(queries: DataFrame, vectors: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Local top k of queries ``(id, vec, bound, cell)`` among the vectors ``(id, vec, label, cell)`` of their cells.

    Each cell's queries and vectors are dealt in blocks; two blocks meet in a group, however large the
    cell. Only neighbours that are no worse than the query's bound, if it has one, leave the task.
    """
    sizes = queries.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("i_blocks")).join(
        vectors.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("j_blocks")), "cell"
    )
    steps = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    sized = lambda df: df.join(F.broadcast(sizes), "cell")
    asking = sized(queries).select("cell", block("i_blocks").alias("i"), steps("j_blocks").alias("j"), F.lit(True).alias("query"),
                                   "id", "vec", "bound", F.lit(None).cast(vectors.schema["label"].dataType).alias("label"))
    asked = sized(vectors).select("cell", steps("i_blocks").alias("i"), block("j_blocks").alias("j"), F.lit(False).alias("query"),
                                  "id", "vec", F.lit(None).cast("double").alias("bound"), "label")

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        rows, others = pair[pair["query"]], pair[~pair["query"]]
        if not len(rows) or not len(others):
            return pd.DataFrame(columns=["id", "neighbor_id", "similarity", "neighbor_label"])
        sims = np.round(_unit(rows["vec"]) @ _unit(others["vec"]).T, SIMILARITY_DIGITS)
        bounds = rows["bound"].to_numpy()[:, None]
        sims = np.where(sims < bounds, -np.inf, sims)  # no bound is NaN, which nothing is below
        ids, other_ids = rows["id"].to_numpy(), others["id"].to_numpy()
        i, j = _best(ids, other_ids, sims, k)
        found = {"id": ids[i], "neighbor_id": other_ids[j], "similarity": sims[i, j]}
        return pd.DataFrame(found | {"neighbor_label": others["label"].to_numpy()[j]})

    schema = f"id bigint, neighbor_id bigint, similarity double, neighbor_label {dict(vectors.dtypes)['label']}"
    return asking.unionByName(asked).groupBy("cell", "i", "j").applyInPandas(run, schema)


def _in_cells(vectors: DataFrame, total: int, cell_rows: int) -> tuple[DataFrame, np.ndarray]:
    """``vectors`` plus ``cell`` and ``angle``: the nearest of the pivots and the angle to it; and the pivots.

    Pivots are vectors with the smallest hashes of their ids. Vectors of length zero, to which no angle can
    be measured, have a cell of their own.
    """
    wanted = min(MAX_PIVOTS, max(1, math.ceil(total / cell_rows)))
    chosen = vectors.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(wanted).select("vec").toArrow()
    pivots = _scaled(_matrix(chosen.column("vec").combine_chunks()))
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    names = vectors.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column(names.index("vec")))
                angles = _angles(_scaled(matrix), shared.value)
                cell = np.where(matrix.any(axis=1), angles.argmin(axis=1), len(shared.value)).astype(np.int32)
                columns = [*batch.columns, pa.array(cell), pa.array(angles.min(axis=1))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "cell", "angle"])

    kinds = ", ".join(f"{n} {t}" for n, t in vectors.dtypes)
    return written(vectors.mapInArrow(place, f"{kinds}, cell int, angle double"), "neighbor-cells"), pivots


def _radii(cells: DataFrame, pivots: np.ndarray) -> np.ndarray:
    """The largest angle of each cell; an empty cell is nowhere near, that of the zeros near all."""
    radii = np.full(len(pivots) + 1, -np.inf)
    for row in cells.groupBy("cell").agg(F.max("angle").alias("radius")).collect():
        radii[row["cell"]] = row["radius"] if row["cell"] < len(pivots) else np.inf
    return radii


def _reached(queries: DataFrame, pivots: np.ndarray, radii: np.ndarray, by: str) -> DataFrame:
    """``(by, cell)``, each once in a batch: the other cells that may hold a neighbour of one of the queries."""
    shared = queries.sparkSession.sparkContext.broadcast((pivots, radii))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radii = shared.value
        for batch in batches:
            if batch.num_rows:
                vectors, own = _matrix(batch.column(1)), batch.column(2).to_numpy()
                least = np.full((len(vectors), len(radii)), -np.inf)
                least[:, : len(pivots)] = _angles(_scaled(vectors), pivots) - radii[: len(pivots)]
                bound = batch.column(3).fill_null(-1.0).to_numpy()
                limit = np.arccos(np.clip(np.where(vectors.any(axis=1), bound, -1.0), -1.0, 1.0)) + SLACK
                near = ~(least > limit[:, None]) & (radii != -np.inf)
                near[np.arange(len(own)), own] = False
                i, cell = np.nonzero(near)
                found = pa.table([batch.column(0).take(pa.array(i)), pa.array(cell.astype(np.int32))], names=[by, "cell"])
                yield from found.group_by([by, "cell"]).aggregate([]).to_batches()

    return queries.select(by, "vec", "cell", "bound").mapInArrow(reach, f"{by} {dict(queries.dtypes)[by]}, cell int")


def cells_to_visit(queries: DataFrame, cells: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``(id, cell)``: the other cells that may hold a neighbour no worse than the query's bound.

    ``queries`` has ``(id, vec, cell, bound)``, the bound being a similarity or null. By the triangle
    inequality of angles no vector of a cell is nearer than the angle to its pivot less the cell's radius.
    """
    return _reached(queries, pivots, _radii(cells, pivots), "id")


class _Best:
    """The k best neighbours, ties by id, of the queries of a group, while blocks of vectors pass by."""

    def __init__(self, queries: pa.Table, k: int):
        self.k, self.ids, self.cells = k, _ids(queries.column("id")), queries.column("cell").to_numpy()
        self.unit = _scaled(_matrix(queries.column("vec").combine_chunks()))
        self.short, self.some = self.unit.astype(np.float32), self.unit.any(axis=1)
        # Sums of products in 32 bits are less than this beside those in 64 bits.
        self.error = np.float32((self.unit.shape[1] + 8) * 2.0**-23)
        self.bound = queries.column("bound").fill_null(-np.inf).to_numpy()
        self.sims = np.full((len(self.ids), k), -np.inf)
        self.others = np.full((len(self.ids), k), NO_ID)
        self.labels = np.full((len(self.ids), k), None, object)

    def near(self, pivot: np.ndarray | None, radius: float) -> np.ndarray:
        """Queries that a cell may hold a neighbour for, by the triangle inequality of angles."""
        if pivot is None:
            return np.arange(len(self.ids))
        limit = np.where(self.some, np.maximum(self.bound, self.sims[:, -1]), -1.0)
        limit = np.arccos(np.clip(limit, -1.0, 1.0)) + SLACK
        return np.flatnonzero(~(_angles(self.unit, pivot[None, :])[:, 0] - radius > limit))

    def meet(self, at: np.ndarray, ids: np.ndarray, unit: np.ndarray, labels: np.ndarray, block_rows: int) -> None:
        """Compares the queries at the places ``at`` with a block of vectors, which are in the order of their ids."""
        short = unit.astype(np.float32).T
        for start in range(0, len(at), block_rows):
            rows = at[start : start + block_rows]
            least = np.maximum(self.bound[rows], self.sims[rows, -1])
            reached = np.flatnonzero(self.short[rows] @ short >= (least.astype(np.float32) - 2 * self.error)[:, None])
            if len(reached) > 4 * self.k * len(rows):
                i, j, sims = self._leading(rows, least, ids, unit)
            else:
                i, j = np.divmod(reached, len(ids))
                sims = np.round(np.einsum("ij,ij->i", self.unit[rows[i]], unit[j]), SIMILARITY_DIGITS)
            last, last_id = self.sims[rows[i], -1], self.others[rows[i], -1]
            better = (sims >= self.bound[rows[i]]) & ((sims > last) | ((sims == last) & (ids[j] < last_id)))
            better &= (ids[j] != self.ids[rows[i]]) | (ids[j] == NO_ID)
            if better.any():
                self._take(rows[i[better]], ids[j[better]], sims[better], labels[j[better]])

    def _leading(self, rows: np.ndarray, least: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where very many vectors of a block reach the bounds, its k best for each query."""
        sims = np.round(self.unit[rows] @ unit.T, SIMILARITY_DIGITS)
        sims[np.isnan(sims) | ((ids[None, :] == self.ids[rows][:, None]) & (ids != NO_ID)[None, :])] = -np.inf
        if sims.shape[1] > self.k:
            least = np.maximum(least, np.partition(sims, -self.k, axis=1)[:, -self.k])
        above, ties = sims > least[:, None], (sims == least[:, None]) & np.isfinite(sims)
        i, j = np.nonzero(above | (ties & (np.cumsum(ties, axis=1) <= self.k)))
        return i, j, sims[i, j]

    def _take(self, rows: np.ndarray, ids: np.ndarray, sims: np.ndarray, labels: np.ndarray) -> None:
        touched, place = np.unique(rows, return_inverse=True)
        place = np.concatenate([np.repeat(np.arange(len(touched)), self.k), place])
        ids = np.concatenate([self.others[touched].ravel(), ids])
        sims = np.concatenate([self.sims[touched].ravel(), sims])
        labels = np.concatenate([self.labels[touched].ravel(), labels])
        order = np.lexsort((ids, -sims, place))
        starts = np.searchsorted(place[order], np.arange(len(touched)))
        kept = order[(starts[:, None] + np.arange(self.k)).ravel()]
        shape = (len(touched), self.k)
        self.sims[touched], self.others[touched], self.labels[touched] = (c[kept].reshape(shape) for c in (sims, ids, labels))

    def found(self, label: pa.DataType, rows_at_once: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        i, j = np.nonzero(self.sims != -np.inf)
        for start in range(0, len(i), rows_at_once):
            at = i[start : start + rows_at_once], j[start : start + rows_at_once]
            columns = [_id_array(self.ids[at[0]]), _id_array(self.others[at]), pa.array(self.sims[at])]
            labels = pa.array(self.labels[at].tolist(), label)
            yield pa.RecordBatch.from_arrays([*columns, labels], names=["id", "neighbor_id", "similarity", "neighbor_label"])


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(int(NO_ID)).to_numpy()


def _id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == NO_ID)


def _met(
    queries: DataFrame, vectors: DataFrame, pairs: DataFrame, pivots: np.ndarray, radii: np.ndarray, own: bool, k: int, block_rows: int
) -> DataFrame:
    """Top k of queries ``(id, vec, bound, cell, g)`` among the vectors ``(id, vec, label, cell)`` of the cells in ``pairs``.

    ``pairs`` has ``(g, cell)``, the cells that a group of queries visits: ``own``, in which a query meets its own
    cell only, or others, in which it meets those that its bound, or what it has found so far, does not rule
    out. A task holds the queries of a group, and the vectors of its cells stream past them.
    """
    kinds, none = dict(vectors.dtypes), F.lit(None)
    asking = queries.select("g", F.lit(0).alias("asked"), "cell", "id", "vec", "bound", none.cast(kinds["label"]).alias("label"))
    asked = vectors.join(F.broadcast(pairs), "cell").select(
        "g", F.lit(1).alias("asked"), "cell", "id", "vec", none.cast("double").alias("bound"), "label"
    )
    shared = vectors.sparkSession.sparkContext.broadcast((pivots, radii))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radii = shared.value
        group, held, best = None, [], None
        for batch in batches:
            g, kind, cells = (batch.column(c).to_numpy() for c in ("g", "asked", "cell"))
            label = batch.schema.field("label").type
            # Rows are sorted by group, queries first, then by cell.
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0) | (np.diff(cells) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(g)]):
                if start == end:
                    continue
                if g[start] != group:
                    if best is not None:
                        yield from best.found(label)
                    group, held, best = g[start], [], None
                if not kind[start]:
                    held.append(batch.slice(start, end - start))
                    continue
                if best is None:
                    if not held:
                        continue
                    best, held = _Best(pa.Table.from_batches(held), k), []
                cell = cells[start]
                at = np.flatnonzero(best.cells == cell) if own else best.near(pivots[cell] if cell < len(pivots) else None, radii[cell])
                if not own:
                    at = at[best.cells[at] != cell]
                for first in range(start, end, block_rows) if len(at) else ():
                    part = batch.slice(first, min(block_rows, end - first))
                    ids = _ids(part.column("id"))
                    order = np.argsort(ids, kind="stable")
                    labels = np.empty(len(ids), object)
                    labels[:] = part.column("label").to_pylist()
                    best.meet(at, ids[order], _scaled(_matrix(part.column("vec")))[order], labels[order], block_rows)
        if best is not None:
            yield from best.found(label)

    schema = f"id bigint, neighbor_id bigint, similarity double, neighbor_label {kinds['label']}"
    parts = max(GROUPS, vectors.sparkSession.sparkContext.defaultParallelism)
    dealt = asking.unionByName(asked).repartitionById(parts, F.pmod("g", F.lit(parts)))
    return dealt.sortWithinPartitions("g", "asked", "cell").mapInArrow(run, schema)


def _grouped(queries: DataFrame, group_rows: int) -> DataFrame:
    """``queries`` plus ``g``, groups of about ``group_rows`` of neighbouring cells; a large cell makes several."""
    counts = sorted((r["cell"], r["n"]) for r in queries.groupBy("cell").agg(F.count("*").alias("n")).collect())
    rows, g, size = [], 0, 0
    for cell, n in counts:
        if size and size + n > group_rows:
            g, size = g + 1, 0
        parts = max(1, math.ceil(n / group_rows))
        rows.append((cell, g, parts))
        g, size = (g, size + n) if parts == 1 else (g + parts, 0)
    places = queries.sparkSession.createDataFrame(rows, "cell int, first int, parts int")
    g = F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return queries.join(F.broadcast(places), "cell").select(*queries.columns, g.alias("g"))


def _exact(queries: DataFrame | None, vectors: DataFrame, total: int, k: int, block_rows: int, cell_rows: int) -> DataFrame:
    """Top k, and some more, of the vectors with the ids of ``queries`` (all if None) among all vectors.

    A query's own cell gives a bound, the similarity of its k-th best there; then it visits the cells that the
    bound does not rule out. Queries do so in groups: what is shuffled are the vectors, once per group that visits
    them, not once per query. Up to GROUPS * GROUP_ROWS queries that grows as the table does.
    """
    placed, pivots = _in_cells(vectors, total, cell_rows)
    asking = placed if queries is None else placed.join(queries.select("id"), "id", "left_semi")
    asking = asking.select("id", "vec", "cell")
    asking = _grouped(asking, min(GROUP_ROWS, max(LEAST_GROUP, math.ceil(total / GROUPS))))
    radii = _radii(placed, pivots)
    pairs = asking.select("g", "cell").distinct()
    own = _met(asking.withColumn("bound", F.lit(None).cast("double")), placed, pairs, pivots, radii, True, k, block_rows)
    best = Window.partitionBy("id").orderBy(F.desc("similarity"), F.asc("neighbor_id"))
    own = written(own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "neighbor-own")
    # A row per query: the small files of alike rows must not have Spark collect it to the driver for a broadcast.
    bounds = own.where(F.col("rank") == k).select("id", F.col("similarity").alias("bound")).hint("shuffle_merge")
    bounded = written(asking.join(bounds, "id", "left"), "neighbor-bounds")
    pairs = written(_reached(bounded, pivots, radii, "g").distinct(), "neighbor-visits")
    others = _met(bounded, placed, pairs, pivots, radii, False, k, block_rows)
    return own.drop("rank").unionByName(others)


def _bucket_neighbors(vectors: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Local top k of vectors ``(id, vec, label, bucket)`` within their buckets, block by block."""
    rows = vectors.withColumnRenamed("bucket", "cell")
    return _visited(rows.select("id", "vec", "cell", F.lit(None).cast("double").alias("bound")), rows, k, block_rows)


def _hash_buckets(vectors: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """Bucket numbers from signs of random projections, one bucket per table and vector."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        planes = None
        for vecs in batches:
            matrix = np.stack(vecs.to_numpy())
            if planes is None:
                random = np.random.default_rng(seed)
                planes = random.standard_normal((matrix.shape[1], tables * bits))
            signs = (matrix @ planes > 0).reshape(len(matrix), tables, bits)
            codes = signs @ (1 << np.arange(bits, dtype=np.int64))
            codes = codes + (np.arange(tables, dtype=np.int64) << bits)
            yield pd.Series(list(codes))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    codes = F.pandas_udf(run, returnType="array<bigint>")
    return vectors.withColumn("bucket", F.explode(codes("vec")))


def nearest_neighbors(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    k: int,
    label: Column | str | None = None,
    method: str = "exact",
    block_rows: int = BLOCK_ROWS,
    tables: int = 12,
    bits: int | None = None,
    seed: int = 7,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(id, neighbor_id, similarity, rank, neighbor_label)``: the k most similar other vectors.

    Ties go to the smaller neighbour id. A vector of zeros has similarity 0 to all. The caller names the
    method, at every size the same. ``exact`` deals the vectors to cells around pivots and compares a vector
    with those cells that the triangle inequality does not rule out; on data without clusters that may
    be all. ``hashed`` compares vectors that share one of 2^``bits`` random-hyperplane buckets in one of
    ``tables`` tables and so may miss neighbours; by default there are as many buckets as blocks. Vectors
    that meet fewer than ``k`` others there, the isolated ones, are searched like ``exact``, so no row is short
    of neighbours. Cells and buckets above the block size are compared block by block.
    """
    # Numbers of 32 bits travel as such; they are compared in 64 bits.
    kind = "array<float>" if dict(df.dtypes)[vector_col] == "array<float>" else "array<double>"
    tag = F.lit(None).cast("string") if label is None else (F.col(label) if isinstance(label, str) else label)
    vectors = df.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast(kind).alias("vec"),
        tag.alias("label"),
    )
    total = vectors.count()
    if method == "exact":
        found = _exact(None, vectors, total, k, block_rows, cell_rows)
    elif method == "hashed":
        bits = max(1, math.ceil(math.log2(max(2, total / block_rows)))) if bits is None else bits
        bucketed = _hash_buckets(vectors, tables, bits, seed)
        found = written(_bucket_neighbors(bucketed, k, block_rows).distinct(), "neighbor-buckets")
        full = found.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, total - 1))
        short = written(vectors.select("id").join(full, "id", "left_anti"), "neighbor-short")
        found = found.join(short, "id", "left_anti").unionByName(_exact(short, vectors, total, k, block_rows, cell_rows))
    else:
        raise InvalidInput("method must be 'exact' or 'hashed'")
    best = Window.partitionBy("id").orderBy(F.desc("similarity"), F.asc("neighbor_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(F.col("id").alias(id_col), "neighbor_id", "similarity", "rank", "neighbor_label")
    )


def knn_pred_probs(neighbors: DataFrame, id_col: str, classes: Sequence) -> DataFrame:
    """Class frequencies among each row's neighbours as ``pred_probs``, in the order of ``classes``."""
    labels = neighbors.groupBy(id_col).agg(F.collect_list("neighbor_label").alias("__labels"))
    listed = F.array(*[F.lit(c) for c in classes])

    def share(c: Column) -> Column:
        hits = F.size(F.filter("__labels", lambda v: v == c))
        return F.try_divide(hits.cast("double"), F.size("__labels"))

    return labels.select(id_col, F.transform(listed, share).alias("pred_probs"))


def outlier_scores(neighbors: DataFrame, id_col: str, quantile: float = 0.95) -> DataFrame:
    """Mean cosine distance to the neighbours, flagged above the given quantile of all scores."""
    scores = neighbors.groupBy(id_col).agg(F.avg(1 - F.col("similarity")).alias("outlier_score"))
    # The exact quantile: the score at its position in sorted ranges.
    placed = with_row_position(scores, "__position", "outlier_score")
    wanted = max(0, math.ceil(quantile * placed.count()) - 1)
    row = placed.where(F.col("__position") == wanted).select("outlier_score").first()
    limit = F.lit(row[0] if row else None).cast("double")
    return placed.withColumn("is_outlier", F.coalesce(F.col("outlier_score") > limit, F.lit(False))).drop("__position")


def knn_class_shares(neighbors: DataFrame, id_col: str) -> DataFrame:
    """``class_shares``, an array of ``(p, label)`` over the classes seen among each row's neighbours, in class order.

    Neighbours without label count among all but are of no class.
    """
    votes = neighbors.groupBy(id_col, F.col("neighbor_label").alias("label")).agg(F.count("*").alias("n"))
    entry = F.struct("label", "n")
    rows = votes.groupBy(id_col).agg(F.sort_array(F.collect_list(entry)).alias("__e"), F.sum("n").alias("__n"))
    seen = F.filter("__e", lambda e: e["label"].isNotNull())
    share = lambda e: F.struct((e["n"] / F.col("__n")).alias("p"), e["label"].alias("label"))
    return rows.select(id_col, F.transform(seen, share).alias("class_shares"))


def label_classes(df: DataFrame, label: str, limit: int = 10_000) -> list:
    """Sorted distinct labels; an error beyond ``limit``, since class lists travel with every task."""
    rows = df.where(F.col(label).isNotNull()).select(label).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise InvalidInput(f"{label} has more than {limit} classes")
    return sorted(r[0] for r in rows)
