"""N-gram Jaccard join: size-banded tiles, bounds from hashed bitmaps, exact intersections of sorted arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..plans.skew import attach_group_values
from .common import WordHashes, col, likely_in, pieces, stored
from .near import shingle_hashes

COUNTERS = 1 << 20  # counters of shingles, whatever the size of the corpus; they decide an order only
BLOCK = 512  # rows of a tile that meet as many others in one group
NEVER = np.iinfo(np.int64).max  # fills the lists of rows with fewer tiles
LEAST = 8  # of its tiles, a row carries the first ones, so that a pair is compared in one tile only


def _sets(rows: DataFrame, words: int, schema: str, body) -> DataFrame:
    """``body`` for each run of texts of ``(id, text)``: it gets the ids and the sorted distinct shingles of each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for first, texts in pieces(batch, 1):
                found = [shingle_hashes(cache.of((t or b"").lower().split()), words) for t in texts]
                yield body(batch.column(0).slice(first, len(texts)), found)

    return rows.select(col("id").cast("bigint").alias("id"), col("text").cast("binary").alias("text")).mapInArrow(
        scan, schema
    )


def _digests(found: list[np.ndarray]) -> pa.Array:
    """128 bits of each set; null for an empty one."""
    return pa.array([xxhash.xxh3_128_digest(f.tobytes()) if len(f) else None for f in found], pa.binary())


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
    flat = np.concatenate(found) if found else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def shingle_counts(rows: DataFrame, words: int) -> np.ndarray:
    """How many shingles fall on each of COUNTERS counters, over all texts: a table of a fixed size.

    A shingle of many texts stands out from the even load of its counter at any size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, table = WordHashes(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, texts in pieces(batch, 0):
                found = [shingle_hashes(cache.of((t or b"").lower().split()), words) for t in texts]
                places = (np.concatenate(found) % np.uint64(COUNTERS)).astype(np.int64)
                table += np.bincount(places, minlength=COUNTERS)
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(table[used])], names=["at", "n"])

    texts = rows.select(col("text").cast("binary").alias("text"))
    sums = texts.mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return out


def width_of(n: int) -> int:
    """Bits of the bitmap of a set of ``n``: a power of two, at least 64, from n to below 2 n."""
    return 1 << max(6, int(n - 1).bit_length())


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit per shingle, by its hash; half the bits come from folding the bitmap once."""
    bits = np.zeros(width_of(len(shingles)), bool)
    bits[((shingles >> np.uint64(20)) % np.uint64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _signatures(rows: DataFrame, words: int, percent: int, counts) -> DataFrame:
    """``(id, n, digest, bitmap, keys)``: keys are the rarest n - ceil(percent n / 100) + 1 shingles.

    Of two sets that reach the similarity, each has one of the other's keys among its own, as the order
    (counter, hash) is the same for all; shingles that tie with the last key are keys too.
    """

    def body(ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
        table, keys, maps = counts.value, [], []
        for own in found:
            length = len(own) - -(-len(own) * percent // 100) + 1
            if len(own):
                load = table[(own % np.uint64(len(table))).astype(np.int64)]
                rank = (np.minimum(load, (1 << 30) - 1).astype(np.uint64) << np.uint64(34)) | (own >> np.uint64(30))
                keys.append(own[rank <= np.partition(rank, length - 1)[length - 1]])
                maps.append(bitmap(own))
            else:
                keys.append(own)
                maps.append(None)
        sizes = pa.array([len(f) for f in found], pa.int64())
        arrays = [ids, sizes, _digests(found), pa.array(maps, pa.binary()), _lists(keys)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "n", "digest", "bitmap", "keys"])

    return _sets(rows, words, "id bigint, n bigint, digest binary, bitmap binary, keys array<bigint>", body)


def bands(percent: int, largest: int) -> list[int]:
    """Smallest size of each band; a set links only with sets of its own and the two neighbouring bands."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * 100 // percent + 1)
    return edges


def _full_sets(nodes: DataFrame, sets: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``(node, hashes)``: the sorted shingles of the named sets, and of few others, from texts that are read again."""
    wanted = nodes.select("node").distinct().join(sets.select("node", "low_id"), "node")
    ids = stored(wanted.where("low_id IS NOT NULL").select("low_id").distinct(), "ngram-wanted")
    known = likely_in(rows.where(F.col("id").isNotNull()), F.col("id"), ids)

    def body(ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, _digests(found), _lists(found)], names=["id", "digest", "hashes"])

    texts = known.unionByName(rows.where(F.col("id").isNull()))
    full = _sets(texts, words, "id bigint, digest binary, hashes array<bigint>", body).where("digest IS NOT NULL")
    full = full.select(F.xxhash64("digest").alias("node"), "hashes")
    return full.groupBy("node").agg(F.first("hashes").alias("hashes"))


def _groups(batches: Iterator[pa.RecordBatch], rows_at_once: int = 2 * BLOCK) -> Iterator[pa.Table]:
    """Runs of whole groups of rows sorted by ``place``; a group may begin in one batch and end in another."""
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


def _folded(maps: np.ndarray) -> np.ndarray:
    half = maps.shape[1] // 2
    return maps[:, :half] | maps[:, half:]


class _Bitmaps:
    """The bitmaps of a run of rows: a matrix for each width, and the same folded once."""

    def __init__(self, rows: pa.Table) -> None:
        column = rows.column("bitmap").combine_chunks()
        ends = column.buffers()[1]
        offsets = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)
        self.words = np.diff(offsets) // 8
        self.row_in = np.zeros(len(column), np.int64)
        self.by_width, self.half = {}, {}
        for width in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == width)
            self.row_in[at] = np.arange(len(at))
            flat = data[offsets[at][:, None] + np.arange(width * 8)]
            self.by_width[width] = np.ascontiguousarray(flat).view(np.uint64)

    def differing(self, p: int, q: np.ndarray) -> np.ndarray:
        """For each row of ``q``, bits in which it and ``p`` differ, at the smaller width of the two."""
        out, width = np.zeros(len(q), np.int64), int(self.words[p])
        own = self.by_width[width][self.row_in[p]][None, :]
        for other in np.unique(self.words[q]).tolist():
            at = np.flatnonzero(self.words[q] == other)
            maps, mine = self.by_width[other][self.row_in[q[at]]], own
            while maps.shape[1] > mine.shape[1]:
                maps = _folded(maps)
            while mine.shape[1] > maps.shape[1]:
                mine = _folded(mine)
            out[at] = np.bitwise_count(maps ^ mine).sum(axis=1)
        return out


def _first_meeting(own: np.ndarray, others: np.ndarray, tile: int) -> np.ndarray:
    """Whether ``tile`` may be the first one that a row has in common with each of the others.

    A common tile up to the last of both lists is in both. Where there is none up to there, it is not known
    which of the later ones is first, and every one of them may be.
    """
    common = np.where(np.isin(others, own), others, NEVER).min(axis=1)
    known = common <= np.minimum(others[:, -1], own[-1])
    return np.where(known & (common != NEVER), common == tile, True)


def _candidates(rows: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each minor row of each group, the others that sizes and bitmaps do not rule out.

    Shingles that make the bitmaps differ are in one set only, so sets of n and m whose bitmaps differ in
    d bits share at most (n + m - d) / 2. Rows of a group are ordered by ``minor``.
    """
    get = {c: rows.column(c).to_numpy() for c in ("place", "minor", "node", "part", "major", "n", "tile")}
    least = np.stack([rows.column(f"t{i}").to_numpy() for i in range(LEAST)], axis=1)
    maps, starts = _Bitmaps(rows), np.searchsorted(get["place"], get["place"])
    others = np.cumsum(~get["minor"])  # others of a group stand before its minor rows
    ends = others - np.where(starts > 0, others[starts - 1], 0) + starts
    for p in np.flatnonzero(get["minor"]):
        q = np.arange(starts[p], ends[p])
        part, node, n = get["part"][q], get["node"][q], get["n"][q]
        fits = (part != get["part"][p]) & ((part == get["major"][p]) | (get["node"][p] < node))
        fits &= np.minimum(n, get["n"][p]) * 100 >= np.maximum(n, get["n"][p]) * percent
        q = q[fits]
        if len(q):
            total = n[fits] + get["n"][p]
            q = q[(total - maps.differing(p, q)) * (100 + percent) >= 2 * percent * total]
        if len(q):
            q = q[_first_meeting(least[p], least[q], get["tile"][p])]
        if len(q):
            yield int(p), q


def _open_rows(percent: int):
    """Rows ``(place, node, minor)`` that have somebody to be compared with."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            found = np.zeros(len(rows), bool)
            for p, q in _candidates(rows, percent):
                found[p] = found[q] = True
            yield from rows.filter(pa.array(found)).to_batches()

    return scan


def _shared(own: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many elements each of the sorted arrays that lie one after the other in ``flat`` has in common with ``own``."""
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    hits = np.concatenate([[0], np.cumsum(own[at] == flat)])
    return np.diff(hits[np.concatenate([[0], ends])])


def _confirmed(percent: int):
    """Links ``(a, b)`` whose full sets reach the similarity."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            node, hashes = rows.column("node").to_numpy(), rows.column("hashes").combine_chunks()
            ends, flat = hashes.offsets.to_numpy(), hashes.values.to_numpy().view(np.uint64)
            size, pairs = np.diff(ends), []
            for p, q in _candidates(rows, percent):
                others = np.concatenate([flat[ends[i] : ends[i + 1]] for i in q])
                shared = _shared(flat[ends[p] : ends[p + 1]], others, np.cumsum(size[q]))
                q = q[shared * 100 >= (size[p] + size[q] - shared) * percent]
                pairs.append(np.stack([np.minimum(node[p], node[q]), np.maximum(node[p], node[q])]))
            if pairs:
                a, b = np.concatenate(pairs, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return scan


def _met(dealt: DataFrame, sets: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of rows ``(place, tile, node, minor, part, major, t0, ...)``: bitmaps first, full sets for what they leave."""
    order = lambda df: df.repartition("place").sortWithinPartitions("place", "minor")
    placed = order(dealt.join(sets.select("node", "n", "bitmap"), "node"))
    waiting = stored(placed.mapInArrow(_open_rows(percent), placed.schema), "ngram-open")
    found = order(waiting.join(_full_sets(waiting, sets, rows, words), "node"))
    return stored(found.mapInArrow(_confirmed(percent), "a bigint, b bigint").distinct(), "ngram-links")


def _tiles(sets: DataFrame, percent: int) -> DataFrame:
    """``(tile, node, leader)``: a tile has the sets of two neighbouring size bands that share a key."""
    largest = sets.agg(F.max("n")).first()[0] or 1
    edges = F.array(*[F.lit(e).cast("bigint") for e in bands(percent, largest)])
    keys = sets.select("node", F.size(F.filter(edges, lambda e: e <= F.col("n"))).alias("band"), F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
    keys = keys.join(shared, "key")
    dealt = keys.withColumn("of", F.explode(F.array("band", F.col("band") + 1)))
    dealt = dealt.select(F.xxhash64("key", "of").alias("tile"), "node", (F.col("of") == F.col("band")).alias("own"))
    tiles = dealt.groupBy("tile").agg(
        F.count("*").alias("rows"), F.count_if("own").alias("owners"), F.min("node").alias("leader")
    )
    return dealt.join(tiles.where("rows > 1 AND owners > 0").select("tile", "leader"), "tile").drop("own")


def _with_leaders(members: DataFrame) -> DataFrame:
    """Each member of a tile beside the tile's smallest node, BLOCK members at a time."""
    led = members.where("node <> leader").select("leader", "node").distinct()
    counts = led.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    place = lambda i: F.xxhash64("leader", i).alias("place")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    others = led.join(counts, "leader").select(place(own), "node", F.lit(False).alias("minor"))
    steps = counts.select("leader", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("i"))
    leaders = steps.select(place(F.col("i")), F.col("leader").alias("node"), F.lit(True).alias("minor"))
    zero, never = F.lit(0).cast("bigint"), {f"t{i}": F.lit(int(NEVER)) for i in range(LEAST)}  # each pair is there once
    return others.unionByName(leaders).withColumns({"part": F.col("node"), "major": zero, "tile": zero} | never)


def _across(members: DataFrame, linked: DataFrame) -> DataFrame:
    """Members of tiles that are still in different components: those outside the largest one beside all others.

    Both sides are dealt in blocks of at most BLOCK, so that a hot tile is spread over many tasks.
    """
    parts = connected_components(linked, "a", "b")
    placed = members.join(parts, "node", "left").select("tile", "node", F.coalesce("component", "node").alias("part"))
    sizes = placed.groupBy("tile", "part").agg(F.count("*").alias("rows"))
    mixed = sizes.groupBy("tile").agg(
        F.max_by("part", F.struct("rows", "part")).alias("major"), F.sum("rows").alias("all_rows"), F.max("rows").alias("most")
    )
    placed = stored(placed.join(mixed.where("all_rows > most"), "tile"), "ngram-mixed")
    least = placed.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("tile")), 1, LEAST).alias("least"))
    never = lambda i: F.coalesce(F.get("least", F.lit(i)), F.lit(int(NEVER)))
    least = least.select(F.col("node").alias("__of"), *[never(i).alias(f"t{i}") for i in range(LEAST)])
    placed = placed.join(least, F.col("node") == F.col("__of"))
    blocks, minors = F.ceil(F.col("all_rows") / BLOCK), F.ceil((F.col("all_rows") - F.col("most")) / BLOCK)
    own, steps = F.xxhash64("node"), lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    one = placed.withColumn("minor", F.lit(False)).withColumn("i", F.pmod(own, blocks)).withColumn("j", steps(minors))
    two = placed.where("part <> major").withColumn("minor", F.lit(True))
    two = two.withColumn("j", F.pmod(own, minors)).withColumn("i", steps(blocks))
    place, first = F.xxhash64("tile", "i", "j").alias("place"), [f"t{i}" for i in range(LEAST)]
    return one.unionByName(two).select(place, "tile", "node", "minor", "part", "major", *first)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row; ids are whole numbers.

    A row's set are its distinct runs of ``words`` words (A-Z lower-cased, split at ASCII white space); a
    shorter text is one run. Sets with 100 * shared >= percent * united are linked; no link is missed.
    ``component_id`` is the smallest id reachable by links. Texts without words, and null, have
    ``n_shingles`` 0 and are linked with nothing. Rows without id take part; their ``component_id`` is
    null if no row of the component has an id. Rows that repeat an id are told apart by their sets.
    Shingles are told apart by 64-bit hashes, sets by 128-bit ones. Other columns are not read.

    Equal sets are folded. A set is put into tiles by its rarest shingles and by its size band, so that
    every pair that reaches the similarity meets in a tile. There the difference of two bitmaps bounds
    the overlap from above, and the pairs left are decided on the sorted arrays. Members meet the
    smallest node of their tile first; then, where a tile still has several components, its rows
    outside the largest one meet all others, block by block. Pairs inside a component are not formed.
    """
    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(rows, words))
    scanned = stored(_signatures(rows, words, percent, counts), "ngram-signatures")
    sets = scanned.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("low_id"), F.count("*").alias("rows"), *[F.first(c).alias(c) for c in ("n", "bitmap", "keys")]
    )
    sets = stored(sets.withColumn("node", F.xxhash64("digest")), "ngram-sets")
    members = stored(_tiles(sets, percent), "ngram-tiles")
    linked = _met(_with_leaders(members), sets, rows, words, percent)
    linked = linked.union(_met(_across(members, linked), sets, rows, words, percent))

    named = sets.join(connected_components(linked, "a", "b"), "node", "left")
    named = named.select("digest", "low_id", "rows", F.coalesce("component", "node").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low_id").alias("component_id"), F.count("*").alias("sets"))
    named = attach_group_values(named, lowest, "component", "sets", "digest").select("digest", "component_id", "rows")
    out = attach_group_values(scanned.select("id", "n", "digest"), named, "digest", "rows", "id")
    part = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), part.alias("component_id"))
