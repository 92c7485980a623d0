"""MinHash near-duplicates: a multi-index Hamming join over b-bit signatures, links confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..plans.components import connected_components
from ..plans.skew import attach_group_values
from .common import MIX, WordHashes, col, likely_in, packed, pieces, scrambled, stored, unpacked

LANE_BITS = 12
LANES = 5  # five lanes of twelve bits fill one signed 64-bit word and leave the sign alone
CHUNKS = 8
SLOTS = LANES * CHUNKS
ERRORS = 1  # lanes that may differ inside a chunk
BLOCK = 512  # rows of a bucket that meet as many others in one group
SEED = 20_260_101


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct 64-bit hashes of all runs of ``words`` words, sorted; a shorter text is one run."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    width = min(words, len(hashes))
    runs = np.full(len(hashes) - width + 1, width, np.uint64)
    for j in range(width):
        runs = runs * MIX + hashes[j : len(hashes) - width + 1 + j]
    return np.unique(scrambled(runs))


def _factors() -> np.ndarray:
    random = np.random.default_rng(SEED)
    return random.integers(0, 2**63, (SLOTS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """SLOTS MinHash values, LANE_BITS bits of each, LANES to a word."""
    low = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):  # bounds the working matrix for long texts
        low = np.minimum(low, (shingles[start : start + 4096] * factors).min(axis=1))
    lanes = scrambled(low).reshape(CHUNKS, LANES) & np.uint64((1 << LANE_BITS) - 1)
    return (lanes << (np.arange(LANES, dtype=np.uint64) * np.uint64(LANE_BITS))).sum(axis=1, dtype=np.uint64)


def _scan(docs: DataFrame, id_col: str, text_col: str, words: int, sets: bool) -> DataFrame:
    """Per row ``(id, n, digest)`` and the signature as words s0.., or with ``sets`` the shingle hashes.

    The digest is 128 bits of the whole set, null for a text without words.
    """
    names = [f"s{i}" for i in range(CHUNKS)]
    schema = "id bigint, n bigint, digest binary, " + (
        "hashes array<bigint>" if sets else ", ".join(f"{s} bigint" for s in names)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, factors = WordHashes(), _factors()
        for batch in batches:
            for first, texts in pieces(batch, 1):
                counts, digests, extra = [], [], []
                for text in texts:
                    found = shingle_hashes(cache.of((text or b"").lower().split()), words)
                    counts.append(len(found))
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    extra.append(found if sets else _signature(found, factors))
                ids = batch.column(0).slice(first, len(texts))
                columns = [ids, pa.array(counts, pa.int64()), pa.array(digests, pa.binary())]
                if sets:
                    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    flat = np.concatenate(extra).view(np.int64) if extra else np.empty(0, np.int64)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "digest", "hashes"])
                else:
                    columns += [pa.array(s) for s in np.array(extra).view(np.int64).T.copy()]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "digest", *names])

    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(scan, schema)


def _keys(sets: DataFrame) -> DataFrame:
    """``(key, node)``: per chunk and per choice of ERRORS = 1 lane that may differ, the other lanes."""
    lane = (1 << LANE_BITS) - 1
    keys = [
        F.xxhash64(F.col(f"s{c}").bitwiseAND(F.lit(~(lane << (LANE_BITS * drop)))), F.lit(c * LANES + drop))
        for c in range(CHUNKS)
        for drop in range(LANES)
    ]
    return sets.select("node", F.posexplode(F.array(*keys)).alias("kind", "key"))


def _equal_lanes() -> list[Column]:
    """Per chunk, in how many lanes the signatures of x and y agree: lanes of the exclusive or that are zero."""
    low = sum(((1 << (LANE_BITS - 1)) - 1) << (LANE_BITS * i) for i in range(LANES))
    top = sum(1 << (LANE_BITS * i + LANE_BITS - 1) for i in range(LANES))

    def zeros(c: int) -> Column:
        x = F.col(f"x.s{c}").bitwiseXOR(F.col(f"y.s{c}"))
        some = (x.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(x)  # a lane's top bit: not all zero
        return F.bit_count(F.bitwise_not(some).bitwiseAND(F.lit(top)))

    return [zeros(c) for c in range(CHUNKS)]


def _may_link(percent: int, least_equal: int) -> Column:
    """Whether the sizes of sets x and y allow the similarity and their signatures agree enough."""
    fits = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    return fits & (reduce(lambda p, q: p + q, _equal_lanes()) >= least_equal)


def _links_all(percent: int, a: str, b: str) -> Column:
    """Whether the full sets in arrays ``a`` and ``b`` reach the similarity."""
    shared = F.size(F.array_intersect(a, b))
    return shared * 100 >= (F.size(a) + F.size(b) - shared) * percent


def _full_sets(nodes: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``(node, hashes)``: the shingles of the named sets, from texts that have them, which are read again."""
    wanted = stored(nodes.select("node").distinct().join(sets.select("node", "low_id"), "node"), "near-wanted")
    ids = wanted.where("low_id IS NOT NULL").select(F.col("low_id").alias("__wanted")).distinct()
    rows = docs.select(col(id_col).cast("bigint").alias("id"), col(text_col).alias("text"))
    known = likely_in(rows.where(F.col("id").isNotNull()), F.col("id"), ids)
    known = known.join(ids, F.col("id") == F.col("__wanted"), "left_semi")
    full = _scan(known.unionByName(rows.where(F.col("id").isNull())), "id", "text", words, sets=True)
    full = full.where("n > 0").select(F.xxhash64("digest").alias("node"), "hashes")
    # An id may occur with several texts, and a text with several ids.
    return full.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes"))


def _with_leaders(members: DataFrame, sets: DataFrame, full_sets, percent: int, least_equal: int) -> DataFrame:
    """Links ``(a, b)`` between members of buckets and the smallest node of their bucket."""
    led = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    x, y = sets.select(F.struct("*").alias("x")), sets.select(F.struct("*").alias("y"))
    close = led.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
    close = stored(close.where(_may_link(percent, least_equal)).select("a", "b"), "near-led")
    full = stored(full_sets(close.select(F.col("a").alias("node")).union(close.select("b"))), "near-full")
    left = full.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = full.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    return close.join(left, "a").join(right, "b").where(_links_all(percent, "ha", "hb")).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    least_equal: int = 16,
    detail: bool = False,
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row; ids are whole numbers.

    A row's set are its distinct runs of ``words`` words (A-Z lower-cased, split at ASCII white space);
    a shorter text is one run. Two sets are linked if 100 * shared >= percent * united. A component is
    everything reachable by links; ``component_id`` is the smallest id in it, and ``kept`` says that the
    row has this id. Texts without words, and null, have ``n_shingles`` 0 and are linked with nothing.
    Rows without id take part and are not kept if their component has an id; without any,
    ``component_id`` is null and they are kept. Rows that repeat an id are told apart by their sets. With
    ``detail`` there are the columns ``digest`` of the set and ``component``, a number of the component, too.

    Signatures hold SLOTS MinHash values of LANE_BITS bits in CHUNKS chunks of LANES lanes. By
    pigeonhole two signatures that differ in at most 2 * CHUNKS - 1 lanes differ in at most one lane of
    some chunk, so that they share one of its keys, one per lane left out. All such pairs, and most
    further ones, are found: at a similarity of 0.8 a pair shares no key with a probability of about
    2e-5. The distance itself decides nothing: candidates that agree in at least ``least_equal`` lanes
    (fewer at similarity 0.8: about one in 10^8) are compared on their full sets.

    Equal sets are folded first. Every member of a bucket is compared with the bucket's smallest node;
    then buckets whose members are still in different components compare, across components, the
    members outside the largest component with all others. Pairs inside a component are never listed,
    and no pair across components is left out.
    """
    scanned = stored(_scan(docs, id_col, text_col, words, sets=False), "near-signatures")
    names = [f"s{i}" for i in range(CHUNKS)]
    sets = (
        scanned.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("low_id"), F.count("*").alias("rows"), F.first("n").alias("n"), *[F.first(s).alias(s) for s in names])
    )
    sets = stored(sets.withColumn("node", F.xxhash64("digest")), "near-sets")
    keys = _keys(sets)
    buckets = keys.groupBy("key").agg(F.count("*").alias("rows"), F.min("node").alias("leader")).where("rows > 1")
    members = stored(keys.join(buckets, "key").select("key", "kind", "node", "leader"), "near-members")

    full_sets = lambda nodes: _full_sets(nodes, sets, docs, id_col, text_col, words)
    linked = stored(_with_leaders(members, sets, full_sets, percent, least_equal), "near-links")
    linked = linked.union(stored(_across(members, sets, linked, full_sets, percent, least_equal), "near-links"))

    parts = connected_components(linked, "a", "b")
    named = sets.join(parts, "node", "left").select(
        "digest", "low_id", "rows", F.coalesce("component", "node").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("low_id").alias("component_id"), F.count("*").alias("sets"))
    named = attach_group_values(named, lowest, "component", "sets", "digest")
    named = named.select("digest", "component", "component_id", "rows")
    rows = attach_group_values(scanned.select("id", "n", "digest"), named, "digest", "rows", "id")
    part = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("id") == part, part.isNull())
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), part.alias("component_id"), kept.alias("kept"),
        *(["digest", "component"] if detail else []),
    )


def set_digests(rows: DataFrame, text_col: str = "text", words: int = 5) -> DataFrame:
    """``rows`` with ``digest``, that of each text's set as ``near_duplicates`` gives it; null without words."""
    names = rows.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for first, texts in pieces(batch, 1):
                found = [shingle_hashes(cache.of((t or b"").lower().split()), words) for t in texts]
                digests = pa.array([xxhash.xxh3_128_digest(f.tobytes()) if len(f) else None for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), digests], names=["row", "digest"])

    full = rows.select(packed(rows, names), col(text_col).cast("binary").alias("text"))
    kind = StructType([full.schema["row"], StructField("digest", BinaryType())])
    out = full.mapInArrow(scan, kind)
    return out.select(*unpacked(names), "digest")


def _groups(batches: Iterator[pa.RecordBatch], rows_at_once: int = 2 * BLOCK) -> Iterator[pa.Table]:
    """Runs of whole groups of rows sorted by column ``place``, each run about as large as the largest group.

    A group may begin in one batch and end in another.
    """
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


def _candidates(rows: pa.Table, percent: int, least_equal: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each minor row of each group, the positions of the other rows that it must be compared with.

    Rows of a group are ordered by ``minor``. Two texts meet in the first bucket they share only.
    """
    get = {c: rows.column(c).to_numpy() for c in ("place", "minor", "kind", "node", "part", "major", "n")}
    words = np.stack([rows.column(f"s{i}").to_numpy() for i in range(CHUNKS)], axis=1)
    lane = np.int64((1 << LANE_BITS) - 1) << (np.arange(LANES, dtype=np.int64) * LANE_BITS)
    starts = np.searchsorted(get["place"], get["place"])
    minor_at = np.flatnonzero(get["minor"])
    others = np.cumsum(~get["minor"])  # others of a group stand before its minor rows
    ends = others - np.where(starts > 0, others[starts - 1], 0) + starts
    for p in minor_at:
        q = np.arange(starts[p], ends[p])
        part, node, n = get["part"][q], get["node"][q], get["n"][q]
        fits = (part != get["part"][p]) & ((part == get["major"][p]) | (get["node"][p] < node))
        fits &= np.minimum(n, get["n"][p]) * 100 >= np.maximum(n, get["n"][p]) * percent
        q = q[fits]
        if not len(q):
            continue
        equal = (((words[q] ^ words[p])[:, :, None] & lane) == 0).sum(axis=2)
        shares = equal >= LANES - ERRORS
        first = shares.argmax(axis=1)
        chunk, left_out = divmod(int(get["kind"][p]), LANES)
        once = (first == chunk) & ((equal[np.arange(len(q)), first] < LANES) | (left_out == 0))
        q = q[once & (equal.sum(axis=1) >= least_equal)]
        if len(q):
            yield int(p), q


def _open_rows(percent: int, least_equal: int):
    """Rows ``(key, node)`` that have somebody to be compared with."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            found = np.zeros(len(rows), bool)
            for p, q in _candidates(rows, percent, least_equal):
                found[p] = found[q] = True
            yield from rows.select(["key", "node"]).filter(pa.array(found)).to_batches()

    return scan


def _confirmed(percent: int, least_equal: int):
    """Links ``(a, b)`` whose full sets reach the similarity."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            node, hashes = rows.column("node").to_numpy(), rows.column("hashes").combine_chunks()
            ends = hashes.offsets.to_numpy()
            ends = ends - ends[0]  # a run may be a slice of a batch
            distinct, flat = np.unique(hashes.flatten().to_numpy(), return_inverse=True)
            size, mark = np.diff(ends), np.zeros(len(distinct), np.int32)
            pairs = []
            for p, q in _candidates(rows, percent, least_equal):
                own = flat[ends[p] : ends[p + 1]]
                mark[own] = 1
                low, high = q[0], q[-1] + 1
                shared = np.add.reduceat(mark[flat[ends[low] : ends[high]]], ends[low:high] - ends[low])[q - low]
                mark[own] = 0
                q = q[shared * 100 >= (size[p] + size[q] - shared) * percent]
                pairs.append(np.stack([np.minimum(node[p], node[q]), np.maximum(node[p], node[q])]))
            if pairs:
                a, b = np.concatenate(pairs, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return scan


def _across(
    members: DataFrame, sets: DataFrame, linked: DataFrame, full_sets, percent: int, least_equal: int
) -> DataFrame:
    """Links ``(a, b)`` between members of a bucket that are still in different components.

    The members outside a bucket's largest component, its minor rows, meet all others, in blocks of at
    most BLOCK by BLOCK rows, so that a hot bucket is dealt over many tasks. Pairs are formed inside
    the task and only links come out. Full sets are attached only to members that have a partner which
    sizes and signatures do not rule out.
    """
    parts = connected_components(linked, "a", "b")
    placed = members.join(parts, "node", "left").select(
        "key", "kind", "node", F.coalesce("component", "node").alias("part")
    )
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("rows"))
    mixed = sizes.groupBy("key").agg(
        F.max_by("part", "rows").alias("major"), F.sum("rows").alias("all_rows"), F.max("rows").alias("most")
    )
    mixed = mixed.where("all_rows > most")
    signed = sets.select("node", "n", *[f"s{i}" for i in range(CHUNKS)])
    placed = stored(placed.join(mixed, "key").join(signed, "node"), "near-mixed")

    def dealt(rows: DataFrame) -> DataFrame:
        blocks, minors = F.ceil(F.col("all_rows") / BLOCK), F.ceil((F.col("all_rows") - F.col("most")) / BLOCK)
        own, steps = F.xxhash64("node"), lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
        one = rows.withColumn("minor", F.lit(False)).withColumn("i", F.pmod(own, blocks))
        one = one.withColumn("j", F.explode(steps(minors)))
        two = rows.where("part <> major").withColumn("minor", F.lit(True)).withColumn("j", F.pmod(own, minors))
        two = two.withColumn("i", F.explode(steps(blocks)))
        out = one.unionByName(two).withColumn("place", F.xxhash64("key", "i", "j")).drop("i", "j", "all_rows", "most")
        return out.repartition("place").sortWithinPartitions("place", "minor")

    waiting = dealt(placed).mapInArrow(_open_rows(percent, least_equal), "key bigint, node bigint")
    waiting = stored(waiting.distinct(), "near-waiting")
    full = stored(full_sets(waiting.select("node")), "near-full")
    rows = placed.join(waiting, ["key", "node"]).join(full, "node")
    return dealt(rows).mapInArrow(_confirmed(percent, least_equal), "a bigint, b bigint").distinct()
