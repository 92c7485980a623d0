"""Near-duplicate texts: equal after normalization, or alike in their word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import block_join
from ..plans.components import connected_components
from ..plans.lineage import durable, written
from ..plans.skew import attach_group_values

SHINGLE_WORDS = 5
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier, the golden ratio in 64 bits
COUNTERS = 1 << 20  # counters of shingles, at any size of the table; they decide an order only
NODE_WORDS = 1 << 18  # of 64 bits, at any size of the table; they only spare a shuffle most rows that it does not need


def normalized_text(col: Column | str) -> Column:
    """Lower case, white space runs as one blank, none at the ends."""
    text = F.lower(F.col(col) if isinstance(col, str) else col)
    for space in "\t\n\r\f\v":
        text = F.replace(text, F.lit(space), F.lit(" "))
    # Most texts have single blanks by now and are spared the regular expression.
    return F.trim(F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text))


def _with_exact_clusters(digests: DataFrame, id_col: str) -> DataFrame:
    """Adds ``__first``, the smallest id with the same digest, to rows that are not alone with theirs."""
    groups = (
        digests.where(F.col("__digest").isNotNull())
        .groupBy("__digest")
        .agg(F.count("*").alias("__n"), F.min(id_col).alias("__first"))
        .where(F.col("__n") > 1)
    )
    return attach_group_values(digests, groups, "__digest", "__n", id_col).drop("__n")


def exact_duplicates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, is_near_duplicate, near_duplicate_cluster_id)``; a cluster is named by its smallest id.

    The texts are read once and kept as digests in the checkpoint folder. Rows without text are in no
    cluster. A text that fills a large part of the table is aggregated per task and joined back by a
    bounded broadcast.
    """
    digests = durable(df.select(F.col(id_col), F.md5(normalized_text(text_col)).alias("__digest")))
    return _with_exact_clusters(digests, id_col).select(
        id_col,
        F.col("__first").isNotNull().alias("is_near_duplicate"),
        F.col("__first").alias("near_duplicate_cluster_id"),
    )


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + count - 1`` of all ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


def _shingles(word_hashes: np.ndarray, ends: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of all runs of ``words`` words of many texts, sorted in each text, and where each text ends.

    A shorter text is one run. Products wrap at 64 bits.
    """
    starts, length = np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
    texts, hashes = [], []
    for width in range(1, words + 1):
        of = np.flatnonzero(length >= words if width == words else length == width)
        at = _ranges(starts[of], length[of] - width + 1)
        runs = np.full(len(at), width, np.uint64)
        for j in range(width):
            runs = runs * MIX + word_hashes[at + j]
        texts.append(np.repeat(of, length[of] - width + 1))
        hashes.append((runs ^ (runs >> np.uint64(32))) * MIX)
    text, flat = np.concatenate(texts), np.concatenate(hashes)
    by = np.lexsort((flat, text))
    text, flat = text[by], flat[by]
    new = np.ones(len(flat), bool)
    new[1:] = (text[1:] != text[:-1]) | (flat[1:] != flat[:-1])
    return flat[new], np.cumsum(np.bincount(text[new], minlength=len(ends)))


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column, and where each list ends; null is an empty list."""
    lists = column.fill_null([])
    return lists.flatten().to_numpy().view(np.uint64), np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))


def shingle_sets(df: DataFrame, id_col: str, text_col: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, digest, hashes)``: of the normalized text its MD5 and the distinct hashes of its word shingles.

    The digest is null for null, the set is empty for null and for an empty text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _lists(*_shingles(*_flat(batch.column(2)), words))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sets], names=["id", "digest", "hashes"])

    normalized = df.select(F.col(id_col).cast("bigint").alias("id"), normalized_text(text_col).alias("text"))
    # The words are a column of their own: an expression inside a lambda is evaluated per element.
    split = normalized.select("id", "text", F.when(F.col("text") != "", F.split("text", " ")).alias("words"))
    hashed = split.select("id", F.unhex(F.md5("text")).alias("digest"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    return hashed.mapInArrow(scan, "id bigint, digest binary, hashes array<bigint>")


def _counters(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall on each of COUNTERS counters: a table of a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            table += np.bincount((_flat(batch.column(0))[0] % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(table[used])], names=["at", "n"])

    sums = sets.select("hashes").mapInArrow(count, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(COUNTERS, np.int64)
    table[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return table


def _prefix_keys(sets: DataFrame, percent: int) -> DataFrame:
    """``(key, node)``: of each set of n shingles, the rarest n - ceil(percent * n / 100) + 1.

    Two sets that reach the similarity have a shingle in common among these, as the order (counter, hash)
    is the same for all; what ties with the last one is a key too. A shingle of many texts stands out from
    the load of its counter, so that it is a key only where nearly all shingles of a text are frequent. Of keys with
    the same nodes, told by their number and four sums of their hashes, one is kept: the pairs are the same.
    """
    shared = sets.sparkSession.sparkContext.broadcast(_counters(sets))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            flat, ends = _flat(batch.column(1))
            n = np.diff(ends, prepend=0)
            text = np.repeat(np.arange(len(n)), n)
            load = np.minimum(table[(flat % np.uint64(len(table))).astype(np.int64)], (1 << 30) - 1).astype(np.uint64)
            rank = (load << np.uint64(34)) | (flat >> np.uint64(30))
            last = (ends - n + n - -(-n * percent // 100))[n > 0]  # in each sorted text, the place of the last key
            bound = np.zeros(len(n), np.uint64)
            bound[n > 0] = rank[np.lexsort((rank, text))][last]
            kept = rank <= bound[text]
            nodes = batch.column(0).to_numpy()[text[kept]]
            yield pa.RecordBatch.from_arrays([pa.array(flat[kept].view(np.int64)), pa.array(nodes)], names=["key", "node"])

    keys = sets.select("node", "hashes").mapInArrow(scan, "key bigint, node bigint")
    # Sums, as an id that occurs several times must not cancel itself out; of 32 bits each, so that none overflows.
    hashes = [F.xxhash64("node", F.lit(seed)) for seed in (0, 1)]
    halves = [half for h in hashes for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    sums = [F.sum(half).alias(f"__s{i}") for i, half in enumerate(halves)]
    several = keys.groupBy("key").agg(F.count("*").alias("__n"), *sums).where("__n > 1")
    several = several.groupBy("__n", *[f"__s{i}" for i in range(len(sums))]).agg(F.min("key").alias("__key")).select("__key")
    return written(keys.join(several, F.col("key") == F.col("__key")).drop("__key"), "near-keys")


def _alike(percent: int):
    """For rows with ``hashes``: whether one set and each of some others reach the similarity, in whole numbers."""

    def test_of(rows: pa.Table):
        flat, ends = _flat(rows.column("hashes").combine_chunks())
        starts, size = np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)

        def test(p: int, q: np.ndarray) -> np.ndarray:
            out = np.minimum(size[q], size[p]) * 100 >= np.maximum(size[q], size[p]) * percent
            q = q[out]
            if len(q):
                own, others = flat[starts[p] : ends[p]], flat[_ranges(starts[q], size[q])]
                hits = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
                sums = np.concatenate([[0], np.cumsum(hits)])[np.concatenate([[0], np.cumsum(size[q])])]
                shared = np.diff(sums)
                out[out] = shared * 100 >= (size[q] + size[p] - shared) * percent
            return out

        return test

    return test_of


def _sketches(sets: DataFrame) -> DataFrame:
    """``(node, size, sketch)``: of each set its size and a bit per remainder of its hashes, set where an odd number have it.

    There are as many bits as shingles or up to twice as many, a power of two, so a sketch is a 32nd to a 64th of its set.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _flat(batch.column(1))
            size, sketches = np.diff(ends, prepend=0), []
            for n, end in zip(size.tolist(), ends.tolist()):
                width = 1 << max(6, (n - 1).bit_length())
                odd = np.bincount((flat[end - n : end] & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
                sketches.append(np.packbits(odd.astype(bool), bitorder="little").tobytes())
            columns = [batch.column(0), pa.array(size), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "sketch"])

    return sets.select("node", "hashes").mapInArrow(scan, "node bigint, size bigint, sketch binary")


def _maybe_alike(percent: int):
    """For rows with ``size`` and ``sketch``: whether one set and each of some others may reach the similarity.

    Where two sketches differ, at least one shingle is in one set only. Sets that reach the similarity differ in no more than
    (100 - percent) / (100 + percent) of the sum of their sizes, so none of them is missed.
    """

    def test_of(rows: pa.Table):
        size = rows.column("size").to_numpy()
        sketches = rows.column("sketch").combine_chunks()
        width = pc.binary_length(sketches).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, flat = np.cumsum(width) - width, np.frombuffer(b"".join(sketches.to_pylist()), np.uint8)

        def folded(at: np.ndarray, wide: int, least: int) -> np.ndarray:
            bits = flat[starts[at][:, None] + np.arange(wide)]
            return np.bitwise_xor.reduce(bits.reshape(len(at), wide // least, least), axis=1)

        def test(p: int, q: np.ndarray) -> np.ndarray:
            out = np.minimum(size[q], size[p]) * 100 >= np.maximum(size[q], size[p]) * percent
            for wide in np.unique(width[q[out]]):
                at = np.flatnonzero(out & (width[q] == wide))
                least = min(wide, width[p])
                apart = folded(q[at], wide, least) ^ folded(np.array([p]), width[p], least)
                least_apart = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
                out[at] = least_apart * (100 + percent) <= (size[q[at]] + size[p]) * (100 - percent)
            return out

        return test

    return test_of


def _likely_among(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of ``nodes`` and few others: a table of a fixed size, a bit per remainder of a node's hash, is broadcast."""
    h = F.xxhash64("node")
    word, bit = F.pmod(F.shiftright(h, 6), F.lit(NODE_WORDS)).alias("__word"), h.bitwiseAND(63).cast("int").alias("__bit")
    # Shifting by a column is an SQL function only.
    table = nodes.select(word, bit).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    marked = sets.select("*", word, bit).join(F.broadcast(table), "__word")
    return marked.where(F.expr("shiftright(__bits, __bit) & 1L = 1L")).select(*sets.columns)


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` with the same components as all pairs of ``(node, hashes)`` that reach the similarity.

    The sets that share a key are first compared with the smallest of them. Then, where they are still
    in several components, those outside the largest one are compared with all others of other
    components, block by block inside tasks. Pairs inside a component are never formed, none across
    components is left out. Sketches of the sets travel to every place, the sets themselves only where
    the sketches leave a pair open.
    """
    members, sketches = _prefix_keys(sets, percent), written(_sketches(sets), "near-sketches")

    def compared(dealt: DataFrame) -> DataFrame:
        open_ = written(block_join.likely(dealt, sketches, _maybe_alike(percent)).distinct(), "near-open")
        return written(block_join.links(open_, _likely_among(sets, open_.select("node")), _alike(percent)), "near-links")

    led = compared(block_join.beside_leaders(members))
    parts = written(connected_components(led, "a", "b"), "near-parts")
    rest = compared(block_join.across_parts(members, parts))
    known = parts.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return known.union(rest)


def near_duplicates(
    df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, words: int = SHINGLE_WORDS
) -> DataFrame:
    """``(id, is_near_duplicate, near_duplicate_cluster_id)`` with clusters of equal and alike texts.

    Alike means a Jaccard similarity of the word shingles of at least ``threshold``, taken in whole
    percent. Clusters are the connected components of all alike pairs, named by their smallest id; no
    pair is missed. Ids are whole numbers. Rows without text are in no cluster, empty texts are copies
    of one another.

    Texts are read once. Equal ones are folded, and a prefix-filtered set join finds the pairs of the
    rest: see ``_prefix_keys`` and ``_links``.
    """
    percent = round(threshold * 100)
    scanned = written(shingle_sets(df.select(id_col, text_col), id_col, text_col, words), "near-sets")
    digests = scanned.select(F.col("id").alias(id_col), F.col("digest").alias("__digest"))
    exact = written(_with_exact_clusters(digests, id_col).drop("__digest"), "near-exact")
    copies = exact.where(F.col("__first") != F.col(id_col)).select(F.col(id_col).alias("id"))
    sets = scanned.where((F.size("hashes") > 0) & F.col("id").isNotNull()).join(copies, "id", "left_anti").select(F.col("id").alias("node"), "hashes")
    edges = _links(written(sets, "near-singles"), percent)
    clusters = connected_components(edges, "a", "b").select(
        F.col("node").alias("__node"), F.col("component").alias("__cluster")
    )
    linked = exact.withColumn("__node", F.coalesce("__first", F.col(id_col)))
    # One row per node; a hot node is a group of equal texts, spread by its row ids.
    counted = linked.groupBy("__node").agg(F.count("*").alias("__n")).join(clusters, "__node")
    joined = attach_group_values(linked, counted, "__node", "__n", id_col)
    cluster = F.coalesce("__cluster", "__first")
    return joined.select(
        id_col,
        cluster.isNotNull().alias("is_near_duplicate"),
        cluster.alias("near_duplicate_cluster_id"),
    )
