"""Mixing sources to target weights: fixed blocks of words, multinomial counts per shard, index permutations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import SPACE_CLASS, col, scrambled, stored, unused

BLOCK_WORDS = 128
SHARDS = 16
#: Words of one run of documents that are laid out together; more words, more runs.
RUN_WORDS = 1_000_000
#: Slots of one row of the expansion, so that no row holds an unbounded list.
SLOT_CHUNK = 4096
MAX_EPOCHS = 2


def targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` for one row per source with its ``source_size``.

    Sources in code point order, null last, take the weights in turn. The targets add up to ``share``
    times all sizes, in proportion to the weights, but none exceeds ``cap`` times its source; what that
    leaves over goes to the others by weight until it fits. The common factor follows from the sources
    in the order in which they reach their cap, so there is nothing to iterate.
    """
    everything = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("__rank", F.lit(len(weights))) + 1)
    rows = sizes.withColumn("__rank", (F.row_number().over(everything) - 1).cast("int")).withColumn("__w", weight)
    limit = F.col("source_size") * F.lit(float(cap))
    rows = rows.withColumn("__limit", limit)
    full = Window.orderBy(F.col("__limit") / F.col("__w"), "__rank")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = rows.withColumn("__want", F.sum("source_size").over(whole) * F.lit(float(share)))
    # If this source and all that reach their cap later stay below it, this is the common factor.
    factor = (F.col("__want") - F.coalesce(F.sum("__limit").over(before), F.lit(0.0))) / F.sum("__w").over(after)
    rows = rows.withColumn("__factor", factor)
    fits = F.when(F.col("__factor") * F.col("__w") <= F.col("__limit"), F.col("__factor"))
    rows = rows.withColumn("__level", F.max(fits).over(whole))
    target = F.least("__limit", F.coalesce(F.col("__level") * F.col("__w"), F.col("__limit")))
    return rows.select("source", "source_size", target.alias("target"))


def _source_seed(source: str | None, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(b"\0" if source is None else b"\1" + source.encode(), seed & 0xFFFFFFFF)


def _draw(seed: int, shards: int):
    """Per source, multinomial counts of its slots over the shards: the sources' shares of each shard."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for source, blocks, slots in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                random = np.random.default_rng(_source_seed(source, seed))
                counts = random.multinomial(slots, np.full(shards, 1 / shards))
                first = np.cumsum(counts) - counts
                out += [(source, blocks, s, int(f), int(c)) for s, (f, c) in enumerate(zip(first, counts)) if c]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["source", "blocks", "shard", "first", "slots"])

    return draw


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of [0, size) under ``key``: four Feistel rounds, walked until inside."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, open_ = index.astype(np.uint64), np.arange(len(index))
    while len(open_):
        h, m, k = half[open_], mask[open_], key[open_]
        left, right = out[open_] >> h, out[open_] & m
        for turn in range(4):
            left, right = right, left ^ (scrambled(right + k + np.uint64(turn << 56)) & m)
        out[open_] = (left << h) | right
        open_ = open_[out[open_] >= size[open_].astype(np.uint64)]
    return out.astype(np.int64)


def _chosen(seed: int):
    """Slot numbers to (epoch, block): each epoch of a source is a permutation of its own."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds: dict[str | None, int] = {}
        for batch in batches:
            sources = batch.column(0).dictionary_encode()
            for s in sources.dictionary.to_pylist() + [None]:
                seeds.setdefault(s, _source_seed(s, seed))
            lookup = np.array([seeds[s] for s in sources.dictionary.to_pylist()] + [seeds[None]], np.uint64)
            codes = sources.indices.fill_null(len(lookup) - 1).to_numpy(zero_copy_only=False)
            blocks, slot = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            epoch, index = np.divmod(slot, blocks)
            key = scrambled(lookup[codes] + epoch.astype(np.uint64))
            block = permuted(index, blocks, key)
            columns = [batch.column(0), pa.array(block), batch.column(2), batch.column(3), pa.array(epoch)]
            names = ["source", "block", "shard", "slot", "epoch"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            if len(seeds) > 100_000:
                seeds.clear()

    return choose


def slots(plan: DataFrame, seed: int = 1, shards: int = SHARDS) -> DataFrame:
    """``(source, block, shard, slot, epoch)``: one row per slot of the mix, for ``(source, blocks, slots)``."""
    drawn = plan.select("source", "blocks", "slots").mapInArrow(
        _draw(seed, shards), "source string, blocks bigint, shard int, first bigint, slots bigint"
    )
    zero = F.lit(0).cast("bigint")
    chunk = F.explode(F.sequence(zero, F.floor((F.col("slots") - 1) / SLOT_CHUNK)))
    rows = drawn.withColumn("chunk", chunk).repartition("source", "shard", "chunk")
    low = F.col("first") + F.col("chunk") * SLOT_CHUNK
    high = F.least(low + (SLOT_CHUNK - 1), F.col("first") + F.col("slots") - 1)
    rows = rows.select("source", "blocks", "shard", F.explode(F.sequence(low, high)).alias("slot"))
    return rows.mapInArrow(_chosen(seed), "source string, block bigint, shard int, slot bigint, epoch bigint")


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"{SPACE_CLASS}+"))).cast("bigint")


#: Names of columns that laid-out documents have besides their own.
RESERVED = ("__source", "__size", "__start")


def _freed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with other names for columns that are called like RESERVED ones, and the names by the old ones."""
    names = {c: f"__own_{i}" if c.lower() in RESERVED or c.lower().startswith("__own_") else c for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def laid_out(docs: DataFrame, source_col: str, text_col: str, run_words: int = RUN_WORDS) -> tuple:
    """Documents with ``size`` (words) and ``start``, their place in the stream of words of their source.

    Returns those rows and the table of sources with their sizes. A source is cut by a hash of the rows
    into runs of about ``run_words`` words; the order inside a run is that of the hash. The sums of the
    runs give each run's place, and a header row with that place opens it, so one shuffle suffices and
    no task holds a source.
    """
    names = [unused(docs, n) for n in ("__source", "__size", "__hash", "__run", "__head", "__start", "__s", "__n")]
    source, size, hashed, run, head, start, of, number = names
    measured = docs.select(
        "*",
        col(source_col).cast("string").alias(source),
        word_count(col(text_col)).alias(size),
        F.xxhash64(*[F.to_json(F.struct(col(c))) if _unhashable(docs, c) else col(c) for c in docs.columns]).alias(
            hashed
        ),
    )
    totals = stored(measured.groupBy(source).agg(F.sum(size).alias("source_size")), "mixing-sources")
    runs = totals.select(
        F.col(source).alias(of), F.greatest(F.lit(1), F.ceil(F.col("source_size") / run_words)).alias(number)
    )
    # One row per source; null is a source.
    placed = measured.join(runs, F.col(source).eqNullSafe(F.col(of)))
    placed = placed.withColumn(run, F.pmod(F.col(hashed), F.col(number))).drop(of, number)
    sums = placed.groupBy(source, run).agg(F.sum(size).alias("words"))
    before = Window.partitionBy(source).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.select(source, run, F.coalesce(F.sum("words").over(before), F.lit(0)).alias(size))
    heads = stored(heads.withColumn(head, F.lit(True)), "mixing-heads")
    rows = placed.withColumn(head, F.lit(False)).unionByName(heads, allowMissingColumns=True)
    order = Window.partitionBy(source, run).orderBy(F.desc(head), hashed)
    total = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn(start, total - F.col(size)).where(~F.col(head))
    rows = rows.select(*[col(c) for c in docs.columns], F.col(size).alias("__size"), F.col(start).alias("__start"), F.col(source).alias("__source"))
    return rows, totals.withColumnRenamed(source, "source")


def _unhashable(docs: DataFrame, name: str) -> bool:
    return "map<" in docs.schema[name].dataType.simpleString()


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _word_begins(text: bytes) -> np.ndarray:
    word = ~_SPACE[np.frombuffer(text, np.uint8)]
    return np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))


def _pieces(block_words: int, keep: Sequence[str], text_at: int):
    """Cuts texts at block boundaries: a row per document and block, with the text of the words in it.

    White space stays with the word before it, so a text's pieces add up to the text.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("__start").to_numpy()
            values = batch.column(text_at)
            row, block, first, count, texts, held = [], [], [], [], [], 0

            def flush():
                take = batch.select(list(keep)).take(pa.array(row, pa.int64()))
                new = [pa.array(block, pa.int64()), pa.array(first, pa.int64()), pa.array(count, pa.int64())]
                new.append(pa.array(texts, pa.binary()).cast(pa.string()))
                return pa.RecordBatch.from_arrays(
                    [*take.columns, *new], names=[*keep, "block", "first_word", "n_words", "piece"]
                )

            for i in range(len(values)):
                text = values[i].as_py() or b""
                begins = _word_begins(text)
                place, words = int(starts[i]), len(begins)
                edges = np.arange((place // block_words + 1) * block_words - place, words, block_words)
                edges = [0, *edges.tolist(), words] if words else []
                for at, end in zip(edges, edges[1:]):
                    piece = text[int(begins[at]) if at else 0 : int(begins[end]) if end < words else len(text)]
                    row.append(i)
                    block.append((place + at) // block_words)
                    first.append(at)
                    count.append(end - at)
                    texts.append(piece)
                    held += len(piece)
                if held > 8 << 20:
                    yield flush()
                    row, block, first, count, texts, held = [], [], [], [], [], 0
            if row:
                yield flush()

    return cut


def _planned(sizes: DataFrame, weights: Sequence[float], share: float, block_words: int) -> DataFrame:
    """Sources with their targets and their numbers of blocks and slots."""
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.round(blocks * F.col("target") / F.greatest("source_size", F.lit(1))).cast("bigint")
    rows = targets(sizes, weights, share).withColumn("blocks", blocks)
    return stored(rows.withColumn("slots", F.least(wanted, blocks * MAX_EPOCHS)), "mixing-plan")


def mix(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    keep: Sequence[str] = ("doc_id",),
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 1,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix, its sources, and the laid-out documents.

    Words are runs of characters other than ASCII white space. The words of each source form one stream
    that is packed into blocks of ``block_words`` (the last may be shorter). A source with a target of t
    words out of s gets round(blocks * t / s) slots, so its words come near the target; they are drawn
    over the shards by a multinomial, and the slots of each epoch run through a permutation of the
    source's blocks. No block is taken more than ``MAX_EPOCHS`` times. The same rows, seed and
    parameters give the same mix.

    The mix has one row per slot and document piece: ``shard, slot, epoch, source, block``, the ``keep``
    columns of the document, ``doc_start`` (with ``source`` it tells documents apart), ``first_word,
    n_words`` and ``piece``, the part of the text that falls into the block. Documents without words take no part; no source, an empty table
    or sizes of zero give an empty mix. Rows that repeat are documents of their own. Columns of
    ``keep`` that are called like an output column are left out.
    """
    outputs = {"shard", "slot", "epoch", "source", "block", "doc_start", "first_word", "n_words", "piece"}
    kept = [c for c in keep if c.lower() not in outputs]
    docs, names = _freed(docs)
    source_col, text_col = names[source_col], names[text_col]
    rows, sizes = laid_out(docs, source_col, text_col)
    plan = _planned(sizes, weights, share, block_words)
    chosen = slots(plan.where("slots > 0"), seed, shards)
    flat = rows.select(
        *[col(names[c]).alias(f"k{i}") for i, c in enumerate(kept)], "__source", "__start", col(text_col).cast("binary").alias("text")
    )
    names = [f"k{i}" for i in range(len(kept))] + ["__source", "__start"]
    numbers = [StructField(n, LongType()) for n in ("block", "first_word", "n_words")]
    out = StructType([*[flat.schema[n] for n in names], *numbers, StructField("piece", StringType())])
    cut = flat.mapInArrow(_pieces(block_words, names, len(names)), out)
    # Slots are expanded from a few rows, so their size is not known to the planner: never to be broadcast.
    joined = cut.withColumnRenamed("block", "b").join(
        chosen.hint("merge"), (F.col("b") == F.col("block")) & F.col("__source").eqNullSafe(F.col("source"))
    )
    mixed = joined.select(
        "shard", "slot", "epoch", "source", "block", *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
        F.col("__start").alias("doc_start"), "first_word", "n_words", "piece",
    )
    return mixed, plan, rows


def _assembled(names: Sequence[str]):
    """Texts made of the word spans that an epoch takes, in their order."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                begins = _word_begins(text)
                cut = lambda w: 0 if w == 0 else int(begins[w]) if w < len(begins) else len(text)
                texts.append(b"".join(text[cut(s["first"]) : cut(s["end"])] for s in spans))
            columns = [*[batch.column(n) for n in names], pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "text"])

    return assemble


def mix_documents(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    keep: Sequence[str] = ("doc_id",),
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = 1,
) -> DataFrame:
    """The mix of ``mix`` as documents: ``epoch``, the ``keep`` columns and ``text``, what that epoch takes.

    Which blocks are taken is decided on places and lengths alone; a document gets the list of its word
    spans, so its text moves once to be laid out and once to meet them, whatever the number of blocks.
    Columns of ``keep`` called ``epoch`` or ``text`` are left out.
    """
    kept = [c for c in keep if c.lower() not in ("epoch", "text")]
    docs, own = _freed(docs)
    source_col, text_col = own[source_col], own[text_col]
    rows, sizes = laid_out(docs, source_col, text_col)
    chosen = slots(_planned(sizes, weights, share, block_words).where("slots > 0"), seed, shards)
    low = lambda: F.floor(F.col("__start") / block_words)
    high = F.floor((F.col("__start") + F.col("__size") - 1) / block_words)
    held = rows.where("__size > 0").select("__source", "__start", "__size", F.explode(F.sequence(low(), high)).alias("b"))
    place = F.col("b") * block_words - F.col("__start")
    held = held.withColumn("first", F.greatest(place, F.lit(0)))
    held = held.withColumn("end", F.least(place + block_words, F.col("__size"))).drop("__size")
    taken = held.join(
        chosen.hint("merge"), (F.col("b") == F.col("block")) & F.col("__source").eqNullSafe(F.col("source"))
    )
    spans = taken.groupBy(F.col("__source").alias("s"), F.col("__start").alias("at"), "epoch").agg(
        F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans")
    )
    names = ["epoch", *[f"k{i}" for i in range(len(kept))]]
    texts = rows.where("__size > 0").select(
        "__source", "__start", *[col(own[c]).alias(n) for c, n in zip(kept, names[1:])], col(text_col).cast("binary").alias("text")
    )
    joined = texts.join(spans, F.col("__source").eqNullSafe(F.col("s")) & (F.col("__start") == F.col("at")))
    joined = joined.select(*names, "text", "spans")
    schema = StructType([*[joined.schema[n] for n in names], StructField("text", StringType())])
    out = joined.mapInArrow(_assembled(names), schema)
    return out.select("epoch", *[F.col(n).alias(c) for c, n in zip(kept, names[1:])], "text")
