"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import MIX, col, packed, pieces, scrambled, stored, unpacked

WINDOW = 10
SHINGLE = 3
#: Windows of one block of the index; its arrays and words take about 20 MB.
BLOCK_WINDOWS = 50_000

# ASCII letters in lower case, digits and all bytes of other characters are parts of words.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


def _runs(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` ids."""
    out = np.full(max(0, len(ids) - width + 1), width, np.uint64)
    for j in range(width):
        out = out * MIX + ids[j : len(ids) - width + 1 + j].astype(np.uint64)
    return scrambled(out)


class Index:
    """Windows as rows of word ids, their shingles, and per window the rarest shingle with its place."""

    def __init__(self, windows: list[bytes], owners: list[list[str]], shingle: int):
        split = [w.split() for w in windows]
        self.ids: dict[bytes, int] = {}
        rows = [[self.ids.setdefault(w, len(self.ids) + 1) for w in words] for words in split]
        self.owners = owners
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.words = np.zeros((len(rows), int(self.lengths.max())), np.int64)
        for row, line in zip(rows, self.words):
            line[: len(row)] = row
        self.widths = sorted({min(shingle, len(r)) for r in rows})
        hashed = [_runs(np.array(r), min(shingle, len(r))) for r in rows]
        self.shingles, place = np.unique(np.concatenate(hashed), return_inverse=True)
        self.of_window = np.split(place, np.cumsum([len(h) for h in hashed])[:-1])
        self._filter(self.shingles)

    def _filter(self, wanted: np.ndarray) -> None:
        self.wanted, self.maybe = wanted, np.zeros(1 << 20, bool)
        self.maybe[(wanted >> np.uint64(44)).astype(np.int64)] = True

    def order(self, counts: np.ndarray) -> None:
        """A window all of whose shingles must occur needs a prefix of one: its rarest in the documents."""
        offsets = np.array([np.lexsort((s, counts[s]))[0] for s in self.of_window], np.int64)
        prefix = np.array([s[o] for s, o in zip(self.of_window, offsets)], np.int64)
        by = np.argsort(prefix, kind="stable")
        used, first = np.unique(prefix[by], return_index=True)
        self.by_prefix, self.offsets = by, offsets
        self.first, self.last = first, np.append(first[1:], len(by))
        self._filter(self.shingles[used])
        del self.of_window

    def occurrences(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions at which a wanted shingle starts, and its number."""
        for width in self.widths:
            hashes = _runs(ids, width)
            at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
            number = np.minimum(np.searchsorted(self.wanted, hashes[at]), len(self.wanted) - 1)
            sure = self.wanted[number] == hashes[at]
            yield at[sure], number[sure]

    def matches(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences of windows: first position and window. ``ends`` is each position's end of document."""
        starts, windows = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at, number in self.occurrences(ids):
            many = self.last[number] - self.first[number]
            at, number = np.repeat(at, many), np.repeat(number, many)
            step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            window = self.by_prefix[self.first[number] + step]
            start = at - self.offsets[window]  # the only place where the window can begin
            fits = start >= 0
            fits[fits] = start[fits] + self.lengths[window[fits]] <= ends[at[fits]]
            start, window = start[fits], window[fits]
            same = np.ones(len(start), bool)
            for j in range(self.words.shape[1]):
                inside = j < self.lengths[window]
                same &= ~inside | (ids[np.minimum(start + j, len(ids) - 1)] == self.words[window, j])
            starts.append(start[same])
            windows.append(window[same])
        return np.concatenate(starts), np.concatenate(windows)


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """``(window, owners)``: distinct runs of ``window`` words, and the ids of the items that hold them.

    An item of fewer words, but not none, is one window. An item without id owns its windows as "".
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                runs = range(max(1, len(words) - window + 1) if words else 0)
                found += {(name or "", b" ".join(words[i : i + window])) for i in runs}
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["owner", "window"])

    rows = items.select(col(id_col).cast("string").alias("owner"), col(text_col).cast("binary").alias("text"))
    rows = rows.mapInArrow(scan, "owner string, window binary")
    return rows.groupBy("window").agg(F.collect_set("owner").alias("owners"))


def _documents(index: Index, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of texts, one 0 after each; where each text begins; its number of words."""
    words, counts = [], []
    for text in texts:
        found = words_of(text)
        counts.append(len(found))
        words += found
        words.append(b"")
    ids = np.fromiter(map(index.ids.get, words, repeat(0)), np.int64, len(words))
    counts = np.array(counts, np.int64)
    return ids, np.cumsum(counts + 1) - counts - 1, counts


def _index_of(values: dict) -> Index:
    """The index of broadcast plain values, which executors can read without the class."""
    index = object.__new__(Index)
    index.__dict__.update(values)
    return index


def _counted(shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index_of(shared.value)
        total = np.zeros(len(index.shingles), np.int64)
        for batch in batches:
            for _, texts in pieces(batch, 0):
                for _, number in index.occurrences(_documents(index, texts)[0]):
                    total += np.bincount(number, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["shingle", "n"])

    return scan


def _marked(shared, text_at: int, kept: Sequence[str], schema: pa.Schema, found_before: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index_of(shared.value)
        for batch in batches:
            for first, texts in pieces(batch, text_at):
                rows = batch.slice(first, len(texts))
                ids, begins, counts = _documents(index, texts)
                hit, owners = np.zeros(len(ids) + 1, bool), [set() for _ in texts]
                if found_before:
                    for i, spans in enumerate(rows.column("hit_spans").to_pylist()):
                        for span in spans:
                            hit[begins[i] + span["start"] : begins[i] + span["end"]] = True
                    owners = [set(o) for o in rows.column("item_ids").to_pylist()]
                start, window = index.matches(ids, np.repeat(begins + counts, counts + 1))
                for j in range(index.words.shape[1]):
                    hit[start[j < index.lengths[window]] + j] = True
                document = np.searchsorted(begins, start, side="right") - 1
                for i, w in set(zip(document.tolist(), window.tolist())):
                    owners[i].update(index.owners[w])
                sums = np.concatenate([[0], np.cumsum(hit)])
                edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                edges = edges.reshape(-1, 2)
                of = np.searchsorted(begins, edges[:, 0], side="right") - 1
                spans = [[] for _ in texts]
                for i, (a, b) in zip(of.tolist(), edges.tolist()):
                    spans[i].append({"start": a - int(begins[i]), "end": b - int(begins[i])})
                new = {
                    "n_words": counts,
                    "n_hit": sums[begins + counts] - sums[begins],
                    "hit_spans": spans,
                    "item_ids": [sorted(o) for o in owners],
                }
                columns = [rows.column(name) for name in kept]
                columns += [pa.array(v, schema.field(k).type) for k, v in new.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    return scan


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: Sequence[str] | None = None,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) plus ``n_words, n_hit, hit_spans, item_ids``.

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower case. A word of
    a document is hit if it lies inside an occurrence of a window of an item; ``hit_spans`` are the runs
    of hit words (end exclusive), ``item_ids`` the items that have an occurring window, as sorted strings.

    Each window is a set of word shingles that must all occur, so the necessary prefix is one shingle.
    A first pass over the documents counts the windows' shingles; the second looks for the rarest
    shingle of each window, which leaves one place where the window can begin, checks that it fits
    between the document's ends, and compares all words. The index is dealt into blocks of about
    ``block_windows`` windows, of which one at a time is broadcast, so its size has a bound; more items
    mean more passes. Documents are not shuffled.

    Null and empty texts have no words. Items without words have no windows; without any windows
    nothing is hit. Rows are neither dropped nor merged. Output columns replace columns of the same name.
    """
    spark = docs.sparkSession
    outputs = ["n_words", "n_hit", "hit_spans", "item_ids"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    windows = stored(item_windows(items, item_id, item_text, window), "decontaminate-windows")
    blocks = max(1, -(-windows.count() // block_windows))
    rows = docs.select(packed(docs, kept), col(text_col).cast("binary").alias("text"))
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    new = [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("hit_spans", ArrayType(span)),
        StructField("item_ids", ArrayType(StringType())),
    ]
    arrow = pa.schema(
        [
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("hit_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("item_ids", pa.list_(pa.string())),
        ]
    )
    for number in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number).toArrow()
        # Without any window, one that no text can hold.
        lines, owners = part.column("window").to_pylist() or [b"\0"], part.column("owners").to_pylist() or [[]]
        index = Index(lines, owners, shingle)
        texts = rows.select("text")
        counts = np.zeros(len(index.shingles), np.int64)
        shared = spark.sparkContext.broadcast(vars(index))
        for row in texts.mapInArrow(_counted(shared), "shingle bigint, n bigint").groupBy("shingle").sum("n").collect():
            counts[row[0]] = row[1]
        index.order(counts)
        shared = spark.sparkContext.broadcast(vars(index))
        last = number + 1 == blocks
        carried = ["row"] if last else ["row", "text"]
        schema = StructType([rows.schema[c] for c in carried] + new)
        scan = _marked(shared, 1, carried, arrow, "hit_spans" in rows.columns)
        rows = rows.mapInArrow(scan, schema)
        rows = rows if last else stored(rows, "decontaminate-block")
    return rows.select(*unpacked(kept), *outputs)
