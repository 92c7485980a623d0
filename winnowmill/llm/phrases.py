"""Phrase collocations from weighted acyclic automata of n-grams, one for each range of prefixes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, col, pieces, stored
from .transducer import FIELDS, Transducer, composed, in_order, union

BREAK = b"\xff"  # stands between pieces; no byte of UTF-8
_TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b for b in range(256))
_BREAK = np.uint64(xxhash.xxh3_64_intdigest(BREAK))
CHUNK_WORDS = 1 << 19  # words whose n-grams are sorted together; twice as many wait in a task at most
TEXT_BLOCK = 1 << 20  # bytes of a long text that are split into words at once
RANGE_BYTES = 4 << 20  # text whose n-grams make one range of prefixes
SAMPLE_BYTES = 16 << 20  # text from which the bounds of ranges are taken; they decide the dealing only


def _blocks(text: bytes) -> Iterator[bytes]:
    """A text cut at blanks into blocks of about TEXT_BLOCK bytes; a word is never cut."""
    at = 0
    while len(text) - at > TEXT_BLOCK:
        end = text.find(b" ", at + TEXT_BLOCK)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _words(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words of each block, BREAK where a piece ends."""
    for block in _blocks(text.lower().translate(_TABLE)):
        yield block.replace(BREAK, b" \xff ").split(b" ")


class _Hashes(WordHashes):
    """No hash for what stands between two blanks in a row."""

    def of(self, words: list[bytes]) -> np.ndarray:
        return super().of([w for w in words if w])


def _following(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions of words, and their hashes and those of the next and second next word of the piece, 0 for none."""
    ends = np.append(hashes, [_BREAK, _BREAK])
    at = np.flatnonzero(hashes != _BREAK)
    two = np.where(ends[at + 1] == _BREAK, np.uint64(0), ends[at + 1])
    three = np.where((two == 0) | (ends[at + 2] == _BREAK), np.uint64(0), ends[at + 2])
    return at, ends[at], two, three


def counted(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted n-grams of one to three words with their counts, from one row of hashes per word: labels, places, counts."""
    labels, place = np.unique(np.concatenate([one, two, three]), return_inverse=True)
    place = place - int(np.searchsorted(labels, np.uint64(1)))  # 0 is no word
    labels = labels[labels != 0]
    one, two, three = np.split(place, 3)
    by = in_order(one, two, three, len(labels))
    one, two, three = one[by], two[by], three[by]

    def runs(*columns: np.ndarray) -> np.ndarray:
        new = np.ones(len(one), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        return np.flatnonzero(new)

    size, none = len(one), np.full(len(one), -1, np.int64)
    rows = []
    for columns in ((one,), (one, two), (one, two, three)):
        at = runs(*columns)
        full = at[columns[-1][at] >= 0]
        count = np.diff(np.append(at, size))[columns[-1][at] >= 0]
        rows.append([*[c[full] for c in columns], *[none[full]] * (3 - len(columns)), count])
    one, two, three, count = (np.concatenate([r[k] for r in rows]) for k in range(4))
    by = in_order(one, two, three, len(labels))
    return labels, one[by], two[by], three[by], count[by].astype(np.int64)


def _bounds_at(bounds: np.ndarray, labels: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Where each bound (two hashes) falls among sorted rows."""
    out = []
    for first, second in bounds:
        at = int(np.searchsorted(labels, first))
        low = int(np.searchsorted(one, at))
        if second and at < len(labels) and labels[at] == first:
            high = int(np.searchsorted(one, at, side="right"))
            low += int(np.searchsorted(two[low:high], np.searchsorted(labels, second)))
        out.append(low)
    return np.array(out, np.int64)


def range_of(bounds: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The number of bounds that are not above each prefix (0 for no second word)."""
    if not len(bounds):
        return np.zeros(len(one), np.int64)
    low = np.searchsorted(bounds[:, 0], one)
    high = np.searchsorted(bounds[:, 0], one, side="right")
    out = high.copy()
    for i in np.flatnonzero(low < high):  # the word is the first one of a bound
        out[i] = low[i] + np.searchsorted(bounds[low[i] : high[i], 1], two[i], side="right")
    return out


def _pieces_of(lang: str, rows: tuple, bounds: np.ndarray, strings: dict) -> Iterator[tuple]:
    """One automaton per range, with the words that it counts as single ones."""
    labels, one, two, three, count = rows
    edges = np.concatenate([[0], _bounds_at(bounds, labels, one, two), [len(one)]])
    for part in range(len(edges) - 1):
        low, high = edges[part], edges[part + 1]
        if low == high:
            continue
        columns = [one[low:high], two[low:high], three[low:high], count[low:high]]
        if columns[1][0] >= 0:  # the range begins among the pairs of a word: it stands here without a count
            columns = [np.concatenate([[c], column]) for c, column in zip((columns[0][0], -1, -1, 0), columns)]
        used, inverse = np.unique(np.concatenate(columns[:3]), return_inverse=True)
        base = int(np.searchsorted(used, 0))
        places = np.split(inverse - base, 3)
        own = Transducer.of_sorted(labels[used[base:]], *places, columns[3])
        yield lang, part, *own.blobs(), [strings[int(h)] if n else None for h, n in zip(own.labels[own.first], own.final1)]


_SCHEMA = pa.schema(
    [("lang", pa.string()), ("part", pa.int32()), *[(f, pa.binary()) for f in FIELDS], ("words", pa.list_(pa.binary()))]
)
_DDL = "lang string, part int, " + ", ".join(f"{f} binary" for f in FIELDS) + ", words array<binary>"


class _Waiting:
    """Hashed words of one language that wait to be counted, and the spelling of each."""

    def __init__(self) -> None:
        self.hashes, self.size, self.strings = [], 0, {}

    def add(self, words: list[bytes], hashes: np.ndarray) -> None:
        self.hashes.append(hashes)
        self.size += len(hashes)
        self.strings.update(zip(hashes.tolist(), words))

    def flush(self, amid: bool) -> Iterator[tuple]:
        """Counted n-grams; amid a piece the last two words wait for those to come."""
        hashes = np.concatenate(self.hashes)
        at, one, two, three = _following(hashes)
        stop = int(np.searchsorted(at, len(hashes) - 2)) if amid else len(at)
        if stop:
            for start in range(0, stop, CHUNK_WORDS):
                part = slice(start, min(start + CHUNK_WORDS, stop))
                yield counted(one[part], two[part], three[part])
        rest = hashes[-2:] if amid else hashes[:0]
        self.strings = {h: self.strings[h] for h in rest.tolist()}
        self.hashes, self.size = [rest], len(rest)


def _automata(shared):
    """``(lang, text)`` -> automata of about CHUNK_WORDS words, cut into ranges of prefixes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, cache, waiting, held = shared.value, _Hashes(), defaultdict(_Waiting), 0
        none = np.empty((0, 2), np.uint64)

        def flushed(lang: str, amid: bool) -> Iterator[pa.RecordBatch]:
            strings = waiting[lang].strings
            for rows in waiting[lang].flush(amid):
                columns = list(zip(*_pieces_of(lang, rows, bounds.get(lang, none), strings)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

        for batch in batches:
            for first, texts in pieces(batch, 1):
                for lang, text in zip(batch.column(0).slice(first, len(texts)).to_pylist(), texts):
                    for words in _words((text or b"") + b"\n"):
                        words = [w for w in words if w]
                        waiting[lang].add(words, cache.of(words))
                        held += len(words)
                        if waiting[lang].size >= CHUNK_WORDS:
                            held -= waiting[lang].size
                            yield from flushed(lang, words[-1:] != [BREAK])
                            held += waiting[lang].size
                    while held >= 2 * CHUNK_WORDS:  # many languages, none with a chunk of its own
                        largest = max(waiting, key=lambda k: waiting[k].size)
                        held -= waiting[largest].size
                        yield from flushed(largest, False)
                        del waiting[largest]
        for lang in list(waiting):
            yield from flushed(lang, False)

    return scan


def _united(least: int):
    """The automata of one range -> one, with n-grams of ``least`` or more; the words of its single ones; all it counts."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        parts = [Transducer.of_blobs(b) for b in zip(*[rows.column(f).to_pylist() for f in FIELDS])]
        total = sum(int(p.final1.sum()) for p in parts)
        whole = union(parts, least)
        wanted, strings = set(whole.labels[whole.first[whole.final1 > 0]].tolist()), {}
        for part, words in zip(parts, rows.column("words")):
            for h, word in zip(part.labels[part.first].tolist(), words):
                if h in wanted and word.is_valid:
                    strings[h] = word.as_py()
                    wanted.discard(h)
        own = [strings.get(h) for h in whole.labels[whole.first].tolist()]
        values = [key[0].as_py(), key[1].as_py(), *whole.blobs(), own]
        table = pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, _SCHEMA)], schema=_SCHEMA)
        return table.append_column("total", pa.array([total], pa.int64()))

    return merge


_CANDIDATES = "lang string, h1 bigint, h2 bigint, h3 bigint, a bigint, before bigint"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and triples with their counts and, of triples, the count of the first two words; hashes, 0 for no word."""
    for batch in batches:
        for lang, *blobs in zip(*[batch.column(c).to_pylist() for c in ("lang", *FIELDS)]):
            own = Transducer.of_blobs(blobs)
            one, two, three, count = own.rows()
            n1, n2 = len(own.first), len(own.second)
            labels = np.append(own.labels, np.uint64(0)).view(np.int64)
            before = np.concatenate([np.zeros(n1 + n2, np.int64), np.repeat(count[n1 : n1 + n2], own.fan2[own.target])])
            arrays = [pa.array(x[n1:]) for x in (labels[one], labels[two], labels[three], count, before)]
            lang = pa.array([lang] * len(arrays[0]), pa.string())
            yield pa.RecordBatch.from_arrays([lang, *arrays], names=["lang", "h1", "h2", "h3", "a", "before"])


def _placed(shared):
    """Queries ``(lang, h1, h2)`` with the range that has the answer."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, none = shared.value, np.empty((0, 2), np.uint64)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            one, two = (batch.column(k).to_numpy().view(np.uint64) for k in (1, 2))
            part = np.zeros(len(langs), np.int32)
            for lang in set(langs):
                at = np.array([own == lang for own in langs])
                part[at] = range_of(bounds.get(lang, none), one[at], two[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=["lang", "h1", "h2", "part"])

    return scan


def _answered(queries: pa.Table, automaton: pa.Table) -> pa.Table:
    """Queries of one range composed with its automaton: their counts, and the spelling of single words."""
    one, two = (queries.column(c).to_numpy() for c in ("h1", "h2"))
    found, words = np.zeros(len(one), np.int64), {}
    if automaton.num_rows and len(one):
        counts = Transducer.of_blobs([automaton.column(f)[0].as_py() for f in FIELDS])
        found = composed((one.view(np.uint64), two.view(np.uint64)), counts)
        words = dict(zip(counts.labels[counts.first].tolist(), automaton.column("words")[0].as_py()))
    spelled = [words.get(h) if not t else None for h, t in zip(one.view(np.uint64).tolist(), two.tolist())]
    arrays = [queries.column("lang"), pa.array(one), pa.array(two), pa.array(found), pa.array(spelled, pa.binary())]
    return pa.Table.from_arrays(arrays, names=["lang", "h1", "h2", "f", "word"])


def _bounds(rows: DataFrame) -> dict[str, np.ndarray]:
    """Per language with more text than a range holds, the first two words (as hashes) at which a new range begins.

    They are equally spaced in a sample of about SAMPLE_BYTES of text, so their number grows with the text.
    """
    size = rows.groupBy("lang").agg(F.sum(F.length("text")).alias("bytes"))
    large = {r["lang"]: r["bytes"] for r in size.where(F.col("bytes") > RANGE_BYTES).collect()}
    if not large:
        return {}
    share = min(1.0, SAMPLE_BYTES / sum(large.values()))
    own = F.abs(F.xxhash64("text") % 1_000_000) < share * 1_000_000

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Hashes()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for words in _words(text):
                    _, one, two, _ = _following(cache.of(words))
                    step = slice(len(one) % 16, None, 16)
                    arrays = [pa.array(x[step].view(np.int64)) for x in (one, two)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(arrays[0]), pa.string()), *arrays], names=["lang", "h1", "h2"]
                    )

    sample = rows.where(F.col("lang").isin(list(large))).where(own)
    found = sample.mapInArrow(scan, "lang string, h1 bigint, h2 bigint").toArrow()
    langs, out = np.array(found.column("lang").to_pylist(), object), {}
    for lang, size in large.items():
        pairs = np.stack([found.column(c).to_numpy().view(np.uint64)[langs == lang] for c in ("h1", "h2")], axis=1)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        at = np.arange(1, -(-size // RANGE_BYTES)) * len(pairs) // -(-size // RANGE_BYTES)
        out[lang] = np.unique(pairs[at], axis=0) if len(pairs) else pairs
    return out


def ngram_automata(rows: DataFrame, least: int) -> tuple[DataFrame, object]:
    """One automaton per language and range of prefixes of ``(lang, text)``, and the broadcast bounds of the ranges."""
    shared = rows.sparkSession.sparkContext.broadcast(_bounds(rows))
    chunks = rows.mapInArrow(_automata(shared), _DDL)
    whole = chunks.groupBy("lang", "part").applyInArrow(_united(least), f"{_DDL}, total bigint")
    return stored(whole, "phrase-automata"), shared


def _score(a: str, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    whole = lambda c: c.cast("decimal(16,0)")
    parts = F.struct((F.lit(1_000_000).cast("decimal(7,0)") * (whole(F.col(a)) * whole(F.col(a)))).alias("x"),
                     (whole(left) * whole(right)).alias("y"))
    return F.element_at(F.transform(F.array(parts), lambda p: F.call_function("div", p["x"], p["y"])), 1)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, share: int = 50, top: int = 2000
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two or three words of each language.

    Texts are lower-cased (A-Z), cut at ``[.,;:!?]`` and line ends into pieces, and these at blanks and tabs
    into words. ``a`` counts a phrase inside pieces; those that occur ``least`` times or more are candidates.
    ``n`` counts the words of the language. A cut of the phrase in two parts that occur ``l`` and ``r`` times
    scores floor(1000000 a a / (l r)), in whole numbers; its lowest cut counts, of equal ones the one with the
    shorter first part. Pairs inside a triple that is a candidate and occurs at least ``share`` percent
    as often are left out. Ranks go by score, count, and phrase in the order of its bytes.

    Null and empty texts have no words; rows without language are of language ``und``. Copies of a text count
    each. A table without candidates gives no row. Other columns are not read. Counts stay below 10^16.
    Words are told apart by 64-bit hashes. The byte FF, which is in no valid UTF-8, counts as a line end.

    Each task sorts the n-grams of some million words and builds a weighted acyclic automaton of them, cut
    into ranges of two-word prefixes that hold about as much each, so that a frequent word is spread over
    several. A task unites the automata of a range and adds up their weights. Counts of first parts are on
    the way to a phrase; those of the other parts come from composing the parts asked for, each once, with
    the automaton of their range.
    """
    lang = F.coalesce(col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.coalesce(col(text_col), F.lit("")).cast("binary").alias("text"))
    automata, shared = ngram_automata(rows, least)
    found = stored(automata.mapInArrow(_candidates, _CANDIDATES), "phrase-candidates")

    none = F.lit(0).cast("bigint")
    singles = [F.struct(F.col(c).alias("h1"), none.alias("h2")) for c in ("h1", "h2", "h3")]
    asked = found.select("lang", F.explode(F.array(*singles, F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("q"))
    asked = asked.select("lang", "q.*").where("h1 <> 0").distinct()
    asked = asked.mapInArrow(_placed(shared), "lang string, h1 bigint, h2 bigint, part int")
    ranges = automata.select("lang", "part", *FIELDS, "words")
    answers = asked.groupBy("lang", "part").cogroup(ranges.groupBy("lang", "part")).applyInArrow(
        _answered, "lang string, h1 bigint, h2 bigint, f bigint, word binary"
    )
    answers = stored(answers, "phrase-parts")

    def part(df: DataFrame, name: str, one: str, two: Column) -> DataFrame:
        own = answers.select(
            F.col("lang").alias("__lang"), F.col("h1").alias("__h1"), F.col("h2").alias("__h2"),
            F.col("f").alias(name), F.col("word").cast("string").alias(f"{name}_word"),
        )
        same = (F.col("lang") == F.col("__lang")) & (F.col(one) == F.col("__h1")) & (two == F.col("__h2"))
        return df.join(own, same, "left").drop("__lang", "__h1", "__h2")

    full = part(part(part(found, "f1", "h1", none), "f2", "h2", none), "f3", "h3", none)
    full = part(full, "rest", "h2", F.when(F.col("h3") != 0, F.col("h3")))
    # The most frequent triple that a pair begins or ends.
    triples = found.where("h3 <> 0")
    around = triples.select("lang", "h1", "h2", "a").union(triples.select("lang", "h2", "h3", "a")).groupBy("lang", "h1", "h2")
    around = around.agg(F.max("a").alias("around")).toDF("__lang", "__h1", "__h2", "around")
    inside = (F.col("lang") == F.col("__lang")) & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")) & (F.col("h3") == 0)
    full = full.join(around, inside, "left").where(F.coalesce(100 * F.col("around") < share * F.col("a"), F.lit(True)))

    cut = lambda k, left, right: F.struct(_score("a", left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
    pair, triple = cut(1, F.col("f1"), F.col("f2")), F.least(cut(1, F.col("f1"), F.col("rest")), cut(2, F.col("before"), F.col("f3")))
    best = F.when(F.col("h3") == 0, pair).otherwise(triple)
    phrase = F.concat_ws(" ", "f1_word", "f2_word", "f3_word").alias("phrase")
    scored = full.select("lang", phrase, "a", best.alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(16)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = automata.groupBy("lang").agg(F.sum("total").alias("n")).withColumnRenamed("lang", "__lang")
    out = ranked.join(words, F.col("lang") == F.col("__lang"))
    return out.select(F.col("lang"), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
