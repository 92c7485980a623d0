"""Cheapest repair of conversation structure, by a grammar-compressed min-plus program shared across conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grammar
from .common import col, stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS_AT_ONCE = 200_000  # symbols that share one grammar; a longer conversation is one by itself
TEXT_AT_ONCE = 4 << 20
ROLES = {"u": "user", "a": "assistant"}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


class _Conversation:
    """What is known of the rows of one conversation so far."""

    def __init__(self, conv) -> None:
        self.conv, self.symbols, self.seen, self.last = conv, bytearray(), set(), None
        self.low = self.high = self.turn = None
        self.turns = 0
        self.counts = dict.fromkeys(COUNTS, 0)

    def add(self, turn, initial: str, digest: bytes, blank: bool, truncated: bool) -> None:
        fault = "blank" if blank else "duplicate" if digest in self.seen else "truncated" if truncated else ""
        self.seen.add(digest)
        if fault:
            self.counts[fault] += 1
        self.counts["illegal"] += self.last is not None and self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.symbols.append(grammar.symbol(initial, fault))
        if turn is not None:  # rows come in the order of their turns
            self.turns += turn != self.turn
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn

    def row(self) -> tuple:
        if self.turns:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        return (self.conv, bytes(self.symbols), *self.counts.values())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _faults(kind: pa.DataType):
    """Rows in order -> one row per conversation with its symbols and counts."""
    schema = pa.schema([("conv", kind), ("symbols", pa.binary()), *[(c, pa.int64()) for c in COUNTS]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            done = []
            for conv, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if open_ is None or conv != open_.conv:
                    done += [open_.row()] if open_ else []
                    open_ = _Conversation(conv)
                open_.add(*row)
            yield _batch(done, schema)
        if open_ is not None:
            yield _batch([open_.row()], schema)

    return scan


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different symbol sequences -> their cost and audit; about SYMBOLS_AT_ONCE of them share a grammar."""
    schema = pa.schema([("symbols", pa.binary()), ("cost", pa.int64()), ("audit", pa.string())])
    held, size = [], 0
    for batch in batches:
        for sequence in batch.column(0).to_pylist():
            held.append(sequence)
            size += len(sequence)
            if size >= SYMBOLS_AT_ONCE:
                yield _batch([(s, *found) for s, found in zip(held, grammar.cheapest(held))], schema)
                held, size = [], 0
    if held:
        yield _batch([(s, *found) for s, found in zip(held, grammar.cheapest(held))], schema)


class _Editor:
    """Applies the audit of one conversation to its rows, one after the other."""

    def __init__(self, conv, audit: str) -> None:
        self.conv, self.audit, self.at, self.state, self.out = conv, audit, 0, grammar.START, 0

    def _row(self, edit: str, role: str, text: str) -> tuple:
        self.out += 1
        self.state = grammar.STEP[self.state, role[:1]]
        return self.conv, self.out - 1, edit, role, text

    def inserts(self) -> list[tuple]:
        rows = []
        while self.audit[self.at : self.at + 1] == grammar.INSERT:
            self.at += 1
            rows.append(self._row(grammar.INSERT, ROLES[grammar.NEXT_ROLE[self.state]], ""))
        return rows

    def row(self, role: str, text: str) -> list[tuple]:
        rows = self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != grammar.DELETE:
            rows.append(self._row(edit, role if edit == grammar.KEEP else ROLES[grammar.NEXT_ROLE[self.state]], text))
        return rows


def _edited(kind: pa.DataType):
    """Per conversation its audit and then its rows in order -> the repaired rows in order."""
    schema = pa.schema(
        [("conv", kind), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, rows, size = None, [], 0
        for batch in batches:
            for conv, audit, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if audit is not None:
                    rows += editor.inserts() if editor else []
                    editor = _Editor(conv, audit)
                else:
                    rows += editor.row(role, text)
                    size += len(text) + 64
                if size >= TEXT_AT_ONCE:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        rows += editor.inserts() if editor else []
        yield _batch(rows, schema)

    return scan


def _hashed(kind: pa.DataType):
    schema = pa.schema([("conv", kind), ("sha256", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, hasher, out = None, None, []
        for batch in batches:
            for own, position, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "position", "role", "text")]):
                if position == 0:
                    out += [(conv, hasher.hexdigest())] if hasher else []
                    conv, hasher = own, hashlib.sha256()
                else:
                    hasher.update(b"\n")
                hasher.update(f"{role}:{text}".encode())
            yield _batch(out, schema)
            out = []
        yield _batch([(conv, hasher.hexdigest())] if hasher else [], schema)

    return scan


def _arrow(df: DataFrame, column: str) -> tuple[pa.DataType, str]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = df.schema[column].dataType
    return to_arrow_type(kind), kind.simpleString()


def sha256_of(repaired: DataFrame) -> DataFrame:
    """``(conv, sha256)`` of the rows ``role:text`` joined by newlines, for rows as ``repair_conversations`` returns them.

    Only conversations with repaired rows are in it. Rows are hashed as they stream by, where they are.
    """
    arrow, kind = _arrow(repaired, "conv")
    return repaired.select("conv", "position", "role", "text").mapInArrow(_hashed(arrow), f"conv {kind}, sha256 string")


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest repair per conversation, and the repaired rows.

    The first result has a row per conversation: ``conv``, ``gaps`` (turn numbers missing between the
    first and the last), ``blank``, ``duplicate`` and ``truncated`` (rows by their first fault), ``illegal``
    (neighbouring roles that may not follow one another), ``cost`` and ``audit``. The second one has
    ``conv``, ``position``, ``edit``, ``role``, ``text`` of the rows after the repair.

    A row is blank if its text is nothing but ASCII white space, a duplicate if a row before it has its role
    and text, truncated if its last other character is none of ``.!?``. Edits: Keep costs 0, Rerole (to
    user or assistant) 3, Delete 4 and the only one for blank and duplicate rows, Insert of an empty row 3; a
    truncated row that stays costs 3 more. Roles count by their initial; after the repair they read
    ``(s?(ua)+)?``. The audit has the initials of the edits; of the cheapest ones the first in ASCII order.

    Rows are taken by turn, null first, and where a turn repeats by role and a digest of the text. Nulls in
    role and text are one blank; rows without conversation are one conversation. A table without rows gives
    two without rows. Other columns are not read.

    Rows become symbols of role and fault. Re-Pair makes a grammar of the different symbol sequences of a task;
    each rule has one matrix of (cost, audit rope) by state before and after, the min-plus product of its
    parts, which all conversations share. Shuffled once without texts and once with them, never gathered:
    a task streams over sorted rows, and keeps of a conversation a symbol and a digest per row, as its
    audit is one value anyway.
    """
    text, role = F.coalesce(col(text_col), F.lit(" ")), F.coalesce(col(role_col), F.lit(" "))
    base = rows.select(
        col(conv_col).alias("conv"), col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text")
    )
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    base = base.withColumn("digest", digest)
    order = ["turn", "role", "digest"]
    trimmed = F.rtrim("text", F.lit(SPACES))
    arrow, kind = _arrow(base, "conv")
    narrow = base.select("conv", "turn", "role", F.substring("role", 1, 1).alias("initial"), "digest",
                         (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    narrow = narrow.repartition("conv").sortWithinPartitions("conv", *order)
    narrow = narrow.select("conv", "turn", "initial", "digest", "blank", "cut")
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    found = stored(narrow.mapInArrow(_faults(arrow), f"conv {kind}, symbols binary, {counts}"), "repair-faults")
    ways = found.select("symbols").distinct().mapInArrow(_audits, "symbols binary, cost bigint, audit string")
    ways = ways.withColumnRenamed("symbols", "__symbols")
    summary = found.join(ways, F.col("symbols") == F.col("__symbols")).select("conv", *COUNTS, "cost", "audit")
    summary = stored(summary, "repair-audits")

    nothing = lambda name: F.lit(None).cast(base.schema[name].dataType).alias(name)
    heads = summary.select("conv", F.lit(0).alias("kind"), *map(nothing, order), "audit", nothing("text"))
    lines = base.select("conv", F.lit(1).alias("kind"), *order, F.lit(None).cast("string").alias("audit"), "text")
    both = heads.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "kind", *order)
    schema = f"conv {kind}, position bigint, edit string, role string, text string"
    repaired = both.select("conv", "audit", "role", "text").mapInArrow(_edited(arrow), schema)
    return summary, repaired
