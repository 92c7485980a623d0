"""Conversation repair against the enumeration of all edits, and whole queries against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from winnowmill.llm import grammar
from winnowmill.llm.repair import COUNTS, repair_conversations, sha256_of

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def judged(rows):
    """rows (role, text) in order -> (initial, fault)."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def enumerated(symbols):
    """The cheapest edits of all, inserting up to two rows at each place: (cost, audit)."""
    best = None
    for inserts in itertools.product(range(3), repeat=len(symbols) + 1):
        for edits in itertools.product("KRD", repeat=len(symbols)):
            cost, audit, last, roles = 0, "", "", ""
            for i, (role, fault) in enumerate([*symbols, (None, None)]):
                for _ in range(inserts[i]):
                    last, audit, cost = NEXT[last], audit + "I", cost + 3
                    roles += last
                if role is None:
                    break
                edit = edits[i]
                if edit != "D" and fault in ("blank", "duplicate"):
                    roles = "x"
                    break
                if edit != "D":
                    last = role if edit == "K" else NEXT.get(last, "x")
                    roles += last or "x"
                    cost += 3 * (edit == "R") + 3 * (fault == "truncated")
                else:
                    cost += 4
                audit += edit
                if last not in NEXT:
                    roles = "x"
                    break
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_cheapest_equals_enumeration():
    random_ = random.Random(2)
    rows = [[]] + [
        [(random_.choice("suaxu"), random_.choice(["", "", "", "truncated", "blank"])) for _ in range(random_.randint(1, 4))] for _ in range(60)
    ]
    got = grammar.cheapest([bytes(grammar.symbol(*s) for s in row) for row in rows])
    assert got == [enumerated(row) for row in rows]


def test_grammar_spells_the_sequences_and_ropes_compare_like_strings():
    random_ = random.Random(3)
    rows = [bytes(random_.choice([1, 3, 5, 3, 5]) for _ in range(random_.randint(0, 40))) for _ in range(80)] + [bytes([3, 5] * 500), b"\x03" * 77]
    rules, short = grammar.re_pair(rows)
    spelled = [bytes([i]) for i in range(grammar.TERMINALS)]
    for left, right in rules:
        spelled.append(spelled[left] + spelled[right])
    assert [b"".join(spelled[i] for i in row) for row in short] == rows
    assert sum(map(len, short)) + 2 * len(rules) < sum(map(len, rows)) / 3
    pairs = [(row[i], row[i + 1]) for row in short for i in range(len(row) - 1) if row[i] != row[i + 1]]
    assert len(pairs) == len(set(pairs))  # no pair is left that occurs twice
    ropes = [("", "")]
    for _ in range(300):
        (x, a), (y, b) = random_.choice(ropes), random_.choice([*ropes, ("KR" * 20, "KR" * 20), ("D", "D")])
        if len(a) + len(b) < 5000:
            ropes.append((grammar.joined(x, y), a + b))
    for _ in range(2000):
        (x, a), (y, b) = random_.choice(ropes), random_.choice(ropes)
        assert grammar.before(x, y) == (a < b)


def test_a_long_conversation_is_not_quadratic():
    cost, audit = grammar.cheapest([bytes([3, 5] * 20_000 + [3])])[0]
    assert (cost, audit) == (3, "K" * 40_001 + "I")


def repaired(rows, audit):
    out, last, at = [], "", 0
    for role, text in [*rows, (None, None)]:
        while audit[at : at + 1] == "I":
            last, at = NEXT[last], at + 1
            out.append((FULL[last], ""))
        if role is None:
            return out
        edit, at = audit[at], at + 1
        if edit != "D":
            own = role if edit == "K" else FULL[NEXT[last]]
            last = own[0]
            out.append((own, text))


def test_repair_of_awkward_conversations(spark):
    random_, rows = random.Random(4), []
    for conv in [*range(40), None]:
        for turn in range(random_.randint(1, 5)):
            role = random_.choice(["system", "user", "assistant", "tool", "user", "", None])
            text = random_.choice(["Yes.", "No", " \t", "", None, "long " * 3000, "Ü? ", "a\nb!\r\n"])
            rows.append((conv, None if random_.random() < 0.1 else turn * random_.choice([1, 1, 2]), role, text, "kept", turn))
    schema = "conv_id bigint, turn bigint, role string, text string, conv string, `a.b` bigint"
    summary, out = repair_conversations(spark.createDataFrame(rows, schema).repartition(5))
    digests = {r["conv"]: r["sha256"] for r in sha256_of(out).collect()}
    lines = {}
    for r in out.orderBy("position").collect():
        lines.setdefault(r["conv"], []).append((r["role"], r["text"]))
    got = {r["conv"]: r for r in summary.collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        own = [(r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows if r[0] == conv]
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        texts, turns = [r[1:] for r in own], [r[0] for r in own if r[0] is not None]
        symbols = judged(texts)
        faults = [f for _, f in symbols]
        assert [row[c] for c in COUNTS[1:4]] == [faults.count(c) for c in COUNTS[1:4]]
        assert row["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert row["illegal"] == sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        assert (row["cost"], row["audit"]) == (enumerated(symbols) if len(symbols) < 5 else grammar.cheapest([bytes(grammar.symbol(*s) for s in symbols)])[0])
        want = repaired(texts, row["audit"])
        assert lines.get(conv, []) == want
        if want:
            assert digests[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in want).encode()).hexdigest()
        else:
            assert conv not in digests


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    summary, out = repair_conversations(empty)
    assert summary.count() == 0 and out.count() == 0 and sha256_of(out).count() == 0


def test_ends_of_conversations_over_many_partitions(spark):
    """One conversation holds a third of all rows; each has its own text order."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("conv_id"), "id",
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id"), F.lit(".")).alias("text"),
    ).withColumnRenamed("id", "turn")
    summary, out = repair_conversations(rows)
    row = summary.where("conv = -7").first()
    assert (row["cost"], row["audit"], row["gaps"]) == (0, "K" * 1000, 2000 - 2 * 1)
    assert out.where("conv = -7").count() == 1000 and summary.count() == 2001
