"""Collocations against plain Python, and the automata by themselves."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from winnowmill.llm import phrases
from winnowmill.llm.transducer import Transducer, composed, union


def pieces(text):
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", brute.lower(text))]


def collocations(rows, least=10, share=50, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for ws in pieces(text):
            total[lang or "und"] += len(ws)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, own in counts.items():
        some = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        around = defaultdict(int)
        for p, f in some.items():
            if len(p) == 3:
                around[p[:2]], around[p[1:]] = max(around[p[:2]], f), max(around[p[1:]], f)
        rated = []
        for p, a in some.items():
            if len(p) == 2 and 100 * around[p] >= share * a and around[p]:
                continue
            score, k = min((10**6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rated.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def documents(seed=1, rows=400):
    random_ = random.Random(seed)
    words = ["a", "É", "the", "The", "x\x00y", "über", "New", "york", "CITY", "a b", "w-1"] + [f"v{i}" for i in range(30)]
    out = []
    for _ in range(rows):
        text = "".join(random_.choice(words) + random_.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(40))
        out.append((random_.choice(["en", "en", "en", None, "de", "und"]), text + random_.choice(["new york city", "Heavy  rain;", "a a a a", ""])))
    return out + [("en", None), (None, ""), ("fr", " \t"), ("de", " ".join(random_.choice(words) for _ in range(20_000)))] + [("es", "same text here")] * 12


@pytest.mark.parametrize("chunk, block, size", [(1 << 20, 1 << 20, 8 << 20), (700, 50, 4000), (3, 5, 900)])
def test_collocations(spark, monkeypatch, chunk, block, size):
    """The bounds of chunks, text blocks and ranges change nothing."""
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(phrases, "TEXT_BLOCK", block)
    monkeypatch.setattr(phrases, "RANGE_BYTES", size)
    rows = documents(rows=400 if chunk > 3 else 60)
    docs = spark.createDataFrame([(*r, "own", 1) for r in rows], "lang string, text string, part string, `a.b` int").repartition(5)
    got = sorted(map(tuple, phrases.collocations(docs).collect()))
    assert got == collocations(rows)
    assert {r[0] for r in got} >= {"en", "und", "de", "es"}


def test_top_and_limits(spark):
    rows = documents(7)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, least=3, share=80, top=25)
    assert sorted(map(tuple, got.collect())) == collocations(rows, 3, 80, 25)
    assert phrases.collocations(docs.where("false")).count() == 0
    assert phrases.collocations(docs.where("lang = 'fr'")).count() == 0


def test_products_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("6000000000000 AS a", "7000000000001 AS l", "9000000000000 AS r")
    score = phrases._score("a", row["l"], row["r"])
    assert row.select(score.alias("s")).first()["s"] == 10**6 * 6000000000000**2 // (7000000000001 * 9000000000000)


def test_automata_hold_and_add_up_ngrams():
    random_, parts, want = random.Random(9), [], Counter()
    for _ in range(4):
        ws = [random_.choice([3, 5, 8, 13, 2**63 + 7, 2**64 - 1]) for _ in range(300)]
        one, two, three = (np.array([*ws[k:], *[0] * k], np.uint64) for k in range(3))
        labels, *rows = phrases.counted(one, two, three)
        parts.append(Transducer.of_blobs(Transducer.of_sorted(labels, *rows).blobs()))
        for k in (1, 2, 3):
            want.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))

    def spelled(automaton):
        one, two, three, count = automaton.rows()
        labels = [int(x) for x in automaton.labels]
        return {tuple(labels[w] for w in row if w >= 0): int(n) for *row, n in zip(one, two, three, count)}

    assert spelled(union(parts)) == want
    assert spelled(union(parts, 7)) == {k: n for k, n in want.items() if n >= 7}
    whole, asked = union(parts), [(a, b) for a in (3, 4, 2**64 - 1) for b in (0, 3, 6, 8, 2**63 + 7)]
    got = composed(tuple(np.array(q, np.uint64) for q in zip(*asked)), whole)
    assert got.tolist() == [want[tuple(w for w in q if w)] for q in asked]
    assert composed((np.array([3], np.uint64), np.array([0], np.uint64)), Transducer.of_sorted(*[np.empty(0, np.uint64)], *[np.empty(0, np.int64)] * 4)).tolist() == [0]


def test_equal_states_are_shared():
    ws = np.array([7, 1, 2, 8, 1, 2, 9, 1, 2], np.uint64)  # 7 1 2, 8 1 2, 9 1 2: one state after x 1
    labels, *rows = phrases.counted(ws[::3], ws[1::3], ws[2::3])
    automaton = Transducer.of_sorted(labels, *rows)
    assert len(automaton.second) == 3 and len(automaton.fan2) == 1
