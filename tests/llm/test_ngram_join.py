"""The n-gram Jaccard join against all pairs in plain Python."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from test_documents import DOCS, awkward, by_id

from winnowmill.llm import ngram_join


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS).repartition(5).cache()


@pytest.mark.parametrize("size, percent", [(4, 85), (2, 60)])
def test_components(docs, size, percent):
    got = by_id(ngram_join.jaccard_components(docs, words=size, percent=percent))
    want = brute.components([(r[0], r[1]) for r in awkward()], size, percent)
    assert {k: r["component_id"] for k, r in got.items()} == want
    for row in awkward():
        assert got[row[0]]["n_shingles"] == len(brute.shingles(row[1], size))


def test_chains_hot_groups_and_a_shared_passage(spark):
    """Chains whose ends are unlike, copies whose leader is unlike some, and texts that share but a passage."""
    random_, rows = random.Random(5), []
    for chain in range(20):
        ws = [f"c{chain}w{i}" for i in range(90)]
        for step in range(8):
            rows.append((len(rows), " ".join(ws[step * 3 : step * 3 + 66])))
    base = [f"b{i}" for i in range(60)]
    for _ in range(700):
        own = list(base)
        for _ in range(random_.randint(0, 3)):
            own[random_.randrange(60)] = f"x{random_.randrange(50)}"
        rows.append((len(rows), " ".join(own)))
    passage = [f"p{i}" for i in range(60)]
    for i in range(650):  # more than a block, alike in 57 of 71 to 73 shingles and so not linked
        rows.append((len(rows), " ".join(passage + [f"o{i}y{j}" for j in range(7 + i % 2)])))
    random_.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = {k: r["component_id"] for k, r in by_id(ngram_join.jaccard_components(docs, words=4, percent=85)).items()}
    assert got == brute.components(rows, 4, 85)


def test_nulls_repeated_ids_and_nothing(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, "quite another text"), (2, "quite another text"), (None, long + " more"), (None, None), (3, " ")]
    rows += [(None, "only here"), (-4, long)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, ngram_join.jaccard_components(docs, words=4).collect()), key=repr)
    want = [(1, 37, -4), (1, 1, 1), (2, 1, 1), (None, 38, -4), (None, 0, None), (3, 0, 3), (None, 1, None), (-4, 37, -4)]
    assert got == sorted(want, key=repr)
    assert ngram_join.jaccard_components(docs.where("false")).count() == 0


def test_bitmaps_never_rule_out_a_link():
    random_ = np.random.default_rng(1)
    for _ in range(300):
        n = int(random_.integers(1, 400))
        union = random_.integers(0, 2**63, n, dtype=np.uint64)
        a, b = union[random_.random(n) < 0.9], union[random_.random(n) < 0.9]
        if len(a) and len(b):
            shared = len(np.intersect1d(a, b))
            one, two = (np.frombuffer(ngram_join.bitmap(s), np.uint64)[None, :] for s in (a, b))
            while one.shape[1] > two.shape[1]:
                one = ngram_join._folded(one)
            while two.shape[1] > one.shape[1]:
                two = ngram_join._folded(two)
            differing = int(np.bitwise_count(one ^ two).sum())
            assert 2 * shared <= len(a) + len(b) - differing


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_linked_sizes_are_in_neighbouring_bands(percent):
    edges = ngram_join.bands(percent, 3000)
    band = lambda n: sum(e <= n for e in edges)
    for n in range(1, 3000):
        assert band(n * 100 // percent) <= band(n) + 1
