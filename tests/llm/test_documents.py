"""Operators on documents against plain Python, on texts made to be awkward."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from winnowmill.llm import lm, mixing, near, quality, sharding, tokens
from winnowmill.llm.decontaminate import decontaminate

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, shard string, `a.b` int"


def awkward(rows: int = 120, seed: int = 3):
    """Nulls in every column, empty and long texts, repeated rows, near copies, odd white space, extra columns."""
    random_ = random.Random(seed)
    vocabulary = ["".join(random_.choice("abcdefgh") for _ in range(random_.randint(1, 6))) for _ in range(60)]
    texts = []
    for _ in range(rows):
        text = "".join(
            random_.choice(vocabulary).capitalize() + random_.choice([" ", " ", " ", "\n", "\t ", "  ", "\r\n", " é "])
            for _ in range(random_.choice([1, 3, 9, 30, 80]))
        )
        texts.append(text)
    texts += [t + " extra" for t in texts[:20]] + texts[:15] + ["x | y $ z"] * 8 + ["", " \n", None, None]
    texts += [" ".join(random_.choice(vocabulary) for _ in range(30_000)), "same line here\n" * 40]
    out = []
    for i, text in enumerate(texts):
        source = random_.choice([None, "", "s1", "s2", "S1", "é"])
        out.append((i, text, None if i % 7 == 0 else "en", source, None, "mine", "own", i % 3))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    texts = [r[1] for r in awkward() if r[1]]
    rows = [(1, texts[3][:200]), (2, texts[4]), (20, texts[4]), (None, "Extra"), (5, None), (6, " !? "), (7, texts[0])]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_counts_and_verdict(docs):
    got = by_id(quality.quality_cascade(docs, complete=True))
    assert len(got) == docs.count()
    for row in awkward():
        want, row_got = brute.quality(row[1]), got[row[0]]
        assert {k: row_got[k] for k in want} == want
        n = want["n_words"]
        bad = n < 20 or 100 * want["n_repeat_words"] > 30 * n or 100 * want["n_symbols"] > 40 * n
        bad = bad or not 15 * n <= 10 * want["word_chars"] <= 300 * n or 100 * want["n_dup_lines"] > 10 * n
        assert row_got["kept"] == (not bad)
        assert (row_got["failed_rule"] is None) == (not bad)
        assert row_got["a.b"] == row[7] and row_got["shard"] == "own"


def test_quality_short_circuit_changes_no_verdict(docs, empty):
    whole, lazy = by_id(quality.quality_cascade(docs, complete=True)), by_id(quality.quality_cascade(docs))
    assert {k: r["kept"] for k, r in whole.items()} == {k: r["kept"] for k, r in lazy.items()}
    assert any(r["n_repeat_words"] is None or r["n_symbols"] is None for r in lazy.values())
    ranked = quality.rank_rules(docs, "text")
    assert {r.name for r, _, _ in ranked} == {r.name for r in quality.RULES}
    assert quality.quality_cascade(empty).count() == 0


@pytest.mark.parametrize("block", [50_000, 7])
def test_decontamination(docs, items, block):
    got = by_id(decontaminate(docs, items, block_windows=block))
    wins = brute.windows([(r["item_id"], r["text"]) for r in items.collect()])
    for row in awkward():
        n, hit, owners = brute.hits(row[1], wins)
        r = got[row[0]]
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (n, hit, owners)
        assert sum(s["end"] - s["start"] for s in r["hit_spans"]) == hit
        assert r["a.b"] == row[7]


def test_decontamination_of_and_with_nothing(docs, items, empty):
    assert decontaminate(empty, items).count() == 0
    rows = decontaminate(docs, items.where("false"))
    assert rows.agg(F.sum("n_hit"), F.count("*")).first() == (0, docs.count())


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, size):
    got = by_id(near.near_duplicates(docs, words=size))
    want = brute.components([(r[0], r[1]) for r in awkward()], size)
    assert {k: r["component_id"] for k, r in got.items()} == want
    for row in awkward():
        assert got[row[0]]["n_shingles"] == len(brute.shingles(row[1], size))
        assert got[row[0]]["kept"] == (want[row[0]] == row[0])


def test_near_duplicates_chains_and_hot_groups(spark):
    """Chains whose ends are unlike, and copies of one text whose members are not all alike."""
    random_ = random.Random(5)
    rows = []
    for chain in range(30):
        ws = [f"c{chain}w{i}" for i in range(60)]
        for step in range(8):
            rows.append((len(rows), " ".join(ws[step * 3 : step * 3 + 36])))
    base = [f"b{i}" for i in range(40)]
    for _ in range(150):
        ws = list(base)
        for _ in range(random_.randint(0, 3)):
            ws[random_.randrange(40)] = f"n{random_.randrange(10**6)}"
        rows.append((len(rows), " ".join(ws)))
    rows += [(len(rows) + i, " ".join(base)) for i in range(200)]
    random_.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(df, words=2).collect()}
    assert got == brute.components(sorted(rows), 2)


def test_near_duplicates_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    test_near_duplicates_chains_and_hot_groups(spark)


def test_near_duplicates_without_ids_and_rows(spark, empty):
    long = "one two three four five six seven eight nine ten"
    rows = [(None, long), (None, long), (3, long), (4, None), (None, "alone here"), (5, "x y"), (5, "x y"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(near.near_duplicates(df).collect(), key=str)
    assert [r["component_id"] for r in got if r["n_shingles"] == 6] == [3, 3, 3]
    assert [r["kept"] for r in got if r["doc_id"] is None and r["n_shingles"] == 6] == [False, False]
    assert [(r["component_id"], r["kept"]) for r in got if r["n_shingles"] == 0] == [(4, True), (None, True)]
    assert near.near_duplicates(empty).count() == 0


def test_mixing_targets(spark):
    random_ = random.Random(1)
    for case in range(12):
        names = [None, "", "a", "B", "é", "zz", "s10", "s9"][: random_.randint(1, 8)]
        sizes = {s: random_.choice([0, 1, 10, 1000, random_.randint(1, 10**6)]) for s in names}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in mixing.targets(rows, (3, 1, 2), 1.5).collect()}
        want = brute.targets(sizes)
        assert got.keys() == want.keys()
        for s in want:
            assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6), (case, sizes)


def test_permutation():
    for size in (1, 2, 3, 10, 100, 1000, 4097):
        seen = mixing.permuted(np.arange(size), np.full(size, size), np.full(size, 77, np.uint64))
        assert sorted(seen.tolist()) == list(range(size))


def test_mixing(docs):
    mixed, plan, rows = mixing.mix(docs, keep=["doc_id"], block_words=8, shards=3)
    got = mixed.collect()
    texts = {r[0]: r[1] or "" for r in awkward()}
    sizes, source_of = {}, {r[0]: r[3] for r in awkward()}
    for i, t in texts.items():
        sizes[source_of[i]] = sizes.get(source_of[i], 0) + len(brute.words(t))
    planned = {r["source"]: r for r in plan.collect()}
    assert {s: r["source_size"] for s, r in planned.items()} == sizes
    taken, of_doc, blocks, epochs = Counter(), Counter(), defaultdict(list), defaultdict(list)
    for r in got:
        assert len(brute.words(r["piece"])) == r["n_words"] and r["source"] == source_of[r["doc_id"]]
        taken[r["source"]] += r["n_words"]
        of_doc[r["doc_id"]] += r["n_words"]
        blocks[r["source"], r["slot"]].append(r)
        epochs[r["doc_id"], r["epoch"]].append(r)
    for s, r in planned.items():
        # A slot more or less, and the last block that may be short.
        assert abs(taken[s] - r["target"]) <= 2 * 8
        assert len({slot for source, slot in blocks if source == s}) == r["slots"]
    for i, n in of_doc.items():
        assert n <= 2 * len(brute.words(texts[i]))
    for (source, _), part in blocks.items():
        assert sum(r["n_words"] for r in part) <= 8 and len({(r["block"], r["epoch"]) for r in part}) == 1
    for (i, _), part in epochs.items():
        part.sort(key=lambda r: r["first_word"])
        if sum(r["n_words"] for r in part) == len(brute.words(texts[i])):
            assert "".join(r["piece"] for r in part) == texts[i]
    again = mixing.mix(docs.repartition(3), keep=["doc_id"], block_words=8, shards=3)[0].collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixing_of_nothing(empty):
    assert mixing.mix(empty)[0].count() == 0


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 2000])
def test_sharding(docs, bucket_bytes):
    wide = docs.union(docs.where("doc_id = 2")).union(docs.where("doc_id = 2"))
    wide = wide.union(docs.withColumn("doc_id", F.lit(None).cast("bigint")))
    got = sharding.shard(wide, bucket_bytes=bucket_bytes).collect()
    assert len(got) == wide.count()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["text"], r["a.b"]) for r in got) == Counter(
        (r["doc_id"], r["text"], r["a.b"]) for r in wide.collect()
    )
    law = {r["doc_id"]: r["shard"] for r in got}
    assert all(r["shard"] == law[r["doc_id"]] for r in got)
    place = lambda rows: sorted((r["shard"], r["slot"], r["doc_id"]) for r in rows)
    if bucket_bytes > 2000:
        assert place(sharding.shard(wide.repartition(2), bucket_bytes=bucket_bytes).collect()) == place(got)
        other = place(sharding.shard(wide, bucket_bytes=bucket_bytes, seed=9).collect())
        assert other != place(got)


def test_sharding_grows_into_the_new_shard_only(spark):
    ids = spark.range(2000).select(F.col("id"), sharding.shard_of(F.col("id"), 8, 1).alias("a"), sharding.shard_of(F.col("id"), 9, 1).alias("b"))
    rows = ids.collect()
    assert all(r["a"] == r["b"] or r["b"] == 8 for r in rows)
    assert 150 < sum(r["b"] == 8 for r in rows) < 300


def test_sharding_of_copies_of_one_row(spark, empty):
    same = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("x" * 50).alias("text"))
    rows = sharding.shard(same, bucket_bytes=1000)
    assert sorted(r["slot"] for r in rows.collect()) == list(range(3000))
    assert sharding.shard(empty).count() == 0


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


@pytest.mark.parametrize("exact", [1_000_000, 30])
def test_lm_base_score(docs, exact):
    got = by_id(lm.score_documents(docs, exact_words=exact))
    tok = lambda t: brute.words(brute.lower(t)) + [None]
    counts = Counter(w for r in awkward() if not held(r[0]) for w in tok(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    for row in awkward():
        ws, r = tok(row[1]), got[row[0]]
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"]) == (len(ws), sum(counts[w] > 0 for w in ws))
        assert (r["train_tokens"], r["held_out"]) == (total, held(row[0]))


def test_lm_model_score(docs):
    """Against exact levels; a false probe of the filter may only raise a level."""
    got = by_id(lm.score_documents(docs))
    tok = lambda t: brute.words(brute.lower(t)) + [None]
    one, two = Counter(), Counter()
    for r in awkward():
        if not held(r[0]):
            ws = tok(r[1])
            one.update(ws)
            two.update(zip([None, *ws], ws))
    level = lambda c: int(lm.level_of(np.array([float(c)]))[0])
    mass = sum(lm.MIDDLE[level(c)] + 0.5 for c in one.values()) + 0.5

    def score(ws, prior, own=0):
        total = 0.0
        for v, w in zip([None, *ws], ws):
            single = (lm.MIDDLE[level(one[w])] + 0.5) / mass
            context = max(lm.HIGHEST[level(one[v])] - own, 0)
            pair = min(max(lm.LOWEST[level(two[v, w])] - own, 0), context)
            total += np.log10((pair + prior * single) / (context + prior))
        return total

    fit = {p: sum(score(tok(r[1]), p, 1) for r in awkward() if not held(r[0])) for p in lm.PRIORS}
    prior = max(fit, key=fit.get)
    want = {r[0]: score(tok(r[1]), prior) for r in awkward()}
    close = sum(abs(got[i]["score"] - x) <= 0.02 * abs(x) + 0.5 for i, x in want.items())
    assert close >= 0.97 * len(got)


def test_lm_levels_are_found_again():
    rng = np.random.default_rng(2)
    hashes = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    counts = rng.geometric(0.2, len(hashes)).astype(np.uint64)
    width, bits = lm.built(hashes, lm.level_of(counts))
    found, true = lm.probed(width, bits, hashes), lm.level_of(counts)
    assert (found >= true).all() and (found == true).mean() > 0.97
    assert (lm.probed(width, bits, rng.integers(0, 2**63, 250_000, dtype=np.uint64)) > 0).mean() < 0.02


def test_lm_filter_blocks_cover_all_slots():
    widths = [(0, 800), (3, 80_000), (4, 8), (9, 8000), (10, 8000)]
    last = int(np.iinfo(np.int64).max)
    assert lm.blocks_of(widths, 1500) == [(0, 2), (3, 3), (4, 9), (10, last)]
    assert lm.blocks_of(widths, 1 << 20) == [(0, last)] and lm.blocks_of([], 5) == [(0, last)]


def test_lm_cutoffs_and_empty_training(spark, docs, empty):
    small = lm.score_documents(docs, filter_bytes=2000, exact_words=10)
    assert small.where("score IS NULL OR score > 0 OR isnan(score)").count() == 0
    assert lm.score_documents(empty).count() == 0
    only = next(i for i in range(100) if held(i))
    rows = lm.score_documents(spark.createDataFrame([(only, "a b")], "doc_id bigint, text string")).collect()
    assert rows[0]["train_tokens"] == 0 and rows[0]["n_known"] == 0 and rows[0]["n_tokens"] == 3


def test_token_counts_equal_a_tokenizer(docs, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers

    random_ = random.Random(4)
    alphabet = ["a", "b", "c", "h", "é", "▁", "\n"]
    names = {"▁", *alphabet[:3]} | {"".join(random_.choice(alphabet) for _ in range(random_.randint(1, 4))) for _ in range(60)}
    vocabulary = [("<unk>", 0.0)] + [(p, -float(random_.randint(1, 4))) for p in sorted(names)]
    vocabulary += [(f"<0x{b:02X}>", -9.0) for b in range(256)]
    for fallback in (True, False):
        tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=fallback))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
        got = by_id(tokens.token_counts(docs, vocabulary, 0, byte_fallback=fallback))
        for row in awkward():
            assert got[row[0]]["n_tokens"] == len(tokenizer.encode(row[1] or "").ids)
            assert got[row[0]]["a.b"] == row[7]
    assert tokens.token_counts(empty, vocabulary, 0).count() == 0
    with pytest.raises(ValueError):
        tokens.token_counts(docs, [], 0)


def test_public_vocabulary():
    import os

    from tokenizers import Tokenizer, models, pre_tokenizers

    path = os.path.join(tokens.TOKENIZER_FOLDER, "piece_bpe_32k.model")
    if not os.path.exists(path):
        pytest.skip("no vocabulary files here")
    vocabulary, unknown = tokens.piece_vocabulary(path)
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = tokens.UnigramCounter(vocabulary, unknown)
    texts = [r[1] or "" for r in awkward(30)] + ["漢字 <unk>x <s>", "  two  blanks", "▁▁", "😀😀 a"]
    assert [counter.of_text(t)[0] for t in texts] == [len(tokenizer.encode(t).ids) for t in texts]



def test_lm_scores_do_not_depend_on_the_size_of_a_filter(docs):
    """A small filter means more ranges of hashes; no n-gram is given up, so only false probes differ."""
    whole, small = by_id(lm.score_documents(docs)), by_id(lm.score_documents(docs, filter_bytes=2000))
    close = sum(abs(small[i]["score"] - r["score"]) <= 0.02 * abs(r["score"]) + 0.5 for i, r in whole.items())
    assert close >= 0.97 * len(whole)


def test_lm_chunks_of_any_size_give_the_same(docs, monkeypatch):
    whole = by_id(lm.score_documents(docs))
    monkeypatch.setattr(lm, "CHUNK_BYTES", 1000)
    small = by_id(lm.score_documents(docs))
    assert small.keys() == whole.keys()
    assert all(small[i]["score"] == pytest.approx(r["score"], rel=1e-9) for i, r in whole.items())


@pytest.mark.parametrize("order", [1, 2])
def test_lm_ngrams_travel_as_differences(order):
    """15,000 n-grams of a chunk in one slot: fewer bytes than the numbers have, and the same numbers again."""
    hashes = np.unique(np.random.default_rng(order).integers(0, 2**64, 15_000, dtype=np.uint64))
    if order == 2:
        hashes = np.sort(hashes & lm.KEPT)
    for some in (hashes, hashes[:1], hashes[:0]):
        blob = lm._narrow(order, some)
        assert (lm._wide(pa.py_buffer(blob), order == 1) == some).all()
    assert order == 1 or len(lm._narrow(2, hashes)) < 0.8 * 5 * len(hashes)
    counts = np.arange(1, 300, dtype=np.uint32) ** 3
    assert (lm._restored(pa.py_buffer(lm._squeezed(counts, 4)), 4, np.uint32) == counts).all()
