"""Neighbours, near duplicates and audit columns against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowmill.errors import InvalidInput
from winnowmill.operators import audit, near_duplicates, neighbors
from winnowmill.plans import block_join


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((300, 16))
    data[200:] = data[7]  # a third of all vectors are the same
    rows = [(i, [float(x) for x in v], f"c{i % 3}") for i, v in enumerate(data)]
    return data, spark.createDataFrame(rows, "id bigint, v array<double>, label string")


def brute(data, k):
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 9)
    out = {}
    for i in range(len(data)):
        order = sorted((j for j in range(len(data)) if j != i), key=lambda j: (-sims[i, j], j))
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("block_rows", [37, 1000])
def test_exact_neighbours_with_a_hot_vector(vectors, block_rows):
    data, df = vectors
    got = {}
    for r in neighbors.nearest_neighbors(df, "id", "v", 5, "label", "exact", block_rows=block_rows).collect():
        got.setdefault(r.id, {})[r.rank] = r.neighbor_id
        assert r.neighbor_label == f"c{r.neighbor_id % 3}"
    assert {i: [n[j] for j in sorted(n)] for i, n in got.items()} == brute(data, 5)


def test_cells_that_cannot_hold_a_neighbour_are_skipped(spark):
    """Clustered vectors, one cluster a third of all, some vectors of zeros: most pairs of cells are never compared."""
    rng = np.random.default_rng(6)
    centers = rng.standard_normal((30, 16)) * 4
    sizes = [300] + [20] * 29
    data = np.concatenate([c + rng.standard_normal((n, 16)) * 0.3 for c, n in zip(centers, sizes)] + [np.zeros((3, 16))])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")
    rows = neighbors.nearest_neighbors(df, "id", "v", 5, cell_rows=20, block_rows=64).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    assert got == brute(data, 5)
    vectors = df.select("id", F.col("v").alias("vec"), F.lit(None).cast("string").alias("label"))
    cells, pivots = neighbors._in_cells(vectors, len(data), 20)
    bounded = cells.select("id", "vec", "cell", F.lit(0.95).alias("bound"))
    visits = neighbors.cells_to_visit(bounded, cells, pivots).count()
    assert visits < 0.3 * len(data) * len(pivots)


def test_vectors_without_clusters_are_visited_by_groups(spark, monkeypatch):
    """No cell can be ruled out, yet what is kept of the visits does not grow with rows times cells."""
    data = np.random.default_rng(8).standard_normal((600, 16))
    data[500:] = data[3]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")
    kept = {}

    def written(table, name, write=neighbors.written):
        out = write(table, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(neighbors, "written", written)
    got = {}
    for r in sorted(neighbors.nearest_neighbors(df, "id", "v", 5, cell_rows=10, block_rows=64).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    assert got == brute(data, 5)
    assert kept["neighbor-visits"] <= 600


def test_tables_with_a_row_per_vector_are_not_collected_for_a_broadcast(spark, monkeypatch, capsys):
    """Copies of one vector make files far smaller than their rows; only the places of cells and the visits of groups go through the driver."""
    df = spark.range(2000).select("id", F.array(*[F.lit(float(x)) for x in (3, 1, 2)]).alias("v"))
    sent = {}

    def written(table, name, write=neighbors.written):
        capsys.readouterr()
        table.explain()
        sent[name] = capsys.readouterr().out.count("BroadcastExchange")
        return write(table, name)

    monkeypatch.setattr(neighbors, "written", written)
    rows = neighbors.nearest_neighbors(df, "id", "v", 5, cell_rows=500).where("rank = 5").collect()
    assert {r.id: r.neighbor_id for r in rows} == {i: 4 + (i < 5) for i in range(2000)}
    # Bounds: the places, once. Own: the places for queries and for the cells of groups, and these cells.
    assert sent["neighbor-bounds"] == 1 and sent["neighbor-own"] == 3


def test_hashed_neighbours_find_most(spark):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((20, 16)) * 3
    data = np.concatenate([c + rng.standard_normal((20, 16)) * 0.3 for c in centers])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")
    found = neighbors.nearest_neighbors(df, "id", "v", 5, None, "hashed", block_rows=40, bits=4).collect()
    want = brute(data, 5)
    assert len(found) == 5 * len(data)
    assert sum(r.neighbor_id in want[r.id] for r in found) / (5 * len(data)) > 0.9
    with pytest.raises(InvalidInput):
        neighbors.nearest_neighbors(df, "id", "v", 5, None, "guess")


def test_isolated_vectors_have_neighbours_and_are_outliers(spark):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.standard_normal(16) * 3 + rng.standard_normal((100, 16)) * 0.1, -10 * np.eye(16)[:3]])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<double>")
    found = neighbors.nearest_neighbors(df, "id", "v", 5, None, "hashed", block_rows=16, bits=12, tables=4)
    assert {r.id: r["count"] for r in found.groupBy("id").count().collect()} == {i: 5 for i in range(103)}
    want = brute(data, 5)
    assert {r.neighbor_id for r in found.where("id = 101").collect()} == set(want[101])
    scores = {r.id: r.is_outlier for r in neighbors.outlier_scores(found, "id", 0.97).collect()}
    assert [i for i, out in scores.items() if out] == [100, 101, 102] or sum(scores.values()) == 3


def test_class_list_is_bounded(spark):
    df = spark.range(50).select(F.col("id").alias("label"))
    assert neighbors.label_classes(df, "label") == list(range(50))
    with pytest.raises(InvalidInput):
        neighbors.label_classes(df, "label", limit=49)


# --- near duplicates -----------------------------------------------------------------------------


def _shingles(text, n=5):
    words = " ".join(text.lower().split()).split(" ")
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if text.strip() else set()


def brute_clusters(texts, threshold):
    sets = {i: _shingles(t) for i, t in texts.items() if t is not None}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = {i: " ".join(t.lower().split()) for i, t in texts.items() if t is not None}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and (
                keys[a] == keys[b]
                or (sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold)
            ):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    sizes = {}
    for i in texts:
        sizes[root(i)] = sizes.get(root(i), 0) + 1
    return {i: root(i) if sizes[root(i)] > 1 else None for i in texts}


def corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts, sources = {}, [[rng.choice(words) for _ in range(80)] for _ in range(40)]
    for i in range(40):
        texts[i] = " ".join(sources[i])
    for i in range(40, 80):  # near copies with one or two words changed, clearly above the threshold
        copy = list(sources[rng.randrange(10)])
        copy[rng.randrange(80)] = "edited"
        texts[i] = " ".join(copy)
    for i in range(80, 150):  # a third of all rows: near copies of one source, each edited elsewhere
        copy = list(sources[3])
        copy[i - 80] = f"x{i}"
        texts[i] = " ".join(copy)
    for i in range(150, 200):  # equal after normalization
        texts[i] = "  Same\tTEXT \n here " if i % 2 else "same text here"
    texts |= {200: "", 201: "   ", 202: None, 203: "one", 204: "ONE", 205: "two words"}
    return texts


def test_near_duplicates_match_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame(sorted(texts.items()), "id bigint, t string").repartition(5)
    got = {r.id: r for r in near_duplicates.near_duplicates(df, "id", "t", threshold=0.7).collect()}
    assert {i: r.near_duplicate_cluster_id for i, r in got.items()} == brute_clusters(texts, 0.7)
    assert all(r.is_near_duplicate == (r.near_duplicate_cluster_id is not None) for r in got.values())


def test_exact_duplicates(spark):
    texts = corpus()
    df = spark.createDataFrame(sorted(texts.items()), "id bigint, t string").repartition(5)
    got = {r.id: r.near_duplicate_cluster_id for r in near_duplicates.exact_duplicates(df, "id", "t").collect()}
    assert got == brute_clusters(texts, 2.0)


def test_chains_whose_ends_are_unlike(spark):
    """Neighbours in a chain are alike, texts two apart are not: every chain is one cluster."""
    rng, texts = random.Random(3), {}
    for chain in range(60):
        words = [f"c{chain}w{i}" for i in range(200)]
        for step in range(12):
            texts[len(texts)] = " ".join(words[5 * step : 5 * step + 64])
    order = list(texts.items())
    rng.shuffle(order)
    texts = {i: t for i, (_, t) in enumerate(order)}
    df = spark.createDataFrame(sorted(texts.items()), "id bigint, t string").repartition(5)
    got = {r.id: r.near_duplicate_cluster_id for r in near_duplicates.near_duplicates(df, "id", "t").collect()}
    assert got == brute_clusters(texts, 0.8)
    assert len(set(got.values())) == 60


def test_many_texts_that_share_a_rare_shingle_stay_apart(spark):
    """5,000 texts with one sentence in common, which is rarer than what else they have, and a few that are alike."""
    rng, texts = random.Random(4), {}
    common = [f"s{i}" for i in range(12)]
    for i in range(5000):
        texts[i] = " ".join([f"v{rng.randrange(9)}" for _ in range(25)] + common)
    for i in range(5000, 5040):
        texts[i] = texts[i - 4000] + f" z{i % 3}"
    df = spark.createDataFrame(sorted(texts.items()), "id bigint, t string").repartition(5)
    got = {r.id: r.near_duplicate_cluster_id for r in near_duplicates.near_duplicates(df, "id", "t").collect()}
    want = brute_clusters({i: t for i, t in texts.items() if 1000 <= i < 1100 or i >= 5000}, 0.8)
    assert {i: got[i] for i in want} == want
    assert sum(c is not None for c in got.values()) == sum(c is not None for c in want.values())


def test_sets_travel_only_where_a_pair_may_be_alike(spark, monkeypatch):
    """Pairs of texts with some 275 of 325 shingles in common share many keys and are not alike: no set is sent for each key."""
    rng, texts = random.Random(6), {}
    for pair in range(30):
        words = [f"p{pair}w{i}" for i in range(304)]
        for half in range(2):
            own = list(words)
            for at in rng.sample(range(0, 300, 7), 5 * half):
                own[at] = f"e{pair}h{half}a{at}"
            texts[len(texts)] = " ".join(own)
    texts[len(texts)] = texts[0] + " more"
    sent, links = [], block_join.links
    monkeypatch.setattr(block_join, "links", lambda dealt, *rest: (sent.append(dealt.count()), links(dealt, *rest))[1])
    df = spark.createDataFrame(sorted(texts.items()), "id bigint, t string").repartition(5)
    got = {r.id: r.near_duplicate_cluster_id for r in near_duplicates.near_duplicates(df, "id", "t", threshold=0.9).collect()}
    assert got == brute_clusters(texts, 0.9)
    assert got[0] == 0 and sum(sent) <= len(texts)


def test_ids_that_occur_twice_are_linked_like_others(spark):
    texts = {i: t for i, t in corpus().items() if i < 150 and t}
    rows = sorted(texts.items())
    df = spark.createDataFrame(rows + rows, "id bigint, t string").repartition(5)
    got = near_duplicates.near_duplicates(df, "id", "t", threshold=0.7).select("id", "near_duplicate_cluster_id").distinct().collect()
    known = {i: c for i, c in brute_clusters(texts, 0.7).items() if c is not None}
    assert {r.id: r.near_duplicate_cluster_id for r in got} == {i: known.get(i, i) for i in texts}


@pytest.mark.parametrize("percent", [70, 80, 100])
def test_sketches_leave_no_alike_pair_out(spark, percent):
    rng, sets = random.Random(9), {}
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(700)]
    for i in range(150):
        size = rng.choice([1, 3, 63, 64, 65, 127, 300, 512, 513, 700])
        sets[i] = set(base[:size]) - set(rng.sample(base[:size], rng.randrange(size // 5 + 1))) | {rng.getrandbits(60) for _ in range(size // 20)}
    rows = spark.createDataFrame([(i, sorted(v, key=lambda h: h % (1 << 64))) for i, v in sets.items()], "node bigint, hashes array<bigint>")
    maybe = near_duplicates._maybe_alike(percent)(near_duplicates._sketches(rows).orderBy("node").toArrow())
    alike = near_duplicates._alike(percent)(rows.orderBy("node").toArrow())
    some = refused = 0
    for p in range(150):
        may, are = maybe(p, np.arange(150)), alike(p, np.arange(150))
        assert not (are & ~may).any()
        some, refused = some + int(are.sum()), refused + int((~may).sum())
    assert some > 150 * (percent < 100) and refused > 1000


# --- audit columns -------------------------------------------------------------------------------

CLASSES = ["a", "b", "c"]
PROBS = [
    (1, "a", [0.9, 0.05, 0.05]),
    (2, "a", [0.2, 0.7, 0.1]),
    (3, "b", [0.1, 0.8, 0.1]),
    (4, "b", [0.34, 0.33, 0.33]),
    (5, "c", [0.5, 0.0, 0.5]),
    (6, None, [0.1, 0.1, 0.8]),
    (7, "a", None),
    (8, "z", [0.4, 0.3, 0.3]),
]


def expected_confident():
    given = {c: [p[CLASSES.index(c)] for _, lab, p in PROBS if lab == c and p] for c in CLASSES}
    limit = {c: sum(v) / len(v) for c, v in given.items()}
    out = {}
    for i, _, p in PROBS:
        over = [(q, -CLASSES.index(c), c) for c, q in zip(CLASSES, p or []) if q >= limit[c] - 1e-9]
        out[i] = max(over)[2] if over else None
    return out


def test_label_audit(spark):
    df = spark.createDataFrame(PROBS, "id int, label string, pred_probs array<double>")
    rows = {r.id: r for r in audit.label_audit(df, "pred_probs", "label", CLASSES, top=2).collect()}
    confident = expected_confident()
    assert {i: r.is_label_issue for i, r in rows.items()} == {
        i: confident[i] is not None and lab is not None and confident[i] != lab for i, lab, _ in PROBS
    }
    assert rows[2].suggested_label == "b" and rows[2].p_suggested_label == 0.7 and rows[1].suggested_label is None
    assert rows[5].predicted_label == "a" and rows[5].top_labels == ["a", "c"] and rows[5].top_probs == [0.5, 0.5]
    assert rows[4].is_ambiguous and not rows[1].is_ambiguous
    assert rows[4].ambiguous_score == pytest.approx(-sum(p * math.log(p) for p in (0.34, 0.33, 0.33)) / math.log(3))
    assert [rows[i].is_unlabeled for i in (1, 6)] == [False, True]
    assert rows[1].is_well_labeled and not rows[2].is_well_labeled
    assert rows[7].label_quality is None and not rows[7].is_well_labeled and rows[8].p_given_label is None
    joint = {tuple(r) for r in audit.confident_joint(df, "pred_probs", "label", CLASSES).collect()}
    counts = {}
    for i, lab, _ in PROBS:
        if lab and confident[i]:
            counts[(lab, confident[i])] = counts.get((lab, confident[i]), 0) + 1
    assert joint == {(*key, n) for key, n in counts.items()}


def test_full_audit_feeds_corrections(spark, vectors):
    from winnowmill.operators.corrections import apply_corrections
    from winnowmill.operators.rows import select_audit_columns

    _, df = vectors
    texts = df.withColumn("t", F.when(F.col("id") % 10 == 0, "same text").otherwise(F.concat(F.lit("text "), F.col("id"))))
    broken = texts.withColumn("v", F.when(F.col("id") != 5, F.col("v")))
    out = audit.audit(broken, "id", "label", "v", "t", k=5)
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 300 and rows[5].is_not_analyzed and rows[5].label_quality is None
    assert rows[10].near_duplicate_cluster_id == 0 and rows[10].action == "exclude" and rows[0].is_near_duplicate
    fixed = apply_corrections(texts.select("id", "label"), out, "id", "label")
    excluded = sum(r.action == "exclude" for r in rows.values())
    assert fixed.count() == 300 - excluded
    assert {r.id: r.label for r in fixed.collect()}.items() <= {i: r.clean_label for i, r in rows.items()}.items()
    family = select_audit_columns(out, "id", include_project=True).columns
    assert family[:2] == ["id", "clean_label"] and "action" in family and "pred_probs" not in family


def test_audit_with_model_probabilities_only(spark):
    df = spark.createDataFrame([(i, lab, f"text {i}") for i, lab, _ in PROBS], "id int, label string, t string")
    probs = spark.createDataFrame([(i, p) for i, _, p in PROBS], "id int, pred_probs array<double>")
    out = audit.audit(df, "id", "label", text_col="t", pred_probs=probs, classes=CLASSES, fuzzy=True)
    rows = {r.id: r for r in out.collect()}
    assert rows[2].corrected_label == "b" and rows[2].clean_label == "b" and rows[2].action == "correct"
    assert not any(r.is_near_duplicate or r.is_outlier for r in rows.values())
