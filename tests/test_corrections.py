"""Corrections, updates, subsets and synthetic scores on the edge rows that matter."""

import pytest
from pyspark.sql import functions as F

from winnowmill.errors import InvalidInput
from winnowmill.operators import corrections, jobs, rows, synthetic


@pytest.fixture(scope="module")
def dataset(spark):
    return spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "w"), (5, "e", "v"), (None, "n", "u")],
        "id bigint, text string, label string",
    )


@pytest.fixture(scope="module")
def audit(spark):
    return spark.createDataFrame(
        [(1, None, None), (2, "exclude", "q"), (3, "Exclude", "r"), (4, "keep", "s"), (9, None, "t"), (None, None, "z")],
        "id bigint, action string, corrected_label string",
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_audit_driven(dataset, audit):
    out = corrections.apply_corrections(dataset, audit, "id", "label")
    assert out.columns == ["id", "text", "label"]
    assert found(out) == sorted(
        [(1, "a", "x"), (3, "c", "r"), (4, "d", "s"), (9, None, "t"), (None, None, "z")], key=str
    )
    kept = corrections.apply_corrections(dataset, audit, "id", "label", keep_excluded=True)
    assert (2, "b", "q") in found(kept) and kept.columns == ["id", "text", "label"]


def test_audit_driven_equals_an_outer_join(dataset, audit):
    outer = dataset.join(audit, "id", "right").where("action is null or action <> 'exclude'")
    outer = outer.select("id", "text", F.coalesce("corrected_label", "label").alias("label"))
    assert found(corrections.apply_corrections(dataset, audit, "id", "label")) == found(outer)


def test_dataset_driven(dataset, audit):
    out = corrections.apply_corrections(dataset, audit, "id", "label", how="dataset")
    assert found(out) == sorted(
        [(1, "a", "x"), (3, "c", "r"), (4, "d", "s"), (5, "e", "v"), (None, "n", "u")], key=str
    )
    kept = corrections.apply_corrections(dataset, audit, "id", "label", keep_excluded=True, how="dataset")
    assert kept.columns == ["id", "text", "label", "action"] and (2, "b", "q", "exclude") in found(kept)


def test_duplicate_ids_multiply_once(spark):
    data = spark.createDataFrame([(1, "a"), (1, "b")], "id int, label string")
    audit = spark.createDataFrame([(1, None, "c")] * 3, "id int, action string, corrected_label string")
    for how in ("audit", "dataset"):
        assert corrections.apply_corrections(data, audit, "id", "label", how=how).count() == 6


def test_corrections_are_idempotent(dataset, audit):
    once = corrections.apply_corrections(dataset, audit, "id", "label", how="dataset")
    assert found(corrections.apply_corrections(once, audit, "id", "label", how="dataset")) == found(once)


def test_missing_id_is_the_position(spark):
    data = spark.createDataFrame([("c", "z"), ("a", "x"), ("b", "y")], "text string, label string").repartition(3)
    audit = spark.createDataFrame([(0, None, "first"), (2, "exclude", None)], "id bigint, action string, corrected_label string")
    out = corrections.apply_corrections(data, audit, "id", "label", how="dataset", order_by="text")
    assert out.columns == ["text", "label"] and found(out) == [("a", "first"), ("b", "y")]


def test_one_join_per_part_and_no_window(dataset, audit):
    out = corrections.apply_corrections(dataset, audit, "id", "label", how="dataset")
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == 1 and "Window" not in text


def test_argument_errors(dataset, audit):
    with pytest.raises(InvalidInput):
        corrections.apply_corrections(dataset, audit, "id", "nope")
    with pytest.raises(InvalidInput):
        corrections.apply_corrections(dataset, audit, "id", "label", how="outer")
    with pytest.raises(InvalidInput):
        corrections.join_probabilities(dataset, audit, "id", how="right")


def test_matched_null_overrides_and_ids_compare_as_text(spark):
    data = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (3, "e", "f")], "id int, x string, y string")
    updates = spark.createDataFrame([("1", None, 7), ("3", "E", None)], "id string, x string, n int")
    out = corrections.combine_fields(data, updates, "id")
    assert out.columns == ["id", "x", "y", "n"]
    assert found(out) == sorted([(1, None, "b", 7), (2, "c", "d", None), (3, "E", "f", None)], key=str)


def test_subsets(spark):
    df = spark.createDataFrame([(i, 20 - i) for i in range(20)], "a int, k int").repartition(4)

    def pick(subset):
        return [r.k for r in rows.positional_subset(df, subset, "k").collect()]

    assert sorted(pick((2, 5))) == [3, 4, 5]
    assert sorted(pick(range(0, 20, 5))) == [1, 6, 11, 16]
    assert pick([7, 0, -1]) == [8, 1, 20]
    assert pick(range(3, 0, -1)) == [4, 3, 2]
    assert len(pick(None)) == 20
    for bad in ([], (), (1,)):
        with pytest.raises(InvalidInput):
            rows.positional_subset(df, bad, "k")


def test_preview_is_seeded_and_limited(spark):
    df = spark.range(50)
    assert rows.preview_sample(df, "id", seed=1).collect() == rows.preview_sample(df.repartition(5), "id", seed=1).collect()
    assert [r.id for r in rows.preview_sample(df, "id", [4, 2], order_by="id").collect()] == [4, 2]
    with pytest.raises(InvalidInput):
        rows.preview_sample(df, "id", list(range(11)))


def test_detail_columns_need_all_companions():
    columns = ["c", "c_trustworthiness_score", "c_raw", "c_log", "d", "d_raw", "e_log"]
    assert rows.enriched_columns(columns) == ["c"]


def cleanset(spark, data):
    return spark.createDataFrame(
        data, "id int, real_or_synthetic string, label_issue_score double, is_near_duplicate boolean, near_duplicate_cluster_id int"
    )


S, R = "synthetic", "real"


def test_synthetic_scores(spark):
    df = cleanset(
        spark,
        [(1, S, 0.2, True, 1), (2, S, 0.4, True, 1), (3, S, None, True, 2), (4, R, 0.1, True, 2), (5, R, 0.3, False, None), (6, S, 0.6, True, None), (7, S, 0.0, False, 9), (8, R, 0.2, None, 1)],
    )
    row = synthetic.score_synthetic_dataset(df).first()
    assert row.unrealistic == pytest.approx(1 - 1.2 / 4) and row.unrepresentative == pytest.approx(1 - 0.6 / 3)
    assert (row.unvaried, row.unoriginal) == (2 / 5, 1 / 5)
    assert (row.n_real, row.n_synthetic) == (3, 5)
    assert sorted(r.id for r in synthetic.cluster_contains_other(df, "id").collect()) == [3]
    assert sorted(r.id for r in synthetic.cluster_contains_other(df, "id", contains=False).collect()) == [1, 2]


def test_synthetic_scores_without_duplicates_and_with_other_names(spark):
    df = cleanset(spark, [(1, "gen", 0.5, False, None), (2, "human", 0.25, False, None)])
    row = synthetic.score_synthetic_dataset(df, names=("gen", "human")).first()
    assert tuple(row) == (0.5, 0.75, 0.0, 0.0, 1, 1)


def test_synthetic_scores_want_two_classes(spark):
    one = cleanset(spark, [(1, S, 0.5, True, 1)])
    null = cleanset(spark, [(1, S, 0.5, True, 1), (2, R, 0.5, True, 1), (3, None, 0.5, True, 1)])
    for df in (one, null, cleanset(spark, [(1, R, 0.5, True, 1)])):
        with pytest.raises(Exception, match="two classes"):
            synthetic.score_synthetic_dataset(df).collect()
    assert synthetic.two_class_check(null).first() == (3, False)
    assert synthetic.example_counts(null).first() == (1, 2)
    real_only = cleanset(spark, [(1, R, 0.5, True, 1)])
    row = synthetic.score_synthetic_dataset(real_only, check=False).first()
    assert row.unvaried is None and row.unrealistic is None


def test_jobs(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", None), ("b", 1.0), ("c", None)], "job string, s double")
    got = {r.job: tuple(r)[1:] for r in jobs.job_progress(df, "s", "job").collect()}
    assert got == {"a": (2, 1, 0.5, "RUNNING"), "b": (1, 1, 1.0, "SUCCEEDED"), "c": (1, 0, None, "CREATED")}
    assert jobs.job_progress(df, "s").first() == (4, 2, 0.75, "RUNNING")
    history = spark.createDataFrame(
        [("p", 1, "2024-01-02 00:00:00", "FAILED"), ("p", 2, "2024-01-03 00:00:00", "PAUSED"), ("p", 3, "2024-01-03 00:00:00", "ODD"), ("q", 4, "2024-01-01 00:00:00", "CREATED")],
        "project string, job int, at string, status string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    latest = jobs.latest_job(history, "project", "at", "job")
    assert sorted(r.job for r in latest.collect()) == [3, 4]
    states = history.select(jobs.readiness("status"), jobs.readiness("status", F.lit("PREVIEW"))).collect()
    assert [tuple(s) for s in states] == [
        (first, "error: preview")
        for first in ("error: failed", "error: paused", "error: unknown status", "not ready")
    ]
