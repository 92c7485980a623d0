"""Scorers: capture, retries, two stages, enrichment, calibration, trust."""

import sys
import threading
import time

import pandas as pd
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from winnowmill.errors import BadRequest, ConnectionFailed, InvalidInput, NotCalibrated, RateLimited, ScorerFailure
from winnowmill.operators import calibrate, enrich, predict, scoring, trust

# The scorers below travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def echo(batch):
    return pd.DataFrame({"response": batch["prompt"], "trustworthiness_score": 0.5, "perplexity": 0.25})


def grumpy(batch):
    if batch["prompt"].str.contains("bad").any():
        raise BadRequest("bad prompt")
    if batch["prompt"].str.contains("fix").any():
        raise BadRequest("can be fixed", retryable=True)
    if batch["prompt"].str.contains("down").any():
        raise RuntimeError("server down")
    return echo(batch)


def pair_scorer(batch):
    if batch["response"].str.contains("unscored").any():
        raise BadRequest("no score")
    return pd.DataFrame({"trustworthiness_score": [1.0] * len(batch), "explanation": ["fine"] * len(batch)})


def prompts(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, prompt string")


def results(df, column="scored"):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def test_capture_keeps_every_row_and_blames_the_right_one(spark, no_wait):
    df = prompts(spark, "fine", "bad", None, "down", "x" * 280_001, "fix", "ok")
    out = scoring.score_prompts(df, "prompt", grumpy, "capture", id_col="id", policy=no_wait, attempts_col="tries")
    got = results(out)
    assert [r.response for r in got] == ["fine", None, None, None, None, None, "ok"]
    assert [r.trustworthiness_score for r in got] == [0.5, None, None, None, None, None, 0.5]
    errors = [r.log.error for r in got]
    assert errors[0] is None and errors[6] is None
    assert [(e.message, e.retryable) for e in errors[1:6]] == [
        ("bad prompt", False),
        ("the prompt is missing", False),
        ("server down", True),
        ("Error executing query at index 4: Prompt length exceeds maximum length of 70000 tokens", False),
        ("can be fixed", True),
    ]
    assert results(out, "tries")[1] == 1 and results(out, "tries")[3] == 4


@pytest.mark.parametrize("text, message", [("bad", "bad prompt"), (None, "prompt is missing"), ("x" * 280_001, "exceeds maximum")])
def test_strict_mode_fails_the_job(spark, no_wait, text, message):
    with pytest.raises(Exception, match=message):
        scoring.score_prompts(prompts(spark, "fine", text), "prompt", grumpy, "raise", policy=no_wait).collect()


def test_retry_waits():
    waits = []
    policy = scoring.RetryPolicy(sleep=waits.append)
    calls = {"n": 0}

    def fails(kind, times):
        calls["n"] = 0

        def scorer(batch):
            calls["n"] += 1
            if calls["n"] <= times:
                raise kind
            return echo(batch)

        waits.clear()
        return scoring._scored_once(scorer, pd.DataFrame({"prompt": ["p"]}), policy)

    assert fails(RuntimeError("x"), 9)[1:] == ("x", True, 4) and waits == [1, 2, 4]
    assert fails(ConnectionFailed("c"), 99)[3] == 21 and waits[:7] == [1, 2, 4, 8, 16, 32, 60] and len(waits) == 20
    assert fails(RateLimited(retry_after=0.5), 30)[3] == 31 and waits == [0.5] * 30
    assert fails(BadRequest("b"), 1)[3] == 1 and waits == []
    assert fails(RuntimeError("x"), 2)[0]["response"] == "p"


def test_a_batch_is_halved_and_good_rows_are_sent_few_times():
    calls = []

    def scorer(batch):
        calls.append(list(batch["prompt"]))
        return grumpy(batch)

    batch = pd.DataFrame({"prompt": [f"p{i}" for i in range(63)] + ["bad"]})
    out = scoring._run_batch(scorer, batch, True, scoring.RetryPolicy(sleep=lambda s: None))
    assert list(out["error_message"].dropna()) == ["bad prompt"] and len(calls) == 13
    assert list(out["response"].dropna()) == list(batch["prompt"][:63])


def test_waits_are_shared_by_a_batch():
    waits = []

    def down(batch):
        raise ConnectionFailed("down")

    policy = scoring.RetryPolicy(sleep=waits.append)
    out = scoring._run_batch(down, pd.DataFrame({"prompt": ["p"] * 50}), True, policy)
    assert list(out["error_message"]) == ["down"] * 50 and len(waits) == 20


def test_timeout_and_deadline():
    now = {"t": 0.0}

    def slow(batch):
        now["t"] += 1
        if batch["prompt"].eq("hang").any():
            threading.Event().wait(5)
        return grumpy(batch)

    policy = scoring.RetryPolicy(retries=0, timeout=0.2, sleep=lambda s: None)
    out = scoring._run_batch(slow, pd.DataFrame({"prompt": ["a", "hang", "b"]}), True, policy)
    assert list(out["error_message"].fillna("")) == ["", "the scorer took longer than 0.2 seconds", ""]
    with pytest.raises(ScorerFailure, match="longer than 0.2"):
        scoring._run_batch(slow, pd.DataFrame({"prompt": ["hang"]}), False, policy)
    policy = scoring.RetryPolicy(deadline=3, clock=lambda: now["t"], sleep=lambda s: None)
    out = scoring._run_batch(slow, pd.DataFrame({"prompt": ["down"] * 40}), True, policy)
    assert "the batch took longer than 3 seconds" in set(out["error_message"]) and now["t"] < 20


def test_input_checks(spark):
    df = prompts(spark, "a")
    for call in (
        lambda: scoring.score_prompts(df, "id", echo),
        lambda: scoring.score_prompts(df, "nope", echo),
        lambda: scoring.score_prompts(df, "prompt", echo, "ignore"),
        lambda: scoring.score_prompts(df, "prompt", echo, options=[]),
        lambda: scoring.score_prompts(df, "prompt", echo, options="prompt"),
    ):
        with pytest.raises(InvalidInput):
            call()


def test_options_for_all_rows(spark):
    out = scoring.score_prompts(prompts(spark, "it is YES", "unclear"), "prompt", echo, options=["Yes", "No", "other"])
    assert [r.response for r in results(out)] == ["Yes", "other"]


def test_pairs_check_perplexity_and_lengths(spark):
    df = spark.createDataFrame(
        [(0, "p", "r", 0.5), (1, "p", "r", 1.5), (2, "p", "r", None), (3, "p" * 230_000, "r" * 59_000, None), (4, "p", "r" * 60_001, 0.1), (5, "p", None, 0.1)],
        "id int, prompt string, response string, perplexity double",
    )
    got = results(scoring.score_pairs(df, "prompt", "response", pair_scorer, "perplexity", "capture"))
    assert [r.trustworthiness_score for r in got] == [1.0, None, 1.0, None, None, None]
    assert [r.log.error and r.log.error.message.split(" exceeds")[0] for r in got] == [
        None,
        "perplexity must be between 0 and 1",
        None,
        "Prompt and response combined length",
        "Response length",
        "the response is missing",
    ]


def test_two_stages(spark, no_wait):
    df = prompts(spark, "fine", "bad", "unscored")
    out = scoring.respond_then_score(df, "prompt", grumpy, pair_scorer, "capture", policy=no_wait)
    a, b, c = results(out)
    assert (a.response, a.trustworthiness_score, a.log.explanation, a.log.error) == ("fine", 1.0, "fine", None)
    assert (b.response, b.trustworthiness_score, b.log.error.message) == (None, None, "bad prompt")
    assert (c.response, c.trustworthiness_score, c.log.error.message) == ("unscored", None, "no score")
    assert out.columns == ["id", "prompt", "scored"]
    all_failed = scoring.respond_then_score(prompts(spark, "bad"), "prompt", grumpy, pair_scorer, "capture", policy=no_wait)
    assert results(all_failed)[0].log.error.message == "bad prompt"

    def silent(batch):
        return pd.DataFrame({"response": [None] * len(batch), "trustworthiness_score": [None] * len(batch)})

    with pytest.raises(Exception, match="without a response"):
        scoring.respond_then_score(df, "prompt", silent, pair_scorer, "raise", policy=no_wait).collect()


def test_scorer_runs_once_per_row(spark):
    seen = spark.sparkContext.accumulator(0)

    def counting(batch):
        seen.add(len(batch))
        return echo(batch)

    out = scoring.score_prompts(prompts(spark, *["p"] * 30), "prompt", counting, options=["p", "q"])
    scoring.unpack_result(out.withColumn("again", F.col("scored.log.perplexity")), "scored").collect()
    assert seen.value == 30


def test_pair_lists_want_equal_lengths(spark):
    good = spark.createDataFrame([(1, ["a", "b"], ["x", "y"])], "id int, p array<string>, r array<string>")
    assert [tuple(r) for r in scoring.pair_lists(good, "p", "r", "id").collect()] == [(1, 0, "a", "x"), (1, 1, "b", "y")]
    bad = spark.createDataFrame([(1, ["a"], ["x", "y"])], "id int, p array<string>, r array<string>")
    with pytest.raises(Exception, match="same length"):
        scoring.pair_lists(bad, "p", "r", "id").collect()


def test_enrich(spark):
    df = spark.createDataFrame([(i, f"color {c}") for i, c in enumerate(["red", "blue", "grey", "Red"])], "id int, t string")
    out = enrich.enrich(df, "{t}", echo, regex="color (.*)", constrain=["red", "blue", "other"], optimize=False, subset=None, keep=["id"])
    assert out.columns == ["id", "metadata", "metadata_trustworthiness", "metadata_log"]
    assert [r.metadata for r in out.orderBy("id").collect()] == ["red", "blue", "red", "red"]
    first = enrich.enrich(df, "{t}!", echo, new_column="n", order_by="id")
    assert [tuple(r) for r in first.collect()] == [("color red!", 0.5), ("color blue!", 0.5), ("color grey!", 0.5)]
    optimized = enrich.enrich(df, "{t}", echo, constrain=["a", "b"], subset=[0], order_by="id").first()
    assert optimized.metadata_log.startswith("Your answer must exactly match one of the following values: [a, b].\n")


def test_enrich_project_preview_and_joins(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "row_id bigint, t string")
    options = enrich.EnrichmentOptions("say ${t}", regex=("say ", ""))
    out = enrich.enrich_project(df, options, "c", echo, "row_id")
    assert out.columns == ["row_id", "c", "c_trustworthiness_score", "c_raw", "c_log"]
    stored = out.withColumn("row_id", F.col("row_id") + 1).withColumnRenamed("row_id", "stored_row_id").where("c <> 'v3'")
    back = enrich.enrichment_results(stored)
    joined = enrich.join_enrichment(df, back, "row_id")
    assert joined.columns == ["row_id", "t", "c", "c_trustworthiness_score"] and joined.count() == 5
    assert joined.where("c = t").count() == 4
    assert enrich.join_preview(df, back, "row_id", with_details=True).count() == 4
    assert enrich.enrich_preview(df, options, "c", echo, "row_id").count() == 3
    assert enrich.enrich_preview(df, options, "c", echo, "row_id", [4, 0]).count() == 2
    with pytest.raises(InvalidInput):
        enrich.join_enrichment(df, joined, "row_id")
    with pytest.raises(InvalidInput):
        enrich.EnrichmentOptions("")


def test_features_check_their_number(spark):
    def with_criteria(batch):
        criteria = [[{"name": "c", "score": 0.75}] for _ in range(len(batch))]
        return echo(batch).assign(custom_eval_criteria=criteria)

    scored = scoring.score_prompts(prompts(spark, "a"), "prompt", with_criteria)
    assert scoring.score_features(scored, "scored", 1).first().features == [0.5, 0.75]
    with pytest.raises(Exception, match="expected 2 custom criteria"):
        scoring.score_features(scored, "scored", 2).collect()


def test_calibration_is_monotone_and_bounded(spark):
    rows = [([i / 40, (i * 7 % 40) / 40], float(i + i * 13 % 9)) for i in range(40)] + [([0.5, 0.5], None)]
    df = spark.createDataFrame(rows, "features array<double>, rating double")
    model = calibrate.Calibration(2).fit(df, "rating")
    grid = spark.createDataFrame([([a / 10, b / 10],) for a in range(11) for b in range(11)], "features array<double>")
    got = {tuple(r.features): r.calibrated_score for r in model.transform(grid).collect()}
    for (a, b), score in got.items():
        assert 0 <= score <= 1
        assert all(score <= other + 1e-12 for (c, d), other in got.items() if c >= a and d >= b)
    assert model.transform(spark.createDataFrame([([None, 0.5],)], "features array<double>")).first().calibrated_score is None


def test_calibration_errors(spark):
    constant = spark.createDataFrame([([0.1], 3.0), ([0.9], 3.0)], "features array<double>, rating double")
    with pytest.raises(InvalidInput):
        calibrate.Calibration(1).fit(constant, "rating")
    with pytest.raises(InvalidInput):
        calibrate.Calibration(2).fit(constant.withColumn("rating", F.col("features")[0]), "rating")
    with pytest.raises(NotCalibrated):
        calibrate.Calibration(1).transform(constant)


def test_ratings_keep_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),), (5.0,)], "r double")
    assert [r[0] for r in calibrate.normalize_ratings(df, "r").collect()] == [0.0, 0.5, None, None, 1.0]


def test_trust(spark):
    responses = spark.createDataFrame([(1, 1, "The cat sat"), (1, 2, "dogs"), (2, 1, ""), (3, 1, "alone")], "prompt_id int, candidate_id int, text string")
    samples = spark.createDataFrame([(1, 1, "the CAT"), (1, 1, "a dog"), (1, 2, "dogs  dogs"), (2, 1, "")], "prompt_id int, candidate_id int, text string")
    scored = trust.consistency_score(responses, samples)
    got = {(r.prompt_id, r.candidate_id): r.consistency for r in scored.collect()}
    assert got == {(1, 1): pytest.approx(1 / 3), (1, 2): 1.0, (2, 1): 1.0, (3, 1): None}
    reflected = scored.withColumn("reflection", F.when(F.col("prompt_id") != 3, F.lit(0.5)))
    trusted = trust.trust_score(reflected, reflection="reflection", weight=0.5)
    by_key = {(r.prompt_id, r.candidate_id): r.trust for r in trusted.collect()}
    assert by_key[(1, 2)] == 0.75 and by_key[(3, 1)] is None
    assert sorted((r.prompt_id, r.candidate_id) for r in trust.best_candidate(trusted).collect()) == [(1, 2), (2, 1), (3, 1)]
    low = trust.low_trust_rows(trusted, ["prompt_id", "candidate_id"], n=2).collect()
    assert [(r.prompt_id, r.candidate_id) for r in low] == [(1, 1), (1, 2)]


def test_scoring_options():
    assert trust.ScoringOptions.preset("best") == trust.ScoringOptions(6, 8, True)
    assert trust.ScoringOptions.preset("base", samples=2) == trust.ScoringOptions(1, 2, False)
    for bad in (dict(candidates=0), dict(samples=21), dict(candidates=True), dict(self_reflection=1)):
        with pytest.raises(InvalidInput):
            trust.ScoringOptions(**bad)
    for call in (lambda: trust.ScoringOptions.preset("worst"), lambda: trust.ScoringOptions.preset("low", model="x")):
        with pytest.raises(InvalidInput):
            call()


def test_failure_carries_its_kind():
    assert ScorerFailure("m").retryable and not BadRequest("m").retryable and RateLimited().retry_after == 1.0


def test_a_scorer_that_always_fails_alike_is_not_called_for_every_row():
    calls = []

    def broken(batch):
        calls.append(len(batch))
        raise ValueError("no column x")

    policy = scoring.RetryPolicy(sleep=lambda s: None, alike=4)
    out = scoring._run_batch(broken, pd.DataFrame({"prompt": ["p"] * 4096}), True, policy)
    assert len(out) == 4096 and set(out["error_message"]) == {"no column x"} and len(calls) < 60

    def picky(batch):  # good rows between the bad ones: every row gets its own verdict
        if (batch["prompt"] == "bad").any():
            raise ValueError("refused")
        return pd.DataFrame({"response": batch["prompt"]})

    rows = pd.DataFrame({"prompt": ["good", "bad"] * 100})
    out = scoring._run_batch(picky, rows, True, policy)
    assert (out["error_message"].notna() == (rows["prompt"] == "bad")).all()


def test_rate_limits_and_hanging_calls_are_bounded():
    waited = []
    policy = scoring.RetryPolicy(sleep=waited.append, rate_limit_retries=5, timeout=0.05, hung_calls=3)

    def limited(batch):
        raise scoring.RateLimited("slow down", 1.0)

    out = scoring._run_batch(limited, pd.DataFrame({"prompt": ["p"]}), True, policy)
    assert len(waited) == 5 and out["error_message"].notna().all()
    calls = []

    def hanging(batch):
        calls.append(1)
        time.sleep(0.4)
        return pd.DataFrame({"response": batch["prompt"]})

    out = scoring._run_batch(hanging, pd.DataFrame({"prompt": ["p"] * 50}), True, policy)
    assert len(calls) == 3 and out["error_message"].str.contains("did not end|took longer").all()


def test_a_scorer_gets_long_texts_in_parts_and_nothing_it_must_not_see(spark):
    """Texts of 5 MB become rows of Python part by part; prompts beyond the limits stay out of Python."""

    def sizes(batch):
        score = pd.Series(float(batch["prompt"].str.len().sum() <= scoring.SLICE_BYTES), index=batch.index)
        return pd.DataFrame({"response": batch["prompt"].str[:3], "trustworthiness_score": score})

    rows = spark.range(40, numPartitions=1).select("id", F.repeat(F.lit("é"), F.when(F.col("id") < 3, 300_000).otherwise(250_000)).alias("p"))
    got = scoring.score_prompts(rows, "p", sizes, "capture").collect()
    assert len(got) == 40
    for r in got:
        assert r.scored.response == (None if r.id < 3 else "é" * 3)
        assert r.scored.trustworthiness_score == (None if r.id < 3 else 1.0)


def test_parts_of_a_batch_hold_all_rows_in_order():
    texts = pa.array(["a" * 10, None, "b" * 100, "c", "", "d" * 9, None])
    parts = list(scoring.slices([texts, pa.array(range(7))], most=12))
    assert [t for p in parts for t in p[0].to_pylist()] == texts.to_pylist()
    assert [i for p in parts for i in p[1].to_pylist()] == list(range(7))
    assert len(parts) > 3 and list(scoring.slices([pa.array([], pa.string())])) == []


def test_rows_of_a_small_file_are_scored_on_all_cores(spark):
    from catalog.registry import spread

    rows = spread(spark.range(1000, numPartitions=1))
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= 8 and rows.distinct().count() == 1000


def test_a_model_gets_texts_in_parts_and_gives_null_for_what_is_no_number(spark):
    def model(texts):
        share = texts.str.len() / 4e6
        return pd.Series([[s, 1.0 - s] for s in share], index=texts.index)

    rows = spark.range(12, numPartitions=1).select("id", F.when(F.col("id") != 5, F.repeat(F.lit("x"), 1_000_000)).alias("t"))
    got = predict.predict_batch(rows, model, ["a", "b"], input_col="t", id_col="id").collect()
    assert {r.id: (r.a, r.b, r.predicted_label) for r in got} == {i: (None,) * 3 if i == 5 else (0.25, 0.75, "b") for i in range(12)}
