"""Enrichment, row scoring, calibration and trust, with scorers that SQL can repeat."""

import time

import pandas as pd
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from winnowmill.errors import BadRequest
from winnowmill.functions import probabilities
from winnowmill.operators import calibrate, enrich, predict, scoring, trust
from winnowmill.plans.lineage import durable

from .registry import SQUARE_CLASSES, SQUARES, query, rounded, rounded_array, spread, square_probs, table

NO_WAIT = scoring.RetryPolicy(sleep=lambda seconds: None)


def echo(batch: pd.DataFrame) -> pd.DataFrame:
    """Answers with the prompt itself; the score depends on its length."""
    size = batch["prompt"].str.len()
    return pd.DataFrame({"response": batch["prompt"], "trustworthiness_score": (size % 97) / 97.0})


def picky(batch: pd.DataFrame) -> pd.DataFrame:
    """Like ``echo``, with a perplexity, but refuses prompts with a question mark and two digits."""
    if batch["prompt"].str.contains(r"\?.*[0-9][0-9]", regex=True).any():
        raise BadRequest("refused")
    return echo(batch).assign(perplexity=0.25)


def pair_scorer(batch: pd.DataFrame) -> pd.DataFrame:
    """Scores a response by its length relative to the prompt."""
    p, r = batch["prompt"].str.len(), batch["response"].str.len()
    criteria = [[{"name": "brevity", "score": 1.0 / (1 + n)}] for n in r]
    return pd.DataFrame({"trustworthiness_score": r / (p + r), "custom_eval_criteria": criteria}, index=batch.index)


def _score(length: str) -> str:
    return f"round(({length} % 97) / 97.0::DOUBLE, 6)"


DOC_PROMPT = "'Summarize ' || text || ' from ' || source"


@query(f"""
WITH p AS (SELECT doc_id, {DOC_PROMPT} AS prompt FROM documents)
SELECT doc_id, prompt AS metadata, {_score('length(prompt)')} AS metadata_trustworthiness FROM p
""")
def enrich_basic(spark, sf):
    out = enrich.enrich(
        table(spark, sf, "documents"), "Summarize {text} from {source}", echo, subset=None, keep=["doc_id"]
    )
    return out.withColumn("metadata_trustworthiness", rounded("metadata_trustworthiness"))


# Every source starts with one of the options, so that SQL can tell the answer without a similarity.
SOURCES = [f"src{i}" for i in range(10)]


@query(f"""
WITH p AS (SELECT doc_id, 'Your answer must exactly match one of the following values: [{', '.join(SOURCES)}].' || chr(10) || {DOC_PROMPT} AS prompt, source FROM documents)
SELECT doc_id, regexp_extract(source, 'src[0-9]') AS origin, {_score('length(prompt)')} AS origin_trustworthiness, prompt AS origin_log FROM p
""")
def enrich_regex(spark, sf):
    out = enrich.enrich(
        table(spark, sf, "documents"),
        "Summarize {text} from {source}",
        echo,
        regex=r"(?s).* from (src[0-9]+)",
        constrain=SOURCES,
        subset=None,
        new_column="origin",
        keep=["doc_id"],
    )
    return out.withColumn("origin_trustworthiness", rounded("origin_trustworthiness"))


PROJECT = enrich.EnrichmentOptions(prompt="From ${source} in ${lang}: ${text}", regex=[("From (src[0-9]+)(?s:.*)", r"\1")])


def _project(spark, sf):
    out = enrich.enrich_project(table(spark, sf, "documents"), PROJECT, "origin", echo, "doc_id")
    return out.withColumn("origin_trustworthiness_score", rounded("origin_trustworthiness_score"))


PROJECT_SQL = f"""
p AS (SELECT doc_id, source, 'From ' || source || ' in ' || lang || ': ' || text AS prompt FROM documents),
results AS (SELECT doc_id, source AS origin, {_score('length(prompt)')} AS origin_trustworthiness_score,
            prompt AS origin_raw, CAST(NULL AS VARCHAR) AS origin_log FROM p)
"""


@query(f"WITH {PROJECT_SQL} SELECT * FROM results")
def enrich_project(spark, sf):
    return _project(spark, sf)


@query(f"WITH {PROJECT_SQL} SELECT * FROM results ORDER BY md5(doc_id::VARCHAR || '3'), doc_id LIMIT 3")
def enrich_preview(spark, sf):
    out = enrich.enrich_preview(table(spark, sf, "documents"), PROJECT, "origin", echo, "doc_id", seed=3)
    return out.withColumn("origin_trustworthiness_score", rounded("origin_trustworthiness_score"))


@query(f"WITH {PROJECT_SQL} SELECT doc_id AS row_id, origin, origin_raw FROM results")
def enrich_results(spark, sf):
    stored = _project(spark, sf).select((F.col("doc_id") + 1).alias("stored_row_id"), "origin", "origin_raw")
    return enrich.enrichment_results(stored)


@query(f"""
WITH {PROJECT_SQL} SELECT d.doc_id, d.text, d.n_chars, r.origin, r.origin_trustworthiness_score
FROM documents d LEFT JOIN results r ON r.doc_id = d.doc_id AND r.origin <> 'src3'
""")
def enrich_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    return enrich.join_enrichment(docs, _project(spark, sf).where("origin <> 'src3'"), "doc_id")


@query(f"""
WITH {PROJECT_SQL} SELECT d.doc_id, d.n_chars, r.origin, r.origin_trustworthiness_score, r.origin_raw, r.origin_log
FROM documents d JOIN results r ON r.doc_id = d.doc_id AND r.origin <> 'src3'
""")
def preview_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return enrich.join_preview(docs, _project(spark, sf).where("origin <> 'src3'"), "doc_id", with_details=True)


REFUSED = r"regexp_matches(text, '\?[^\n]*[0-9][0-9]')"


@query(f"""
SELECT conv_id, turn, CASE WHEN NOT {REFUSED} THEN text END AS response,
  CASE WHEN NOT {REFUSED} THEN {_score('length(text)')} END AS trustworthiness_score,
  CASE WHEN {REFUSED} THEN 'refused' END AS error, CASE WHEN {REFUSED} THEN false END AS retryable
FROM conversations
""")
def score_prompts_capture(spark, sf):
    scored = scoring.score_prompts(table(spark, sf, "conversations"), "text", picky, "capture", policy=NO_WAIT)
    return scored.select(
        "conv_id",
        "turn",
        F.col("scored.response").alias("response"),
        rounded("scored.trustworthiness_score").alias("trustworthiness_score"),
        F.col("scored.log.error.message").alias("error"),
        F.col("scored.log.error.retryable").alias("retryable"),
    )


PAIRS = """
pairs AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')
"""


def _pairs(spark, sf):
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    given = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(given, ["conv_id", "turn"])


@query(f"""
WITH {PAIRS} SELECT conv_id, turn, response,
  round(length(response)::DOUBLE / (length(prompt) + length(response)), 6) AS trustworthiness_score FROM pairs
""")
def score_pairs(spark, sf):
    scored = scoring.score_pairs(_pairs(spark, sf), "prompt", "response", pair_scorer, on_error="capture")
    out = scoring.unpack_result(scored.drop("prompt", "response"), "scored")
    return out.withColumn("trustworthiness_score", rounded("trustworthiness_score"))


@query(f"""
SELECT conv_id, turn, CASE WHEN NOT {REFUSED} THEN text END AS response,
  CASE WHEN NOT {REFUSED} THEN 0.5::DOUBLE END AS trustworthiness_score, CASE WHEN {REFUSED} THEN 'refused' END AS error
FROM conversations
""")
def respond_then_score(spark, sf):
    turns = table(spark, sf, "conversations")
    scored = scoring.respond_then_score(turns, "text", picky, pair_scorer, "capture", policy=NO_WAIT)
    return scored.select(
        "conv_id",
        "turn",
        F.col("scored.response").alias("response"),
        F.col("scored.trustworthiness_score").alias("trustworthiness_score"),
        F.col("scored.log.error.message").alias("error"),
    )


@query("""
WITH o AS (
  SELECT p_partkey, p_name, CASE WHEN contains(p_name, 'bolt') THEN 'Bolt' ELSE 'RING' END AS option FROM part)
SELECT p_partkey, CASE WHEN contains(p_name, lower(option)) THEN option
    WHEN 1 - levenshtein(p_name, option) / greatest(length(p_name), length(option))::DOUBLE >= 0.5
     AND 1 - levenshtein(p_name, option) / greatest(length(p_name), length(option))::DOUBLE
         >= 1 - levenshtein(p_name, 'none') / greatest(length(p_name), 4)::DOUBLE THEN option
    ELSE 'none' END AS response,
  round((length(p_name) % 97) / 97.0::DOUBLE, 6) AS trustworthiness_score
FROM o
""")
def per_row_constraints(spark, sf):
    named = table(spark, sf, "part")
    options = F.when(F.contains("p_name", F.lit("bolt")), F.array(F.lit("Bolt"), F.lit("none"))).otherwise(
        F.array(F.lit("RING"), F.lit("none"))
    )
    scored = scoring.score_prompts(
        named.select("p_partkey", "p_name", options.alias("options")), "p_name", echo, options="options"
    )
    out = scoring.unpack_result(scored.drop("p_name", "options"), "scored")
    return out.withColumn("trustworthiness_score", rounded("trustworthiness_score"))


@query(f"""
WITH {PAIRS} SELECT conv_id, turn, [round(length(response)::DOUBLE / (length(prompt) + length(response)), 6),
  round(1.0::DOUBLE / (1 + length(response)), 6)] AS features FROM pairs
""")
def score_features(spark, sf):
    scored = scoring.score_pairs(_pairs(spark, sf), "prompt", "response", pair_scorer)
    out = scoring.score_features(scored, "scored", criteria=1)
    return out.select("conv_id", "turn", rounded_array("features").alias("features"))


# The words of a turn and the same backwards as two parallel lists, paired by position.
@query("""
SELECT row, unnest(range(len(w))) AS position, unnest(w) AS prompt, unnest(list_reverse(w)) AS response
FROM (SELECT conv_id * 1000 + turn AS row, string_split(text, ' ') AS w FROM conversations WHERE text IS NOT NULL)
""")
def pair_lists(spark, sf):
    words = F.split("text", " ")
    rows = table(spark, sf, "conversations").where("text IS NOT NULL")
    lists = rows.select((F.col("conv_id") * 1000 + F.col("turn")).alias("row"), words.alias("prompts"), F.reverse(words).alias("responses"))
    paired = scoring.pair_lists(lists, "prompts", "responses", "row")
    return paired.withColumn("position", F.col("position").cast("bigint"))


def _flaky() -> object:
    """Fails for prompts with "bolt" for good, and for those with "nut" until a row has been tried twice alone."""
    seen: dict[str, int] = {}

    def scorer(batch: pd.DataFrame) -> pd.DataFrame:
        if batch["prompt"].str.contains("bolt").any():
            raise RuntimeError("no bolts")
        if batch["prompt"].str.contains("nut").any():
            key = batch["prompt"].iloc[0]
            if len(batch) == 1:
                seen[key] = seen.get(key, 0) + 1
            if len(batch) > 1 or seen[key] <= 2:
                raise RuntimeError("not yet")
            del seen[key]
        return echo(batch)

    return scorer


@query("""
SELECT p_partkey, CASE WHEN contains(p_name, 'bolt') THEN 'no bolts' END AS error, CASE WHEN contains(p_name, 'bolt') THEN true END AS retryable,
  (CASE WHEN contains(p_name, 'bolt') THEN 4 WHEN contains(p_name, 'nut') THEN 3 ELSE 1 END)::INTEGER AS attempts
FROM part
""")
def retry_policy(spark, sf):
    scored = scoring.score_prompts(
        spread(table(spark, sf, "part").select("p_partkey", "p_name")), "p_name", _flaky(), "capture", policy=NO_WAIT,
        attempts_col="attempts",
    )
    error = F.col("scored.log.error")
    return scored.select(
        "p_partkey", error["message"].alias("error"), error["retryable"].alias("retryable"), "attempts"
    )


def _stalls(batch: pd.DataFrame) -> pd.DataFrame:
    """Hangs on one prompt."""
    if batch["prompt"].str.startswith("7 ").any():
        time.sleep(30)
    return echo(batch)


@query("""
SELECT p_partkey, CASE WHEN p_partkey = 7 THEN 'the scorer took longer than 0.5 seconds' END AS error,
  CASE WHEN p_partkey = 7 THEN true END AS retryable,
  CASE WHEN p_partkey <> 7 THEN round((length(p_partkey || ' ' || p_name) % 97) / 97.0::DOUBLE, 6) END AS trustworthiness_score
FROM part
""")
def score_prompts_timeout(spark, sf):
    prompts = table(spark, sf, "part").select("p_partkey", F.concat_ws(" ", "p_partkey", "p_name").alias("prompt"))
    policy = scoring.RetryPolicy(retries=0, timeout=0.5, sleep=lambda seconds: None)
    scored = scoring.score_prompts(prompts, "prompt", _stalls, "capture", policy=policy)
    error = F.col("scored.log.error")
    return scored.select(
        "p_partkey", error["message"].alias("error"), error["retryable"].alias("retryable"),
        rounded("scored.trustworthiness_score").alias("trustworthiness_score"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'the prompt is missing'
    WHEN p_partkey % 3 = 1 THEN 'Prompt length exceeds maximum length of 70000 tokens' END AS error,
  CASE WHEN p_partkey % 3 < 2 THEN false END AS retryable
FROM part
""")
def input_validation(spark, sf):
    """Rows that never reach the scorer: no prompt, or one that is too long."""
    kind = F.col("p_partkey") % 3
    text = F.when(kind == 1, F.repeat(F.lit("x"), 280_001)).when(kind == 2, F.col("p_name"))
    rows = spread(table(spark, sf, "part").select("p_partkey", "p_name")).select("p_partkey", text.alias("prompt"))
    scored = scoring.score_prompts(rows, "prompt", echo, "capture", policy=NO_WAIT)
    error = F.col("scored.log.error")
    return scored.select("p_partkey", error["message"].alias("error"), error["retryable"].alias("retryable"))


@query("SELECT event_id, round((value - lo) / (hi - lo), 6) AS value FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events)")
def normalize_ratings(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return calibrate.normalize_ratings(events, "value").withColumn("value", rounded("value"))


def _isotonic(n: int) -> str:
    """The weighted isotonic fit of points p{n}: the greatest lower bound of means over all runs."""
    return f"""
p{n} AS (SELECT x{n} AS x, avg(r) AS y, count(*) AS w, row_number() OVER (ORDER BY x{n}) AS i FROM rated GROUP BY x{n}),
c{n} AS (SELECT *, sum(y * w) OVER (ORDER BY i) AS sy, sum(w) OVER (ORDER BY i) AS sw FROM p{n}),
m{n} AS (SELECT j.i AS j, k.i AS k, (k.sy - j.sy + j.y * j.w) / (k.sw - j.sw + j.w) AS a FROM c{n} j JOIN c{n} k ON k.i >= j.i),
f{n} AS (SELECT x, max(low) AS y FROM (SELECT p.i, p.x, j, min(a) AS low FROM p{n} p JOIN m{n} ON j <= p.i AND k >= p.i GROUP BY ALL) GROUP BY x)
"""


@query(f"""
WITH rated AS (
  SELECT doc_id, quality::DOUBLE AS r, round((n_chars % 97) / 97.0::DOUBLE * 10000) / 10000 AS x1,
         round(1.0::DOUBLE / (1 + n_chars) * 10000) / 10000 AS x2
  FROM documents JOIN labels USING (doc_id)),
{_isotonic(1)}, {_isotonic(2)}
SELECT doc_id, round((f1.y + f2.y) / 2, 6) AS calibrated_score FROM rated JOIN f1 ON f1.x = x1 JOIN f2 ON f2.x = x2
""")
def calibrate_scores(spark, sf):
    rated = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    features = F.array((F.col("n_chars") % 97) / F.lit(97.0), 1 / (1 + F.col("n_chars")))
    rows = rated.select("doc_id", features.alias("features"), F.col("quality").cast("double").alias("rating"))
    model = calibrate.Calibration(2).fit(rows, "rating")
    return model.transform(rows).select("doc_id", rounded("calibrated_score").alias("calibrated_score"))


@query()
def calibrate_jointly(spark, sf):
    """Both scores of a document together; trees are not for SQL, a test compares them with plain Python."""
    rated = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    features = F.array((F.col("n_chars") % 97) / F.lit(97.0), 1 / (1 + F.col("n_chars")))
    rows = rated.select("doc_id", features.alias("features"), F.col("quality").cast("double").alias("rating"))
    model = calibrate.JointCalibration(2).fit(rows, "rating")
    return model.transform(rows).select("doc_id", rounded("calibrated_score").alias("calibrated_score"))


@query(f"""
WITH {PAIRS}, rated AS (
  SELECT conv_id, turn, (length(response) % 10) / 9.0::DOUBLE AS r,
         round(length(response)::DOUBLE / (length(prompt) + length(response)) * 10000) / 10000 AS x1,
         round(1.0::DOUBLE / (1 + length(response)) * 10000) / 10000 AS x2 FROM pairs),
{_isotonic(1)}, {_isotonic(2)}
SELECT conv_id, turn, round((f1.y + f2.y) / 2, 6) AS calibrated_score FROM rated JOIN f1 ON f1.x = x1 JOIN f2 ON f2.x = x2
""")
def score_pairs_calibrated(spark, sf):
    """Pairs scored, a calibration fitted to ratings of the same pairs, and its score in every result."""
    scored = scoring.score_pairs(_pairs(spark, sf), "prompt", "response", pair_scorer)
    scored = durable(scored.withColumn("rating", (F.length("response") % 10).cast("double")))
    model = calibrate.Calibration(2).fit(scoring.score_features(scored, "scored", criteria=1), "rating")
    out = calibrate.with_calibrated_score(scored, "scored", model)
    return out.select("conv_id", "turn", rounded("scored.calibrated_score").alias("calibrated_score"))


@query(f"""
WITH {SQUARES} SELECT vec_id, classes[list_position(probs, list_max(probs))] AS predicted_label FROM squares
""")
def predicted_label(spark, sf):
    probs = square_probs(spark, sf)
    return probs.select("vec_id", probabilities.predicted_label("probs", SQUARE_CLASSES).alias("predicted_label"))


@query(f"""
WITH {SQUARES} SELECT vec_id, list_transform(list_filter(range(1, 65), lambda i: probs[i] >= 0.03), lambda i: classes[i]) AS labels FROM squares
""")
def predicted_label_set(spark, sf):
    probs = square_probs(spark, sf)
    return probs.select("vec_id", probabilities.predicted_label_set("probs", SQUARE_CLASSES, 0.03).alias("labels"))


@query(f"""
WITH {SQUARES}, ranked AS (
  SELECT vec_id, unnest(classes) AS c, unnest(probs) AS p, unnest(range(64)) AS i FROM squares),
top AS (SELECT vec_id, c, p, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i) AS r FROM ranked QUALIFY r <= 3)
SELECT vec_id, list(c ORDER BY r) AS top_labels, list(round(p, 6) ORDER BY r) AS top_probs FROM top GROUP BY vec_id
""")
def top_labels(spark, sf):
    return square_probs(spark, sf).select(
        "vec_id",
        probabilities.top_labels("probs", SQUARE_CLASSES, 3).alias("top_labels"),
        rounded_array(probabilities.top_probs("probs", SQUARE_CLASSES, 3)).alias("top_probs"),
    )


# Gaussian naive Bayes: its fit is a mean and a variance for each class and dimension.
@query(f"""
WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS i FROM embeddings),
stats AS (SELECT label, i, avg(v) AS m, avg(v * v) - avg(v) * avg(v) AS s FROM x GROUP BY ALL),
priors AS (SELECT label, ln(count(*)) AS p FROM embeddings GROUP BY label),
scores AS (
  SELECT vec_id, stats.label AS c, any_value(p) - sum(0.5 * ln(2 * pi() * s) + (v - m) * (v - m) / (2 * s)) AS l
  FROM x JOIN stats USING (i) JOIN priors ON priors.label = stats.label GROUP BY ALL),
probs AS (SELECT vec_id, c, exp(l - max(l) OVER (PARTITION BY vec_id)) AS e FROM scores),
shares AS (SELECT vec_id, c, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM probs)
SELECT vec_id, arg_max(c, p) AS predicted_label, {", ".join(f"round(max(p) FILTER (c = {i}), 4) AS p_{i}" for i in range(10))}
FROM shares GROUP BY vec_id
""")
def predict_batch(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))
    model = NaiveBayes(modelType="gaussian").fit(vectors)
    out = predict.predict_batch(vectors, model, list(range(10)), id_col="vec_id")
    return out.select("vec_id", "predicted_label", *[rounded(F.col(str(i)), 4).alias(f"p_{i}") for i in range(10)])


def _length_model(texts: pd.Series) -> pd.Series:
    share = texts.str.len() % 101 / 101.0
    return pd.Series([[s, 1.0 - s] for s in share])


@query("""
WITH s AS (SELECT doc_id, (length(text) % 101) / 101.0::DOUBLE AS p FROM documents)
SELECT doc_id, CASE WHEN p >= 1.0 - p THEN 'long' ELSE 'short' END AS predicted_label, round(p, 6) AS long, round(1.0 - p, 6) AS short FROM s
""")
def predict_batch_text(spark, sf):
    docs = table(spark, sf, "documents")
    out = predict.predict_batch(docs, _length_model, ["long", "short"], input_col="text", id_col="doc_id")
    return out.withColumn("long", rounded("long")).withColumn("short", rounded("short"))


# --- trust from samples: an assistant turn is a candidate, the turns next to it are its samples ---

CANDIDATES = r"""
words AS (
  SELECT conv_id, turn, role, text,
         list_distinct(list_filter(string_split(trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g')), ' '), lambda w: w <> '')) AS w
  FROM conversations),
overlap AS (
  SELECT c.conv_id AS prompt_id, c.turn AS candidate_id,
         avg(len(list_intersect(c.w, s.w))::DOUBLE / (len(c.w) + len(s.w) - len(list_intersect(c.w, s.w)))) AS consistency
  FROM words c JOIN words s ON s.conv_id = c.conv_id AND s.role <> 'assistant' AND abs(s.turn - c.turn) = 1
  WHERE c.role = 'assistant' GROUP BY ALL),
scored AS (
  SELECT c.conv_id AS prompt_id, c.turn AS candidate_id, o.consistency,
         coalesce(0.7 * o.consistency + 0.3 * ((length(c.text) % 11) / 11.0::DOUBLE), o.consistency, (length(c.text) % 11) / 11.0::DOUBLE) AS trust
  FROM words c LEFT JOIN overlap o ON o.prompt_id = c.conv_id AND o.candidate_id = c.turn WHERE c.role = 'assistant')
"""


def _consistency(spark, sf):
    turns = table(spark, sf, "conversations")
    candidates = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("prompt_id"), F.col("turn").alias("candidate_id"), "text"
    )
    others = turns.where("role <> 'assistant'")
    sides = F.explode(F.array(F.col("turn") - 1, F.col("turn") + 1))
    samples = others.select(F.col("conv_id").alias("prompt_id"), sides.alias("candidate_id"), "text")
    return trust.consistency_score(candidates, samples)


def _trusted(spark, sf):
    reflected = _consistency(spark, sf).withColumn("reflection", (F.char_length("text") % 11) / F.lit(11.0))
    out = trust.trust_score(reflected, reflection="reflection")
    return out.select("prompt_id", "candidate_id", rounded("consistency").alias("consistency"), rounded("trust").alias("trust"))


@query(f"WITH {CANDIDATES} SELECT prompt_id, candidate_id, round(consistency, 6) AS consistency FROM scored")
def consistency(spark, sf):
    return _consistency(spark, sf).select("prompt_id", "candidate_id", rounded("consistency").alias("consistency"))


@query(f"WITH {CANDIDATES} SELECT prompt_id, candidate_id, round(consistency, 6) AS consistency, round(trust, 6) AS trust FROM scored")
def trust_score(spark, sf):
    return _trusted(spark, sf)


@query(f"""
WITH {CANDIDATES} SELECT prompt_id, candidate_id, round(consistency, 6) AS consistency, round(trust, 6) AS trust FROM scored
QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY round(trust, 6) DESC, candidate_id) = 1
""")
def best_candidate(spark, sf):
    return trust.best_candidate(_trusted(spark, sf))


@query(f"""
WITH {CANDIDATES} SELECT prompt_id, candidate_id, round(consistency, 6) AS consistency, round(trust, 6) AS trust FROM scored
ORDER BY round(trust, 6), prompt_id, candidate_id LIMIT 20
""")
def low_trust(spark, sf):
    return trust.low_trust_rows(_trusted(spark, sf), ["prompt_id", "candidate_id"], n=20)


@query(f"WITH {CANDIDATES} SELECT prompt_id, candidate_id, round(consistency, 6) AS consistency, round(trust, 6) AS trust FROM scored WHERE round(trust, 6) < 0.2")
def low_trust_threshold(spark, sf):
    return trust.low_trust_rows(_trusted(spark, sf), ["prompt_id", "candidate_id"], threshold=0.2)
