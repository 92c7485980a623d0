"""Corrections, field updates, probability joins and synthetic-data scores."""

from pyspark.sql import functions as F

from winnowmill.operators import corrections, near_duplicates, rows, synthetic

from .registry import CLEANSET, DECISIONS, SQUARES, cleanset, dataset, decisions, query, rounded, rounded_array, square_probs, table


@query(f"""
WITH {DECISIONS}
SELECT doc_id, d.text, d.source, d.n_chars, coalesce(corrected_label, d.lang) AS label
FROM decisions LEFT JOIN documents d USING (doc_id)
WHERE action IS NULL OR action <> 'exclude'
""")
def apply_corrections_audit(spark, sf):
    return corrections.apply_corrections(dataset(spark, sf), decisions(spark, sf), "doc_id", "label")


@query(f"""
WITH {DECISIONS}
SELECT doc_id, d.text, d.source, d.n_chars, coalesce(corrected_label, d.lang) AS label
FROM decisions LEFT JOIN documents d USING (doc_id)
""")
def apply_corrections_audit_keep_excluded(spark, sf):
    return corrections.apply_corrections(
        dataset(spark, sf), decisions(spark, sf), "doc_id", "label", keep_excluded=True
    )


@query(f"""
WITH {DECISIONS}
SELECT d.doc_id, d.text, coalesce(corrected_label, d.lang) AS label, d.source, d.n_chars
FROM documents d LEFT JOIN decisions USING (doc_id)
WHERE action IS NULL OR action <> 'exclude'
""")
def apply_corrections_dataset(spark, sf):
    return corrections.apply_corrections(
        dataset(spark, sf), decisions(spark, sf), "doc_id", "label", how="dataset"
    )


@query(f"""
WITH {DECISIONS}
SELECT d.doc_id, d.text, coalesce(corrected_label, d.lang) AS label, d.source, d.n_chars, action
FROM documents d LEFT JOIN decisions USING (doc_id)
""")
def apply_corrections_keep_excluded(spark, sf):
    return corrections.apply_corrections(
        dataset(spark, sf), decisions(spark, sf), "doc_id", "label", keep_excluded=True, how="dataset"
    )


@query(f"""
WITH {DECISIONS}, numbered AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_number, text, lang, source FROM documents)
SELECT n.text, coalesce(corrected_label, n.lang) AS label, n.source
FROM numbered n LEFT JOIN decisions d ON d.doc_id = n.row_number
WHERE action IS NULL OR action <> 'exclude'
""")
def apply_corrections_by_position(spark, sf):
    rows = dataset(spark, sf).select(F.col("doc_id").alias("order_key"), "text", "label", "source")
    audit = decisions(spark, sf).withColumnRenamed("doc_id", "row_number")
    out = corrections.apply_corrections(rows, audit, "row_number", "label", how="dataset", order_by="order_key")
    return out.drop("order_key")


@query("""
SELECT d.doc_id, d.text, d.lang,
       CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'kept' END ELSE d.source END AS source,
       d.n_chars, CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.toxic = 0 THEN 'clean' END AS verdict
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def combine_fields(spark, sf):
    updates = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("quality") == 1, "kept").alias("source"),
        F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean").alias("verdict"),
    )
    return corrections.combine_fields(table(spark, sf, "documents"), updates, "doc_id")


@query(f"""
WITH {SQUARES}
SELECT e.vec_id, e.label, list_transform(s.probs, lambda p: round(p, 6)) AS probs
FROM embeddings e JOIN squares s USING (vec_id)
""")
def join_probabilities(spark, sf):
    probs = square_probs(spark, sf).select("vec_id", "probs")
    out = corrections.join_probabilities(table(spark, sf, "embeddings").select("vec_id", "label"), probs, "vec_id")
    return out.withColumn("probs", rounded_array("probs"))


@query("""
SELECT vec_id, label FROM embeddings WHERE NOT coalesce(label = 3, false)
""")
def analyzed_only(spark, sf):
    flagged = table(spark, sf, "embeddings").select("vec_id", "label", (F.col("label") == 3).alias("is_not_analyzed"))
    return rows.analyzed_only(flagged).drop("is_not_analyzed")


@query(f"""
WITH {SQUARES} SELECT label, list_transform(probs, lambda p: round(p, 6)) AS probs FROM squares
""")
def drop_id(spark, sf):
    return rows.drop_id(square_probs(spark, sf).withColumn("probs", rounded_array("probs")), "vec_id")


@query(f"""
WITH {CLEANSET}
SELECT count(*) FILTER (WHERE real_or_synthetic = 'real') AS n_real,
       count(*) FILTER (WHERE real_or_synthetic <> 'real') AS n_synthetic FROM cleanset
""")
def synthetic_counts(spark, sf):
    return synthetic.example_counts(cleanset(spark, sf))


@query(f"""
WITH {CLEANSET}
SELECT count(DISTINCT real_or_synthetic) AS n_values, count(DISTINCT real_or_synthetic) = 2 AS has_two_classes
FROM cleanset
""")
def two_class_check(spark, sf):
    return synthetic.two_class_check(cleanset(spark, sf))


@query(f"""
WITH {CLEANSET}, near AS (
  SELECT real_or_synthetic, near_duplicate_cluster_id,
         bool_or(real_or_synthetic <> 'synthetic') OVER (PARTITION BY near_duplicate_cluster_id) AS has_real
  FROM cleanset WHERE is_near_duplicate),
n AS (SELECT count(*) FILTER (WHERE real_or_synthetic = 'synthetic') AS s,
             count(*) FILTER (WHERE real_or_synthetic = 'real') AS r FROM cleanset)
SELECT round(1 - (SELECT avg(label_issue_score) FROM cleanset WHERE real_or_synthetic = 'synthetic'), 6) AS unrealistic,
       round(1 - (SELECT avg(label_issue_score) FROM cleanset WHERE real_or_synthetic = 'real'), 6) AS unrepresentative,
       round((SELECT count(*) FROM near WHERE real_or_synthetic = 'synthetic' AND NOT has_real)::DOUBLE / s, 6) AS unvaried,
       round((SELECT count(*) FROM near WHERE real_or_synthetic = 'synthetic' AND has_real)::DOUBLE / s, 6) AS unoriginal,
       r AS n_real, s AS n_synthetic
FROM n
""")
def synthetic_scores(spark, sf):
    scores = synthetic.score_synthetic_dataset(cleanset(spark, sf))
    names = ["unrealistic", "unrepresentative", "unvaried", "unoriginal"]
    return scores.select(*[rounded(n).alias(n) for n in names], "n_real", "n_synthetic")


def _other(contains: bool) -> str:
    return f"""
WITH {CLEANSET}, near AS (
  SELECT doc_id, real_or_synthetic, near_duplicate_cluster_id,
         bool_or(real_or_synthetic <> 'synthetic') OVER (PARTITION BY near_duplicate_cluster_id) AS has_real
  FROM cleanset WHERE is_near_duplicate)
SELECT doc_id, near_duplicate_cluster_id FROM near
WHERE real_or_synthetic = 'synthetic' AND {'' if contains else 'NOT '}has_real
"""


@query(_other(True))
def cluster_contains_other(spark, sf):
    found = synthetic.cluster_contains_other(cleanset(spark, sf), "doc_id")
    return found.select("doc_id", "near_duplicate_cluster_id")


@query(_other(False))
def cluster_without_other(spark, sf):
    found = synthetic.cluster_contains_other(cleanset(spark, sf), "doc_id", contains=False)
    return found.select("doc_id", "near_duplicate_cluster_id")


@query(f"""
WITH {CLEANSET} SELECT doc_id, is_near_duplicate, near_duplicate_cluster_id FROM cleanset
""")
def near_dup_exact(spark, sf):
    return near_duplicates.exact_duplicates(table(spark, sf, "documents"), "doc_id", "text")


# All pairs of texts that share a shingle, their exact Jaccard similarity, and the closure of the
# pairs at 0.8 or more.
def _clusters(texts: str, id_col: str) -> str:
    """SQL of the clusters of the table ``texts`` (id_col, text)."""
    return rf"""
WITH RECURSIVE texts AS ({texts}),
norm AS (
  SELECT {id_col} AS own, trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS t FROM texts WHERE text IS NOT NULL),
firsts AS (SELECT min(own) AS id, t FROM norm GROUP BY t),
toks AS (SELECT id, string_split(t, ' ') AS w FROM firsts WHERE t <> ''),
shingles AS (
  SELECT DISTINCT id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM toks, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) r),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
pairs AS (
  SELECT a.id AS x, b.id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
edges AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.id = x JOIN sizes q ON q.id = y
  WHERE c::DOUBLE / (p.n + q.n - c) >= 0.8),
sym AS (SELECT x AS u, y AS v FROM edges UNION SELECT y, x FROM edges),
reach AS (SELECT u AS id, u AS r FROM sym UNION SELECT reach.id, sym.v FROM reach JOIN sym ON sym.u = reach.r),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id),
sized AS (SELECT own, min(own) OVER (PARTITION BY t) AS f, count(*) OVER (PARTITION BY t) AS n FROM norm)
SELECT d.{id_col}, coalesce(comp.c, CASE WHEN n > 1 THEN f END) IS NOT NULL AS is_near_duplicate,
       coalesce(comp.c, CASE WHEN n > 1 THEN f END) AS near_duplicate_cluster_id
FROM texts d LEFT JOIN sized ON own = d.{id_col} LEFT JOIN comp ON comp.id = f
"""


@query(_clusters("SELECT doc_id, text FROM documents", "doc_id"))
def near_dup_fuzzy(spark, sf):
    return near_duplicates.near_duplicates(table(spark, sf, "documents"), "doc_id", "text")


# Five windows of 64 words of each text that has as many, each five words on: neighbours have 55 of 65
# shingles in common, windows two apart 50 of 70, unless words repeat.
@query(_clusters("""
SELECT doc_id * 5 + step AS chain_id, array_to_string(w[step * 5 + 1 : step * 5 + 64], ' ') AS text
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents WHERE len(string_split(text, ' ')) >= 84), range(5) t(step)
""", "chain_id"))
def near_dup_chains(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("w")).where(F.size("w") >= 84)
    steps = words.select("doc_id", "w", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("step"))
    window = F.array_join(F.slice("w", F.col("step") * 5 + 1, F.lit(64)), " ")
    chains = steps.select((F.col("doc_id") * 5 + F.col("step")).alias("chain_id"), window.alias("text"))
    return near_duplicates.near_duplicates(chains, "chain_id", "text")
