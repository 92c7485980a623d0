"""Audit columns of the embeddings table, with class shares among neighbours as probabilities."""

from pyspark.sql import functions as F

from winnowmill.operators import audit, neighbors
from winnowmill.plans.lineage import durable

from .registry import query, rounded, rounded_array, table

K = 10
CLASSES = list(range(10))

NEIGHBORS = f"""
e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
nb AS (
  SELECT a.vec_id, b.vec_id AS neighbor_id, b.label AS neighbor_label, round(list_cosine_similarity(a.v, b.v), 9) AS similarity,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.v, b.v), 9) DESC, b.vec_id) AS rank
  FROM e a JOIN e b ON a.vec_id <> b.vec_id QUALIFY rank <= {K})
"""
PROBS = f"""
{NEIGHBORS},
votes AS (SELECT vec_id, neighbor_label AS c, count(*) AS n FROM nb GROUP BY ALL),
probs AS (
  SELECT g.vec_id, g.label, g.c, coalesce(n, 0) / {K}.0::DOUBLE AS p
  FROM (SELECT vec_id, label, unnest(range(10))::INTEGER AS c FROM e) g LEFT JOIN votes v ON v.vec_id = g.vec_id AND v.c = g.c),
limits AS (SELECT label AS c, round(avg(p), 9) AS t FROM probs WHERE c = label GROUP BY label),
confident AS (
  SELECT vec_id, arg_max(c, p * 1000 - c) AS confident_label FROM probs JOIN limits USING (c) WHERE round(p, 9) >= t GROUP BY vec_id),
best AS (SELECT vec_id, arg_max(c, p * 1000 - c) AS predicted_label, max(p) AS top,
         -sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END) / ln(10) AS entropy FROM probs GROUP BY vec_id),
own AS (SELECT vec_id, label, p FROM probs WHERE c = label),
audited AS (
  SELECT own.vec_id, own.label, own.p, best.predicted_label, best.top, best.entropy, confident_label, t,
         coalesce(confident_label <> own.label, false) AS is_label_issue
  FROM own JOIN best USING (vec_id) LEFT JOIN confident USING (vec_id) JOIN limits ON limits.c = own.label)
"""


def _neighbors(spark, sf):
    """The neighbour table, found once: what follows reads it several times."""
    return durable(neighbors.nearest_neighbors(table(spark, sf, "embeddings"), "vec_id", "embedding", K, "label"))


def _probs(spark, sf):
    given = table(spark, sf, "embeddings").select("vec_id", "label")
    return given.join(neighbors.knn_pred_probs(_neighbors(spark, sf), "vec_id", CLASSES), "vec_id")


def _audited(spark, sf):
    return audit.label_audit(_probs(spark, sf), "pred_probs", "label", CLASSES)


@query(f"WITH {NEIGHBORS} SELECT vec_id, neighbor_id, round(similarity, 6) AS similarity, rank::INTEGER AS rank, neighbor_label FROM nb")
def nearest_neighbors(spark, sf):
    return _neighbors(spark, sf).withColumn("similarity", rounded("similarity"))


@query(f"WITH {PROBS} SELECT vec_id, list(round(p, 6) ORDER BY c) AS pred_probs FROM probs GROUP BY vec_id")
def knn_pred_probs(spark, sf):
    return _probs(spark, sf).select("vec_id", rounded_array("pred_probs").alias("pred_probs"))


@query(f"""
WITH {PROBS} SELECT vec_id, label, round(p, 6) AS p_given_label, round(p, 6) AS label_quality, round(1 - p, 6) AS label_issue_score FROM own
""")
def label_quality(spark, sf):
    out = audit.label_quality(_probs(spark, sf), "pred_probs", "label", CLASSES)
    names = ["p_given_label", "label_quality", "label_issue_score"]
    return out.select("vec_id", "label", *[rounded(n).alias(n) for n in names])


@query(f"WITH {PROBS} SELECT c AS label, round(t, 6) AS threshold FROM limits")
def class_thresholds(spark, sf):
    out = audit.class_thresholds(_probs(spark, sf), "pred_probs", "label", CLASSES)
    return out.withColumn("threshold", rounded("threshold"))


@query(f"WITH {PROBS} SELECT vec_id, label, confident_label, is_label_issue FROM audited")
def label_issues(spark, sf):
    out = audit.confident_classes(_probs(spark, sf), "pred_probs", "label", CLASSES)
    return out.select("vec_id", "label", "confident_label", "is_label_issue")


@query(f"WITH {PROBS} SELECT label AS given_label, confident_label, count(*) AS n FROM audited WHERE confident_label IS NOT NULL GROUP BY ALL")
def confident_joint(spark, sf):
    return audit.confident_joint(_probs(spark, sf), "pred_probs", "label", CLASSES)


@query(f"""
WITH {PROBS} SELECT vec_id, predicted_label, CASE WHEN is_label_issue THEN predicted_label END AS suggested_label,
  CASE WHEN is_label_issue THEN round(top, 6) END AS p_suggested_label FROM audited
""")
def suggested_labels(spark, sf):
    return _audited(spark, sf).select(
        "vec_id", "predicted_label", "suggested_label", rounded("p_suggested_label").alias("p_suggested_label")
    )


@query(f"WITH {PROBS} SELECT vec_id, round(entropy, 6) AS ambiguous_score, entropy >= 0.8 AS is_ambiguous FROM audited")
def ambiguous(spark, sf):
    out = audit.label_audit(_probs(spark, sf), "pred_probs", "label", CLASSES, ambiguous_above=0.8)
    return out.select("vec_id", rounded("ambiguous_score").alias("ambiguous_score"), "is_ambiguous")


@query(f"""
WITH {NEIGHBORS}, s AS (SELECT vec_id, avg(1 - similarity) AS outlier_score FROM nb GROUP BY vec_id)
SELECT vec_id, round(outlier_score, 6) AS outlier_score, outlier_score > (SELECT quantile_disc(outlier_score, 0.95) FROM s) AS is_outlier FROM s
""")
def outliers(spark, sf):
    scores = neighbors.outlier_scores(_neighbors(spark, sf), "vec_id")
    return scores.withColumn("outlier_score", rounded("outlier_score"))


@query(f"WITH {PROBS} SELECT vec_id, NOT is_label_issue AND round(p, 9) >= t AS is_well_labeled FROM audited")
def well_labeled(spark, sf):
    return _audited(spark, sf).select("vec_id", "is_well_labeled")


@query("SELECT doc_id, lang IS NULL OR lang IN ('None', 'none', 'null', 'NULL') AS is_unlabeled, text IS NULL OR text IN ('None', 'none', 'null', 'NULL') AS is_not_analyzed FROM documents")
def not_analyzed(spark, sf):
    from winnowmill.functions.typing import is_missing

    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", is_missing(docs, "lang").alias("is_unlabeled"), audit.not_analyzed(docs, "text").alias("is_not_analyzed")
    )


AUDIT_SQL = f"""
{PROBS}, s AS (SELECT vec_id, avg(1 - similarity) AS outlier_score FROM nb GROUP BY vec_id),
flagged AS (
  SELECT a.*, outlier_score, outlier_score > (SELECT quantile_disc(outlier_score, 0.95) FROM s) AS is_outlier
  FROM audited a JOIN s USING (vec_id))
"""


def _full(spark, sf):
    return audit.audit(
        table(spark, sf, "embeddings"), "vec_id", "label", "embedding", classes=CLASSES, k=K, fix_above=0.3
    )


@query(f"""
WITH {AUDIT_SQL}
SELECT vec_id, CASE WHEN is_outlier THEN 'exclude' WHEN is_label_issue AND top >= 0.3 THEN 'correct' END AS action,
  CASE WHEN is_label_issue AND top >= 0.3 THEN predicted_label END AS corrected_label,
  CASE WHEN is_label_issue AND top >= 0.3 THEN predicted_label ELSE label END AS clean_label
FROM flagged
""")
def auto_fix(spark, sf):
    return _full(spark, sf).select("vec_id", "action", "corrected_label", "clean_label")


@query(f"""
WITH {AUDIT_SQL}
SELECT vec_id, label, false AS is_not_analyzed, round(p, 6) AS label_quality, is_label_issue,
  predicted_label, round(outlier_score, 6) AS outlier_score, is_outlier, round(entropy, 6) AS ambiguous_score,
  NOT is_label_issue AND round(p, 9) >= t AS is_well_labeled, false AS is_near_duplicate
FROM flagged
""", name="audit")
def full_audit(spark, sf):
    return _full(spark, sf).select(
        "vec_id",
        "label",
        "is_not_analyzed",
        rounded("label_quality").alias("label_quality"),
        "is_label_issue",
        "predicted_label",
        rounded("outlier_score").alias("outlier_score"),
        "is_outlier",
        rounded("ambiguous_score").alias("ambiguous_score"),
        "is_well_labeled",
        "is_near_duplicate",
    )


# As above with every three vectors a class of their own, so that there are a third as many classes as rows.
MANY = f"""
{NEIGHBORS.replace("label, list_transform", "vec_id // 3 AS label, list_transform")},
votes AS (SELECT vec_id, neighbor_label AS c, count(*) AS n FROM nb GROUP BY ALL),
classes AS (SELECT DISTINCT label AS c FROM e),
probs AS (
  SELECT g.vec_id, g.label, g.c, coalesce(n, 0) / {K}.0::DOUBLE AS p
  FROM (SELECT vec_id, label, c FROM e, classes) g LEFT JOIN votes v ON v.vec_id = g.vec_id AND v.c = g.c),
limits AS (SELECT label AS c, round(avg(p), 9) AS t FROM probs WHERE c = label GROUP BY label),
confident AS (
  SELECT vec_id, arg_max(c, p * 1000000 - c) AS confident_label FROM probs JOIN limits USING (c) WHERE round(p, 9) >= t GROUP BY vec_id),
best AS (SELECT vec_id, list(c ORDER BY p DESC, c)[1:3] AS top_labels, list(round(p, 6) ORDER BY p DESC, c)[1:3] AS top_probs,
         -sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END) / ln((SELECT count(*) FROM classes)) AS entropy FROM probs GROUP BY vec_id)
"""


@query(f"""
WITH {MANY}
SELECT own.vec_id, own.label, round(own.p, 6) AS label_quality, confident_label <> own.label AS is_label_issue,
       top_labels, top_probs, round(entropy, 6) AS ambiguous_score, confident_label = own.label AND round(own.p, 9) >= t AS is_well_labeled
FROM (SELECT vec_id, label, p FROM probs WHERE c = label) own
JOIN best USING (vec_id) JOIN confident USING (vec_id) JOIN limits ON limits.c = own.label
""")
def audit_many_classes(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("label", F.floor(F.col("vec_id") / 3))
    out = audit.audit(rows, "vec_id", "label", "embedding", k=K)
    return out.select(
        "vec_id",
        "label",
        rounded("label_quality").alias("label_quality"),
        "is_label_issue",
        "top_labels",
        rounded_array("top_probs").alias("top_probs"),
        rounded("ambiguous_score").alias("ambiguous_score"),
        "is_well_labeled",
    )
