"""Audit columns of a labeled dataset, from class probabilities, embeddings and texts.

Label issues follow confident learning (JAIR, volume 70, 2021); outliers the mean distance to the
nearest neighbours. All row-level work is expressions over one array per row. Full probability arrays of
a model come with a class list, and per-class figures enter as scalar subqueries of its size. Shares of
the classes seen among neighbours know no list: per-class figures are a table, joined where they are needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.probabilities import (
    class_array,
    normalized_entropy,
    p_of_label,
    predicted_label,
    ranked_classes,
)
from ..functions.shares import ranked_shares, share_of_label, shares_entropy
from ..functions.typing import is_missing
from ..plans.lineage import durable
from ..plans.skew import attach_group_values
from .near_duplicates import exact_duplicates, near_duplicates
from .neighbors import knn_class_shares, label_classes, nearest_neighbors, outlier_scores

AMBIGUOUS_ABOVE = 0.9
OUTLIER_QUANTILE = 0.95
FIX_ABOVE = 0.5
# Class means are compared with row values after rounding, which hides the order of summation.
DIGITS = 9


def not_analyzed(df: DataFrame, feature: str) -> Column:
    """True where the feature is missing or, for a vector, empty or holding a missing number."""
    kind = dict(df.dtypes)[feature]
    if kind.startswith("array<float") or kind.startswith("array<double"):
        broken = F.exists(F.col(feature), lambda v: v.isNull() | F.isnan(v))
        return F.col(feature).isNull() | (F.size(feature) == 0) | F.coalesce(broken, F.lit(False))
    return is_missing(df, feature)


def label_quality(df: DataFrame, probs: str, label: str, classes: Sequence) -> DataFrame:
    """Adds the probability of the given label as its quality, and the issue score 1 - quality."""
    quality = p_of_label(probs, classes, label)
    return (
        df.withColumn("p_given_label", quality)
        .withColumn("label_quality", F.col("p_given_label"))
        .withColumn("label_issue_score", 1 - F.col("p_given_label"))
    )


def class_thresholds(df: DataFrame, probs: str, label: str, classes: Sequence) -> DataFrame:
    """``(label, threshold)``: mean probability of a class over the rows that carry it."""
    p = p_of_label(probs, classes, label)
    return (
        df.select(F.col(label).alias("label"), p.alias("p"))
        .where(F.col("p").isNotNull())
        .groupBy("label")
        .agg(F.round(F.avg("p"), DIGITS).alias("threshold"))
    )


def _limits(df: DataFrame, probs: str, label: str, classes: Sequence) -> Column:
    """Thresholds in class order as one array, null for a class that no row carries."""
    pairs = class_thresholds(df, probs, label, classes).select(F.struct("label", "threshold").alias("e"))
    found = pairs.agg(F.map_from_entries(F.collect_list("e")).alias("m"))
    return found.select(F.transform(class_array(classes), lambda c: F.try_element_at("m", c))).scalar()


def _confident_class(probs: str, classes: Sequence) -> Column:
    """Most probable class among those at or above their threshold, the first among equals."""
    entries = F.arrays_zip(
        F.col(probs).alias("p"), class_array(classes).alias("c"), F.col("__limits").alias("t")
    )
    kept = F.filter(entries, lambda e: F.round(e["p"], DIGITS) >= e["t"])
    ranked = F.array_sort(kept, lambda x, y: F.when(x["p"] > y["p"], -1).when(x["p"] < y["p"], 1).otherwise(0))
    return F.try_element_at(ranked, F.lit(1))["c"]


def _with_confident_class(df: DataFrame, probs: str, label: str, classes: Sequence) -> DataFrame:
    flagged = df.withColumn("__limits", _limits(df, probs, label, classes)).withColumn(
        "confident_label", _confident_class(probs, classes)
    )
    issue = F.coalesce(F.col("confident_label") != F.col(label), F.lit(False))
    return flagged.withColumn("is_label_issue", issue)


def confident_classes(df: DataFrame, probs: str, label: str, classes: Sequence) -> DataFrame:
    """Adds ``confident_label`` (null if no class reaches its threshold) and ``is_label_issue``."""
    return _with_confident_class(df, probs, label, classes).drop("__limits")


def confident_joint(df: DataFrame, probs: str, label: str, classes: Sequence) -> DataFrame:
    """``(given_label, confident_label, n)``: how often each pair of labels meets."""
    return (
        confident_classes(df, probs, label, classes)
        .where(F.col("confident_label").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(label).alias("given_label"), "confident_label")
        .agg(F.count("*").alias("n"))
    )


def share_thresholds(df: DataFrame, shares: str, label: str) -> DataFrame:
    """``(label, threshold, n)``: mean share of a class over the ``n`` rows that carry it."""
    rows = df.select(F.col(label).alias("label"), share_of_label(shares, label).alias("p")).where(F.col("p").isNotNull())
    return rows.groupBy("label").agg(F.round(F.avg("p"), DIGITS).alias("threshold"), F.count("*").alias("n"))


def confident_by_shares(df: DataFrame, id_col: str, shares: str, limits: DataFrame) -> DataFrame:
    """``(id, confident_label)``: of the classes at or above their threshold the one with the largest share.

    Only rows that have one; the first in class order among equals. Rows of a frequent class are not put
    into one task.
    """
    entries = df.select(F.col(id_col).alias("id"), F.explode(shares).alias("e")).select("id", "e.p", "e.label")
    met = attach_group_values(entries, limits, "label", "n", "id", how="inner")
    kept = met.where(F.round("p", DIGITS) >= F.col("threshold"))
    best = kept.groupBy("id").agg(F.min(F.struct((-F.col("p")).alias("low"), "label"))["label"].alias("confident_label"))
    return best.withColumnRenamed("id", id_col)


def shares_audit(
    df: DataFrame, id_col: str, shares: str, label: str, top: int = 3, ambiguous_above: float = AMBIGUOUS_ABOVE
) -> DataFrame:
    """Like ``label_audit``, from shares of the classes seen, for any number of classes.

    The classes are the labels of ``df``. ``df`` is read several times, so keep it. A class whose rows have no
    share of it has threshold 0; it is the confident one of rows in which no class seen reaches its own.
    """
    limits = durable(share_thresholds(df, shares, label))
    found = limits.agg(F.min(F.when(F.col("threshold") == 0, F.col("label")))).scalar()
    classes = df.where(F.col(label).isNotNull()).select(F.col(label).alias("c")).distinct()
    number = classes.agg(F.count("*")).scalar()
    longest = df.agg(F.max(F.size(shares))).first()[0] or 0
    unseen = classes.orderBy("c").limit(max(longest, 0) + top).agg(F.sort_array(F.collect_list("c"))).scalar()
    own = share_of_label(shares, label)
    best = F.try_element_at("__top", F.lit(1))
    out = df.join(confident_by_shares(df, id_col, shares, limits), id_col, "left")
    out = out.withColumn("confident_label", F.coalesce("confident_label", F.when(F.col(shares).isNotNull(), found)))
    out = attach_group_values(out, limits.withColumnRenamed("label", label), label, "n", id_col)
    # Scalars are columns of their own: a subquery must not stand in a lambda.
    out = out.withColumn("__unseen", unseen).withColumn("__classes", number)
    out = out.withColumns({"p_given_label": own, "label_quality": own, "label_issue_score": 1 - own})
    out = out.withColumn("__top", ranked_shares(shares, F.col("__unseen"), top)).withColumn("predicted_label", best["label"])
    out = out.withColumn("is_label_issue", F.coalesce(F.col("confident_label") != F.col(label), F.lit(False)))
    suggested = F.col("is_label_issue") & F.col("predicted_label").isNotNull()
    entropy = shares_entropy(shares, F.col("__classes"))
    above = F.round(F.col("label_quality"), DIGITS) >= F.col("threshold")
    return out.withColumns(
        {
            "suggested_label": F.when(suggested, F.col("predicted_label")),
            "p_suggested_label": F.when(suggested, best["p"]),
            "top_labels": F.transform("__top", lambda b: b["label"]),
            "top_probs": F.transform("__top", lambda b: b["p"]),
            "ambiguous_score": entropy,
            "is_ambiguous": F.coalesce(entropy >= ambiguous_above, F.lit(False)),
            "is_unlabeled": is_missing(df, label),
            "is_well_labeled": F.coalesce(~F.col("is_label_issue") & above, F.lit(False)),
        }
    ).drop("__top", "__unseen", "__classes", "threshold", "n", "confident_label")


def label_audit(
    df: DataFrame,
    probs: str,
    label: str,
    classes: Sequence,
    top: int = 3,
    ambiguous_above: float = AMBIGUOUS_ABOVE,
) -> DataFrame:
    """Adds every audit column that follows from probabilities and given labels.

    Rows without probabilities get nulls and false flags.
    """
    scored = label_quality(df, probs, label, classes)
    scored = scored.withColumn("predicted_label", predicted_label(probs, classes))
    scored = _with_confident_class(scored, probs, label, classes)
    place = F.array_position(class_array(classes), F.col(label)).cast("int")
    suggested = F.col("is_label_issue") & F.col("predicted_label").isNotNull()
    scored = (
        scored.withColumn("suggested_label", F.when(suggested, F.col("predicted_label")))
        .withColumn("p_suggested_label", F.when(suggested, F.array_max(probs)))
        .withColumn("__top", ranked_classes(probs, classes, top))
        .withColumn("top_labels", F.transform("__top", lambda b: b["label"]))
        .withColumn("top_probs", F.transform("__top", lambda b: b["p"]))
        .withColumn("ambiguous_score", normalized_entropy(probs))
        .withColumn("is_ambiguous", F.coalesce(F.col("ambiguous_score") >= ambiguous_above, F.lit(False)))
        .withColumn("is_unlabeled", is_missing(df, label))
        .withColumn("__mean", F.when(place > 0, F.try_element_at("__limits", place)))
    )
    above = F.round(F.col("label_quality"), DIGITS) >= F.col("__mean")
    return scored.withColumn(
        "is_well_labeled", F.coalesce(~F.col("is_label_issue") & above, F.lit(False))
    ).drop("__top", "__mean", "__limits", "confident_label")


def auto_fix(df: DataFrame, id_col: str, label: str, fix_above: float = FIX_ABOVE) -> DataFrame:
    """Adds ``action``, ``corrected_label`` and ``clean_label``.

    A label issue with a confident suggestion is corrected. Outliers, and near duplicates other than
    the one that names the cluster, are excluded.
    """
    copy = F.col("is_near_duplicate") & (F.col("near_duplicate_cluster_id") != F.col(id_col))
    drop = F.coalesce(copy, F.lit(False)) | F.coalesce(F.col("is_outlier"), F.lit(False))
    fix = F.coalesce(F.col("is_label_issue") & (F.col("p_suggested_label") >= fix_above), F.lit(False))
    return (
        df.withColumn("action", F.when(drop, "exclude").when(fix, "correct"))
        .withColumn("corrected_label", F.when(fix, F.col("suggested_label")))
        .withColumn("clean_label", F.coalesce("corrected_label", label))
    )


def audit(
    df: DataFrame,
    id_col: str,
    label: str,
    vector_col: str | None = None,
    text_col: str | None = None,
    pred_probs: DataFrame | None = None,
    classes: Sequence | None = None,
    k: int = 10,
    top: int = 3,
    fuzzy: bool = False,
    method: str = "exact",
    outlier_quantile: float = OUTLIER_QUANTILE,
    ambiguous_above: float = AMBIGUOUS_ABOVE,
    fix_above: float = FIX_ABOVE,
) -> DataFrame:
    """One row per row of ``df`` with all audit columns that its inputs allow.

    ``pred_probs`` (id, ``pred_probs``) comes from a model, one probability per class of ``classes`` (by default
    the labels, sorted); without it, probabilities are class shares among the ``k`` nearest embeddings, for
    any number of classes. Rows whose feature is missing are flagged and get no
    scores. The neighbour table is computed once and kept in the checkpoint folder.
    """
    feature = vector_col or text_col
    flag = not_analyzed(df, feature) if feature else F.lit(False)
    base = df.select(id_col, F.col(label), flag.alias("is_not_analyzed"))
    out = base
    neighbors = None
    if vector_col:
        known = df.where(~flag)
        neighbors = durable(nearest_neighbors(known, id_col, vector_col, k, label, method))
    if pred_probs is None and neighbors is not None:
        out = out.join(knn_class_shares(neighbors, id_col), id_col, "left")
        out = out.withColumn("class_shares", F.when(~F.col("is_not_analyzed"), F.col("class_shares")))
        out = shares_audit(durable(out), id_col, "class_shares", label, top, ambiguous_above).drop("class_shares")
    if pred_probs is not None:
        classes = list(classes) if classes is not None else label_classes(df, label)
        out = out.join(pred_probs.select(id_col, "pred_probs"), id_col, "left")
        out = out.withColumn("pred_probs", F.when(~F.col("is_not_analyzed"), F.col("pred_probs")))
        # Read three times below: for the class means, the thresholds and the rows themselves.
        out = label_audit(durable(out), "pred_probs", label, classes, top, ambiguous_above).drop("pred_probs")
    if neighbors is not None:
        out = out.join(outlier_scores(neighbors, id_col, outlier_quantile), id_col, "left")
        out = out.withColumn("is_outlier", F.coalesce("is_outlier", F.lit(False)))
    if text_col:
        find = near_duplicates if fuzzy else exact_duplicates
        out = out.join(find(df.where(~not_analyzed(df, text_col)), id_col, text_col), id_col, "left")
        out = out.withColumn("is_near_duplicate", F.coalesce("is_near_duplicate", F.lit(False)))
    else:
        out = out.withColumn("is_near_duplicate", F.lit(False)).withColumn(
            "near_duplicate_cluster_id", F.lit(None).cast(dict(df.dtypes)[id_col])
        )
    for name, kind in (
        ("is_outlier", "boolean"),
        ("is_label_issue", "boolean"),
        ("p_suggested_label", "double"),
        ("suggested_label", dict(df.dtypes)[label]),
    ):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(False if kind == "boolean" else None).cast(kind))
    return auto_fix(out, id_col, label, fix_above)
