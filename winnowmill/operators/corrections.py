"""Joining audit decisions, updated fields and probabilities to a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInput
from ..plans.positions import with_row_position
from .rows import filter_excluded


def _with_id(dataset: DataFrame, id_col: str, order_by) -> DataFrame:
    return dataset if id_col in dataset.columns else with_row_position(dataset, id_col, order_by)


def apply_corrections(
    dataset: DataFrame,
    audit: DataFrame,
    id_col: str,
    label: str,
    keep_excluded: bool = False,
    how: str = "audit",
    order_by=None,
) -> DataFrame:
    """Replace labels by their corrections and drop excluded rows.

    ``how="audit"``: one row per audit row, with nulls where the dataset has no such id; columns are
    id, the others, label. ``how="dataset"``: every dataset row without an exclusion, in the dataset's
    own column order; with ``keep_excluded`` the action is kept too. An id column that the dataset
    lacks is its 0-based row position (by ``order_by``, else in file order).
    """
    if label not in dataset.columns:
        raise InvalidInput(f"label column does not exist: {label}")
    decisions = audit.select(
        F.col(id_col), F.col("action").alias("__action"), F.col("corrected_label").alias("__corrected")
    )
    final = F.coalesce("__corrected", label)
    if how == "dataset":
        rows = _with_id(dataset, id_col, order_by)
        kept = filter_excluded(rows.join(decisions, id_col, "left"), keep_excluded, "__action")
        columns = [final.alias(label) if c == label else F.col(c) for c in dataset.columns]
        return kept.select(*columns, *([F.col("__action").alias("action")] if keep_excluded else []))
    if how != "audit":
        raise InvalidInput("how must be 'audit' or 'dataset'")

    # Excluded audit rows are dropped before the join instead of after it. The right join is written
    # as its matched and unmatched parts: unlike an outer join, both are joins that adaptive
    # execution can split on whichever side holds a hot id.
    rows = _with_id(dataset, id_col, order_by)
    decisions = filter_excluded(decisions, keep_excluded, "__action")
    others = [c for c in rows.columns if c not in (id_col, label)]
    matched = rows.join(decisions, id_col).select(id_col, *others, final.alias(label))
    kinds = {f.name: f.dataType for f in matched.schema}
    unmatched = decisions.join(rows.select(id_col).distinct(), id_col, "left_anti").select(
        id_col,
        *[F.lit(None).cast(kinds[c]).alias(c) for c in others],
        F.col("__corrected").cast(kinds[label]).alias(label),
    )
    return matched.unionByName(unmatched)


def combine_fields(dataset: DataFrame, updates: DataFrame, id_col: str) -> DataFrame:
    """Override and add fields from the matching update row; ids are compared as text.

    A matched update overrides even with a null. Unmatched rows keep their fields.
    """
    fields = [c for c in updates.columns if c != id_col]
    packed = updates.select(
        F.col(id_col).cast("string").alias("__update_id"),
        F.lit(True).alias("__matched"),
        *[F.col(c).alias(f"__new_{c}") for c in fields],
    )
    joined = dataset.join(packed, F.col(id_col).cast("string") == F.col("__update_id"), "left")
    old = [
        F.when(F.col("__matched"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
        for c in dataset.columns
    ]
    new = [F.col(f"__new_{c}").alias(c) for c in fields if c not in dataset.columns]
    return joined.select(*old, *new)


def join_probabilities(dataset: DataFrame, probs: DataFrame, id_col: str, how: str = "inner") -> DataFrame:
    """Probabilities or other vectors by id; rows that were not analyzed have none."""
    if how not in ("inner", "left"):
        raise InvalidInput("how must be 'inner' or 'left'")
    return dataset.join(probs, id_col, how)
