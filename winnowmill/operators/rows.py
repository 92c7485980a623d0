"""Choosing rows and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInput
from ..plans.positions import with_row_position

# The column families of an audit table.
CLEAN_COLUMNS = ["clean_label"]
AUDIT_COLUMNS = [
    "suggested_label",
    "label_quality",
    "label_issue_score",
    "is_label_issue",
    "outlier_score",
    "is_outlier",
    "ambiguous_score",
    "is_ambiguous",
    "is_near_duplicate",
    "near_duplicate_cluster_id",
    "is_well_labeled",
]
PROJECT_COLUMNS = [
    "action",
    "corrected_label",
    "previously_resolved",
    "top_labels",
    "top_probs",
    "p_suggested_label",
    "predicted_label",
    "p_given_label",
    "is_unlabeled",
    "is_not_analyzed",
]
# Endings of the columns that an enrichment adds next to its result.
SCORE_ENDING = "_trustworthiness_score"
DETAIL_ENDINGS = ("_raw", "_log")


def select_audit_columns(
    df: DataFrame, id_col: str, include_audit: bool = True, include_project: bool = False
) -> DataFrame:
    """Identifier plus the chosen column families, as far as the table has them."""
    wanted = [
        id_col,
        *CLEAN_COLUMNS,
        *(AUDIT_COLUMNS if include_audit else []),
        *(PROJECT_COLUMNS if include_project else []),
    ]
    return df.select(*[c for c in wanted if c in df.columns])


def drop_id(df: DataFrame, id_col: str, keep_id: bool = False) -> DataFrame:
    return df if keep_id else df.drop(id_col)


def drop_action(df: DataFrame) -> DataFrame:
    return df.drop("action")


def analyzed_only(df: DataFrame, flag: str = "is_not_analyzed") -> DataFrame:
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def filter_excluded(df: DataFrame, keep_excluded: bool = False, action: str = "action") -> DataFrame:
    """Drop rows whose action is exactly ``exclude``; rows without an action stay."""
    return df if keep_excluded else df.where(F.col(action).isNull() | (F.col(action) != "exclude"))


def positional_subset(
    df: DataFrame,
    subset: tuple[int, int] | range | Sequence[int] | None,
    order_by: Sequence[str] | str | None = None,
) -> DataFrame:
    """All rows, a half-open range of positions, or listed positions in the order of the list.

    A pair as a tuple or a ``range`` means a range; a list means positions. Negative numbers count
    from the end.
    """
    if subset is None:
        return df
    listed = list(subset)
    if not listed:
        raise InvalidInput("an empty subset selects nothing; use None for all rows")
    if isinstance(subset, tuple) and len(listed) not in (2, 3):
        raise InvalidInput("a tuple subset is (start, stop) or (start, stop, step)")
    if isinstance(subset, (tuple, range)):
        span = subset if isinstance(subset, range) else range(*listed)
        if span.step > 0 and span.start >= 0 and span.stop >= 0:
            position = F.col("__position")
            chosen = (position >= span.start) & (position < span.stop)
            if span.step > 1:
                chosen = chosen & (F.pmod(position - span.start, F.lit(span.step)) == 0)
            return with_row_position(df, "__position", order_by).where(chosen).drop("__position")
        listed = list(span)
        if not listed:
            return df.limit(0)
    total = df.count() if min(listed) < 0 else 0
    wanted = [(i, p + total if p < 0 else p) for i, p in enumerate(listed)]
    small = df.sparkSession.createDataFrame(wanted, "__place int, __position bigint")
    numbered = with_row_position(df, "__position", order_by)
    return (
        numbered.join(F.broadcast(small), "__position").orderBy("__place").drop("__place", "__position")
    )


def preview_sample(
    df: DataFrame,
    id_col: str,
    indices: Sequence[int] | None = None,
    n: int = 3,
    seed: int = 0,
    order_by: Sequence[str] | str | None = None,
) -> DataFrame:
    """The given positions (10 at most), or ``n`` rows drawn by a seeded hash of the identifier."""
    if indices is not None:
        if len(indices) > 10:
            raise InvalidInput("a preview takes 10 rows at most")
        return positional_subset(df, list(indices), order_by)
    return df.orderBy(F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed)))), id_col).limit(n)


def shift_row_id(df: DataFrame, col: str, by: int = -1, name: str | None = None) -> DataFrame:
    """Move row numbers between counting conventions, by default from 1-based to 0-based."""
    renamed = {col: name} if name else {}
    return df.select(
        *[(F.col(c) + by).alias(renamed.get(c, c)) if c == col else F.col(c) for c in df.columns]
    )


def sort_by_id(df: DataFrame, id_col: str) -> DataFrame:
    return df.orderBy(id_col)


def enriched_columns(columns: Sequence[str]) -> list[str]:
    """Columns that come with their score, raw and log companions."""
    have = set(columns)
    return [c for c in columns if {c + SCORE_ENDING, *(c + e for e in DETAIL_ENDINGS)} <= have]


def drop_detail_columns(df: DataFrame, bases: Sequence[str] | None = None) -> DataFrame:
    """Drop the raw and log companions of enriched columns, by default of all that have all three."""
    names = enriched_columns(df.columns) if bases is None else bases
    return df.drop(*[n + e for n in names for e in DETAIL_ENDINGS])
