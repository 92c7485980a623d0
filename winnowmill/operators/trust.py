"""Trust in responses, from how well sampled responses agree with them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInput

# Candidates, consistency samples and self-reflection of each quality preset, and the
# allowed ranges of the first two.
PRESETS = {
    "best": (6, 8, True),
    "high": (4, 8, True),
    "medium": (1, 8, True),
    "low": (1, 4, True),
    "base": (1, 0, False),
}
CANDIDATE_RANGE = (1, 20)
SAMPLE_RANGE = (0, 20)
CALIBRATED_PRESETS = ("base", "low", "medium")


@dataclass(frozen=True)
class ScoringOptions:
    candidates: int = 1
    samples: int = 8
    self_reflection: bool = True

    def __post_init__(self):
        for name, value, (low, high) in (
            ("candidates", self.candidates, CANDIDATE_RANGE),
            ("samples", self.samples, SAMPLE_RANGE),
        ):
            if not isinstance(value, int) or isinstance(value, bool) or not low <= value <= high:
                raise InvalidInput(f"{name} must be an integer between {low} and {high}")
        if not isinstance(self.self_reflection, bool):
            raise InvalidInput("self_reflection must be a boolean")

    @classmethod
    def preset(cls, name: str, **changes) -> "ScoringOptions":
        if name not in PRESETS:
            raise InvalidInput(f"unknown quality preset: {name}")
        values = dict(zip(("candidates", "samples", "self_reflection"), PRESETS[name]))
        unknown = set(changes) - set(values)
        if unknown:
            raise InvalidInput(f"unknown options: {sorted(unknown)}")
        return cls(**(values | changes))


def words(text: Column | str) -> Column:
    """Distinct lower-cased words, split at white space."""
    col = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.trim(F.regexp_replace(F.lower(col), r"[ \t\n\r\f\x0B]+", " ")), " ")
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def word_overlap(a: Column, b: Column) -> Column:
    """Shared words over all words of two word sets; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared.cast("double") / F.nullif(total, F.lit(0)))


def consistency_score(
    responses: DataFrame,
    samples: DataFrame,
    keys: Sequence[str] = ("prompt_id", "candidate_id"),
    text: str = "text",
    out_col: str = "consistency",
) -> DataFrame:
    """Adds the mean word overlap of each response with its samples; null without samples.

    Samples meet their response in an inner join, which adaptive execution can split on a hot key,
    and are averaged per task before they shuffle again.
    """
    keys = list(keys)
    own = responses.select(*keys, words(text).alias("__own"))
    drawn = samples.select(*keys, words(text).alias("__drawn"))
    overlap = (
        drawn.join(own, keys)
        .groupBy(*keys)
        .agg(F.avg(word_overlap(F.col("__own"), F.col("__drawn"))).alias(out_col))
    )
    return responses.join(overlap, keys, "left")


def trust_score(
    df: DataFrame,
    consistency: str = "consistency",
    reflection: str | None = None,
    weight: float = 0.7,
    out_col: str = "trust",
) -> DataFrame:
    """Weighted mean of consistency and self-reflection; the other alone if one is null."""
    a = F.col(consistency)
    b = F.col(reflection) if reflection else F.lit(None).cast("double")
    return df.withColumn(out_col, F.coalesce(weight * a + (1 - weight) * b, a, b))


def best_candidate(df: DataFrame, prompt: str = "prompt_id", candidate: str = "candidate_id", score: str = "trust") -> DataFrame:
    """Per prompt the candidate with the highest score, ties by the lowest id; null scores come last."""
    others = [c for c in df.columns if c != prompt]
    order = F.struct(F.coalesce(F.col(score), F.lit(float("-inf"))), -F.col(candidate))
    return (
        df.groupBy(prompt)
        .agg(F.max_by(F.struct(*others), order).alias("__best"))
        .select(prompt, "__best.*")
        .select(*df.columns)
    )


def low_trust_rows(
    df: DataFrame, id_cols: Sequence[str], score: str = "trust", n: int | None = None, threshold: float | None = None
) -> DataFrame:
    """The least trusted rows first: the ``n`` lowest, or all below ``threshold``."""
    if n is None and threshold is None:
        raise InvalidInput("give n or threshold")
    rows = df.where(F.col(score).isNotNull())
    if threshold is not None:
        rows = rows.where(F.col(score) < threshold)
    rows = rows.orderBy(F.asc(score), *id_cols)
    return rows if n is None else rows.limit(n)
