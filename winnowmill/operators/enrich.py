"""Adding a column derived from other columns by a prompt, and joining such results back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidInput
from ..functions.text import (
    RegexSpec,
    check_regex,
    constrain_outputs,
    options_prefix,
    process_regex,
    render_prompt,
    template_parts,
)
from .rows import SCORE_ENDING, drop_detail_columns, positional_subset, preview_sample, shift_row_id
from .scoring import RetryPolicy, Scorer, score_prompts

# Names of the row number columns of stored results.
STORED_ROW_ID = "stored_row_id"
PREVIEW_ROW_ID = "row_id"


@dataclass(frozen=True)
class EnrichmentOptions:
    prompt: str
    constrain_outputs: Sequence[str] | None = None
    optimize_prompt: bool = True
    regex: RegexSpec | None = None

    def __post_init__(self):
        if not self.prompt:
            raise InvalidInput("the prompt must not be empty")
        check_regex(self.regex)


def _answers(df, prompt, style, scorer, constrain, optimize, policy, keep_columns) -> DataFrame:
    template_parts(prompt, style)
    prefix = options_prefix(constrain) if optimize else ""
    rendered = df.select(*keep_columns, render_prompt(df, prompt, style, prefix).alias("__prompt"))
    return score_prompts(rendered, "__prompt", scorer, "capture", out_col="__scored", policy=policy)


def _refined(scored: DataFrame, regex: RegexSpec | None, constrain: Sequence[str] | None) -> DataFrame:
    """Adds ``__raw``, the answer, and ``__refined``, the answer after post-processing."""
    raw = scored.withColumn("__raw", F.col("__scored")["response"])
    # A column of its own, since the vocabulary step reads the processed text several times.
    processed = raw.withColumn("__refined", process_regex("__raw", regex))
    if not constrain:
        return processed
    return processed.withColumn("__refined", constrain_outputs("__refined", constrain))


def enrich(
    df: DataFrame,
    prompt: str,
    scorer: Scorer,
    regex: RegexSpec | None = None,
    constrain: Sequence[str] | None = None,
    optimize: bool = True,
    subset: tuple[int, int] | range | Sequence[int] | None = (0, 3),
    new_column: str = "metadata",
    order_by: Sequence[str] | str | None = None,
    keep: Sequence[str] = (),
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """``new_column``, its trust score and, if the answer is post-processed, the raw answer.

    ``prompt`` names columns in braces. ``subset`` is a position range or list, None for all rows.
    ``keep`` lists columns of ``df`` (such as its id) to carry along.
    """
    rows = positional_subset(df, subset, order_by)
    scored = _answers(rows, prompt, "format", scorer, constrain, optimize, policy, keep)
    scored = _refined(scored, regex, constrain)
    columns = [
        F.col("__refined").alias(new_column),
        F.col("__scored")["trustworthiness_score"].alias(f"{new_column}_trustworthiness"),
    ]
    if check_regex(regex) is not None or constrain:
        columns.append(F.col("__raw").alias(f"{new_column}_log"))
    return scored.select(*keep, *columns)


def enrich_project(
    df: DataFrame,
    options: EnrichmentOptions,
    new_column: str,
    scorer: Scorer,
    id_col: str,
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Result, trust score, raw answer and log text of every row, keyed by ``id_col``.

    The prompt names columns as ``${column}``.
    """
    scored = _answers(
        df, options.prompt, "template", scorer, options.constrain_outputs, options.optimize_prompt, policy, [id_col]
    )
    return _refined(scored, options.regex, options.constrain_outputs).select(
        id_col,
        F.col("__refined").alias(new_column),
        F.col("__scored")["trustworthiness_score"].alias(new_column + SCORE_ENDING),
        F.col("__raw").alias(f"{new_column}_raw"),
        F.col("__scored")["log"]["error"]["message"].alias(f"{new_column}_log"),
    )


def enrich_preview(
    df: DataFrame,
    options: EnrichmentOptions,
    new_column: str,
    scorer: Scorer,
    id_col: str,
    indices: Sequence[int] | None = None,
    seed: int = 0,
    order_by: Sequence[str] | str | None = None,
) -> DataFrame:
    """``enrich_project`` on at most ten given positions, or on three rows drawn by a seed."""
    rows = preview_sample(df, id_col, indices, seed=seed, order_by=order_by or id_col)
    return enrich_project(rows, options, new_column, scorer, id_col)


def enrichment_results(stored: DataFrame, row_id: str = STORED_ROW_ID, name: str = PREVIEW_ROW_ID) -> DataFrame:
    """Stored results with their 1-based row number turned into a 0-based ``row_id``."""
    return shift_row_id(stored, row_id, -1, name)


def _join(original, results, id_col, with_details, how):
    shared = (set(original.columns) & set(results.columns)) - {id_col}
    if shared:
        raise InvalidInput(f"the results already contain columns of the original data: {sorted(shared)}")
    chosen = results if with_details else drop_detail_columns(results)
    return original.join(chosen, id_col, how)


def join_enrichment(original: DataFrame, results: DataFrame, id_col: str, with_details: bool = False) -> DataFrame:
    """Every original row with its results, if any."""
    return _join(original, results, id_col, with_details, "left")


def join_preview(original: DataFrame, results: DataFrame, id_col: str, with_details: bool = False) -> DataFrame:
    """Only the rows that a preview has enriched."""
    return _join(original, results, id_col, with_details, "inner")
