"""The row operators on streams: stateless except for running job progress."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import RegexSpec
from ..operators.corrections import apply_corrections
from ..operators.enrich import enrich
from ..operators.jobs import job_progress
from ..operators.scoring import RetryPolicy, Scorer


def stream_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "csv",
    files_per_batch: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Records of a growing folder of CSV, JSON lines or Parquet files, of all or those whose names fit ``pattern``."""
    reader = spark.readStream.schema(schema).format(format)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def enrich_stream(
    stream: DataFrame,
    prompt: str,
    scorer: Scorer,
    keep: Sequence[str],
    regex: RegexSpec | None = None,
    constrain: Sequence[str] | None = None,
    optimize: bool = True,
    new_column: str = "metadata",
    policy: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """``enrich`` for rows as they arrive; failing rows carry nulls, not an end of the stream."""
    return enrich(stream, prompt, scorer, regex, constrain, optimize, None, new_column, None, keep, policy)


def progress_stream(stream: DataFrame, score: str, job: Sequence[str] | str) -> DataFrame:
    """Running progress per job, for the update or complete output mode. State: one row per job."""
    return job_progress(stream, score, job)


def corrections_stream(stream: DataFrame, audit: DataFrame, id_col: str, label: str, keep_excluded: bool = False) -> DataFrame:
    """Corrections applied to rows that arrive after the audit."""
    return apply_corrections(stream, audit, id_col, label, keep_excluded, how="dataset")


def resumable_enrich(
    stream: DataFrame,
    checkpoint: str,
    out_path: str,
    enrichment: Callable[[DataFrame], DataFrame],
    format: str = "parquet",
) -> StreamingQuery:
    """Enrich what has arrived, then stop. Run again with the same checkpoint, it goes on from there.

    Stopping the query pauses the job; finished files are not scored again.
    """
    return (
        enrichment(stream)
        .writeStream.format(format)
        .option("checkpointLocation", checkpoint)
        .option("path", out_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
