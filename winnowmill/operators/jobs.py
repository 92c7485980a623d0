"""Progress and history of enrichment jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _progress_columns(score: str) -> list[Column]:
    return [
        F.count("*").alias("num_rows"),
        F.count(score).alias("processed_rows"),
        F.avg(score).alias("average_trustworthiness_score"),
    ]


def _status() -> Column:
    return (
        F.when(F.col("processed_rows") == 0, "CREATED")
        .when(F.col("processed_rows") < F.col("num_rows"), "RUNNING")
        .otherwise("SUCCEEDED")
    )


def job_progress(df: DataFrame, score: str, job: Sequence[str] | str = ()) -> DataFrame:
    """Rows, rows with a score, mean score and status, for the whole table or per job."""
    keys = [job] if isinstance(job, str) else list(job)
    return df.groupBy(*keys).agg(*_progress_columns(score)).withColumn("status", _status())


def score_history(jobs: DataFrame, created: str, score: str) -> DataFrame:
    """Scored jobs in order of creation, with the time as text."""
    return (
        jobs.where(F.col(score).isNotNull())
        .orderBy(created)
        .withColumn(created, F.date_format(created, "yyyy-MM-dd HH:mm:ss"))
    )


def readiness(status: Column | str, job_type: Column | str | None = None) -> Column:
    """``ready``, ``not ready`` or the reason why a job can never become ready."""
    state = F.col(status) if isinstance(status, str) else status
    kind = F.col(job_type) if isinstance(job_type, str) else job_type
    verdict = F.when(kind != "ENRICHMENT", "error: preview") if kind is not None else F.when(F.lit(False), "")
    return (
        verdict.when(state == "SUCCEEDED", "ready")
        .when(state.isin("RUNNING", "CREATED"), "not ready")
        .when(state == "FAILED", "error: failed")
        .when(state == "PAUSED", "error: paused")
        .otherwise("error: unknown status")
    )


def latest_job(jobs: DataFrame, project: str, created: str, job_id: str) -> DataFrame:
    """Newest job per project, ties by the larger id. An aggregate, so busy projects combine early."""
    order = F.struct(F.col(created), F.col(job_id))
    others = [c for c in jobs.columns if c != project]
    return (
        jobs.groupBy(project)
        .agg(F.max_by(F.struct(*others), order).alias("__job"))
        .select(project, "__job.*")
        .select(*jobs.columns)
    )
