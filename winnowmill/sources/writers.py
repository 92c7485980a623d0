"""Writing datasets and results. Every writer is distributed: one part file per task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..errors import InvalidInput
from .readers import dataset_format


def write_json_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row and line."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_results(df: DataFrame, path: str, format: str | None = None, mode: str = "append") -> None:
    """CSV with a header in every part, JSON lines, Parquet or ORC; by default added to what is there."""
    kind = dataset_format(path, format)
    if kind == "excel":
        raise InvalidInput("spreadsheets are not written; use CSV or Parquet")
    if kind in ("json", "jsonl"):
        write_json_records(df, path, mode)
    elif kind == "csv":
        df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode(mode).format(kind).save(path)


def export_results_csv(df: DataFrame, path: str) -> None:
    """Results of a job as CSV; the name must end in ``.csv``."""
    if not path.endswith(".csv"):
        raise InvalidInput("the file name must end in .csv")
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
