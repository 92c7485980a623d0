"""Typed schemas, column profiles and label-column checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidInput
from ..functions.text import split_labels
from ..functions.typing import COLUMN_TYPES, cast_to, isoformat

# The column type behind each pair (data type, feature type). Identifiers keep their
# base type and ``filepath`` is another name for ``image``.
LEGACY_TYPES = {
    ("string", "text"): "string",
    ("string", "categorical"): "string",
    ("string", "identifier"): "string",
    ("string", "datetime"): "datetime",
    ("string", "image"): "image_external",
    ("string", "filepath"): "image_external",
    ("integer", "categorical"): "integer",
    ("integer", "numeric"): "integer",
    ("integer", "identifier"): "integer",
    ("integer", "datetime"): "datetime",
    ("float", "numeric"): "float",
    ("float", "datetime"): "datetime",
    ("boolean", "boolean"): "boolean",
}

Overrides = Sequence[Mapping[str, str]] | Mapping[str, Mapping[str, str]]


def normalize_overrides(overrides: Overrides) -> list[tuple[str, str]]:
    """``(name, column_type)`` pairs from either form of override."""
    if isinstance(overrides, Mapping):
        pairs = []
        for name, old in overrides.items():
            kind = LEGACY_TYPES.get((old.get("data_type"), old.get("feature_type")))
            if kind is None:
                raise InvalidInput(f"unsupported data type and feature type for {name}: {dict(old)}")
            pairs.append((name, kind))
        return pairs
    if not isinstance(overrides, (list, tuple)):
        raise InvalidInput("schema overrides must be a list of objects")
    pairs = []
    for item in overrides:
        if not isinstance(item, Mapping) or "name" not in item or "column_type" not in item:
            raise InvalidInput("each schema override needs a 'name' and a 'column_type'")
        if item["column_type"] not in COLUMN_TYPES:
            raise InvalidInput(f"unknown column type: {item['column_type']}")
        pairs.append((item["name"], item["column_type"]))
    return pairs


def _checked(df: DataFrame, overrides: Overrides) -> list[tuple[str, str]]:
    pairs = normalize_overrides(overrides)
    missing = [n for n, _ in pairs if n not in df.columns]
    if missing:
        raise InvalidInput(f"schema overrides name unknown columns: {missing}")
    return pairs


def apply_schema_overrides(df: DataFrame, overrides: Overrides) -> DataFrame:
    """Cast the named columns, all in one projection; values that do not conform become null."""
    kinds = dict(_checked(df, overrides))
    return df.select(*[cast_to(c, kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def type_conformity(df: DataFrame, overrides: Overrides) -> DataFrame:
    """Per override: rows, nulls and values that do not conform, from one pass over the data."""
    pairs = _checked(df, overrides)
    counts = []
    for i, (name, kind) in enumerate(pairs):
        bad = F.col(name).isNotNull() & cast_to(name, kind).isNull()
        counts += [
            F.count_if(F.col(name).isNull()).alias(f"null_{i}"),
            F.count_if(bad).alias(f"bad_{i}"),
        ]
    totals = df.agg(F.count("*").alias("n_rows"), *counts)
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.col("n_rows"),
            F.col(f"null_{i}").alias("n_null"),
            F.col(f"bad_{i}").alias("n_invalid"),
        )
        for i, (name, kind) in enumerate(pairs)
    ]
    return totals.select(F.inline(F.array(*lines)))


def isoformat_temporal(df: DataFrame) -> DataFrame:
    """Every date and timestamp column as ISO text."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            isoformat(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, temporal) else F.col(f.name)
            for f in df.schema
        ]
    )


def _unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, average text length.

    The exact form counts each (column, value) first, so one frequent value costs one row per task;
    long values travel as a digest. ``exact=False`` estimates distinct values in a single pass.
    """
    names = list(columns or df.columns)
    cells = _unpivoted(df, names).withColumn("length", F.char_length("value"))
    if not exact:
        return cells.groupBy("column_name").agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("value").isNull()).alias("n_null"),
            F.approx_count_distinct("value").alias("n_distinct"),
            F.avg("length").alias("avg_length"),
        )
    short = F.when(F.col("length") > 64, F.concat(F.sha2("value", 256), F.lit(":long"))).otherwise(
        F.col("value")
    )
    values = cells.groupBy("column_name", short.alias("value")).agg(
        F.count("*").alias("n"), F.max("length").alias("length")
    )
    known = F.col("value").isNotNull()
    return values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(known, F.lit(0)).otherwise(F.col("n"))).alias("n_null"),
        F.count_if(known).alias("n_distinct"),
        (
            F.sum(F.when(known, F.col("n") * F.col("length"))).cast("double")
            / F.nullif(F.sum(F.when(known, F.col("n"))), F.lit(0))
        ).alias("avg_length"),
    )


def profile_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A profile that can be stored and merged: per column counts and sketches of values and text lengths.

    ``(column_name, n_rows, n_null, length_sum, values, lengths)``, one pass over the rows. ``values`` is a
    HyperLogLog sketch of the distinct values, ``lengths`` a KLL sketch of text lengths; both have a fixed
    size. Profile a new partition by itself and merge: nothing is scanned again.
    """
    cells = _unpivoted(df, list(columns or df.columns)).withColumn("length", F.char_length("value").cast("bigint"))
    return cells.groupBy("column_name").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.sum("length").alias("length_sum"),
        F.hll_sketch_agg("value", F.lit(14)).alias("values"),
        F.kll_sketch_agg_bigint("length").alias("lengths"),
    )


def merge_sketches(profiles: DataFrame) -> DataFrame:
    """One row per column from any number of profiles of different rows, as if all had been profiled together."""
    return profiles.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.sum("length_sum").alias("length_sum"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_bigint("lengths").alias("lengths"),
    )


def read_sketches(profiles: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """``(column_name, n_rows, n_null, n_distinct, avg_length, length_quantiles)``; distinct values and quantiles are estimates.

    The number of distinct values is off by about 1 %, the rank of a quantile by about 1.5 %; a column of
    nulls only has no average and no quantiles.
    """
    known = F.col("n_rows") > F.col("n_null")
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return profiles.select(
        "column_name",
        "n_rows",
        "n_null",
        F.hll_sketch_estimate("values").alias("n_distinct"),
        F.try_divide(F.col("length_sum").cast("double"), F.col("n_rows") - F.col("n_null")).alias("avg_length"),
        F.when(known, F.kll_sketch_get_quantile_bigint("lengths", asked)).alias("length_quantiles"),
    )


def label_diversity(df: DataFrame, label: str, min_classes: int = 2, min_per_class: int = 5) -> DataFrame:
    """One row: classes, classes with enough examples, and whether that is enough for training."""
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("n"))
        .agg(
            F.count("*").alias("n_classes"),
            F.count_if(F.col("n") >= min_per_class).alias("n_large_classes"),
        )
        .withColumn("has_minimal_diversity", F.col("n_large_classes") >= min_classes)
    )


def multilabel_validity(df: DataFrame, label: str) -> DataFrame:
    """One row: rows whose comma-separated label list holds a blank item, and whether there are none."""
    blank = F.exists(split_labels(label), lambda i: F.trim(i) == "")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(label).isNotNull() & blank).alias("n_invalid"),
    ).withColumn("is_valid", F.col("n_invalid") == 0)


# Label types each kind of task accepts.
TASK_LABEL_TYPES = {
    "multi-class": (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType),
    "multi-label": (T.StringType,),
    "regression": (T.FloatType, T.DoubleType, T.DecimalType),
}


def validate_label_column(df: DataFrame, label: str | None, task: str | None, modality: str = "tabular") -> DataFrame:
    """One row ``(label_column, task, n_unique, problem)``; ``problem`` is null for a usable label.

    A wrong column name or type raises at once; what needs the data is computed lazily.
    """
    if task in (None, "unsupervised"):
        return df.sparkSession.range(1).select(
            F.lit(label).cast("string").alias("label_column"),
            F.lit(task).cast("string").alias("task"),
            F.lit(None).cast("bigint").alias("n_unique"),
            F.lit(None).cast("string").alias("problem"),
        )
    if task not in TASK_LABEL_TYPES:
        raise InvalidInput(f"unknown task: {task}")
    if label not in df.columns:
        raise InvalidInput(f"label column does not exist: {label}")
    if not isinstance(df.schema[label].dataType, TASK_LABEL_TYPES[task]):
        raise InvalidInput(f"{task} projects cannot use a label of type {df.schema[label].dataType}")

    blank = (
        F.exists(split_labels(label), lambda i: F.trim(i) == "") if task == "multi-label" else F.lit(False)
    )
    per_class = (
        df.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("n"), F.max(blank).alias("blank"))
    )
    totals = per_class.agg(
        F.count("*").alias("n_unique"),
        F.count_if(F.col("n") >= 5).alias("n_large"),
        F.coalesce(F.max("blank"), F.lit(False)).alias("any_blank"),
    )
    problem = F.when(F.col("n_unique") < 2, "fewer than 2 unique values")
    if task == "multi-class" and modality == "tabular":
        problem = problem.when(F.col("n_large") < 2, "fewer than 2 classes with 5 examples each")
    if task == "multi-label":
        problem = problem.when(F.col("any_blank"), "not a comma-separated list of labels")
    return totals.select(
        F.lit(label).alias("label_column"), F.lit(task).alias("task"), "n_unique", problem.alias("problem")
    )


def select_features(
    df: DataFrame, label: str, features: Sequence[str] | None = None, modality: str = "tabular"
) -> DataFrame:
    """Feature columns followed by the label; by default everything but the label."""
    if features is not None and modality != "tabular":
        raise InvalidInput("feature columns can only be chosen for tabular data")
    if features is not None and label in features:
        raise InvalidInput("the label cannot be one of the features")
    chosen = [c for c in df.columns if c != label] if features is None else list(features)
    return df.select(*chosen, label)


def guess_text_column(df: DataFrame) -> str:
    """String column with the longest average text; one row of averages is fetched."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        raise InvalidInput("there is no text column")
    averages = df.agg(*[F.avg(F.char_length(t)).alias(t) for t in texts]).first()
    return max(texts, key=lambda t: (averages[t] is not None, averages[t] or 0.0))


def select_text_column(df: DataFrame, text: str | None = None, modality: str = "text") -> DataFrame:
    """The text column under the name ``text``; the longest string column when none is named."""
    if modality != "text":
        raise InvalidInput("a text column can only be chosen for text data")
    return df.select(F.col(text or guess_text_column(df)).alias("text"))
