"""Reading datasets, audit columns and vectors."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidInput
from ..operators.rows import select_audit_columns
from ..plans.positions import with_row_position


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    multiline: bool = True,
) -> DataFrame:
    """CSV with a header row; all strings unless ``schema`` or ``infer`` says otherwise.

    Undecodable bytes are dropped, extra cells are lost and missing ones null. With ``multiline``
    cells may hold line breaks, at the price that one file is one task; turn it off for large files
    without such cells, which Spark then splits.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multiline)
    df = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", infer).csv(path)
    # The decoder leaves a replacement character where bytes were undecodable.
    return df.select(
        *[
            F.replace(F.col(f"`{f.name}`"), F.lit("�"), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    lines: bool = False,
    row_id: str | None = "id",
) -> DataFrame:
    """Array of objects per file (or one object per line); adds the row position as text ``row_id``."""
    reader = spark.read.option("multiLine", not lines)
    df = reader.schema(schema).json(path) if schema is not None else reader.json(path)
    if row_id is None:
        return df
    return with_row_position(df.drop(row_id), row_id).withColumn(row_id, F.col(row_id).cast("string"))


def _field_types(rows: DataFrame) -> list[tuple[str, str]]:
    """Names of the fields of all objects in the column ``row``, and a type that holds the values of each."""
    fields = rows.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("row").outer()))
    found = fields.groupBy("key").agg(F.schema_of_variant_agg("value").alias("type")).orderBy("key").collect()
    # Variants know decimals, records have floating point numbers; a field of nulls only is text.
    return [
        (r["key"], "string" if r["type"] == "VOID" else re.sub(r"DECIMAL\(\d+,\s*[1-9]\d*\)", "DOUBLE", r["type"].replace("OBJECT<", "STRUCT<")))
        for r in found
    ]


def read_json_keyed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One object per file whose keys are row ids; gives the fields of each row and its key as ``id``.

    A file is parsed once, into a variant, and its entries are taken from there. Without ``schema`` the names
    and types of the fields come from an aggregate over the entries. A field called ``id`` gives way to the
    key; empty objects and an empty file give no rows.
    """
    reader = spark.read.option("singleVariantColumn", "file").option("multiLine", True)
    files = reader.json(path)
    entries = files.lateralJoin(spark.tvf.variant_explode(F.col("file").outer())).select(
        F.col("key").alias("id"), F.col("value").alias("row")
    )
    if schema is None:
        fields = _field_types(entries)
    else:
        # A parsed schema; the names of nested fields stay inside their types.
        parsed = schema if isinstance(schema, T.StructType) else _parsed(schema)
        fields = [(f.name, f.dataType.simpleString()) for f in parsed]
    columns = [F.try_variant_get("row", _path_of(n), t).alias(n) for n, t in fields if n != "id"]
    return entries.select(*columns, "id")


def _path_of(name: str) -> str:
    if "'" in name and '"' in name:
        raise InvalidInput(f"a field name with both kinds of quotes cannot be read: {name}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def _parsed(schema: str) -> T.StructType:
    kind = T.DataType.fromDDL(schema)
    if isinstance(kind, T.StructType) and len(kind) == 1 and kind.fieldNames() == ["value"]:
        kind = kind[0].dataType
    return kind


# Accepted file endings.
_BY_EXTENSION = {
    ".csv": "csv",
    ".json": "json",
    ".jsonl": "jsonl",
    ".parquet": "parquet",
    ".orc": "orc",
    ".xls": "excel",
    ".xlsx": "excel",
}


def dataset_format(path: str, format: str | None = None) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    ending = "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""
    kind = format or _BY_EXTENSION.get(ending)
    if kind not in set(_BY_EXTENSION.values()):
        raise InvalidInput(f"file type {format or ending or path} is not supported")
    return kind


def load_dataset(spark: SparkSession, path: str, format: str | None = None, **options) -> DataFrame:
    """Read a file by its ending: CSV, JSON records, JSON lines, Parquet, ORC."""
    kind = dataset_format(path, format)
    if kind == "excel":
        raise InvalidInput("spreadsheets are read by one machine only; save the sheet as CSV or Parquet")
    if kind == "csv":
        return read_csv(spark, path, **options)
    if kind in ("json", "jsonl"):
        return read_json_records(spark, path, lines=kind == "jsonl", **options)
    return spark.read.format(kind).options(**options).load(path)


def load_table(spark: SparkSession, format: str, **options) -> DataFrame:
    """Any table Spark has a connector for, such as a warehouse over JDBC; the jar is the user's."""
    return spark.read.format(format).options(**options).load()


def read_audit_columns(
    spark: SparkSession,
    path: str,
    id_col: str,
    include_audit: bool = True,
    include_project: bool = False,
    sort: bool = False,
    format: str | None = None,
) -> DataFrame:
    """Stored audit columns, their ``id`` renamed to ``id_col``, limited to the chosen families."""
    kind = dataset_format(path, format)
    df = load_dataset(spark, path, kind, row_id=None) if kind in ("json", "jsonl") else load_dataset(spark, path, kind)
    if id_col not in df.columns:
        df = df.withColumnRenamed("id", id_col)
    out = select_audit_columns(df, id_col, include_audit, include_project)
    return out.orderBy(id_col) if sort else out


def read_vectors(
    df: DataFrame, id_col: str, columns: Sequence[str] | str, name: str, keep_id: bool = True
) -> DataFrame:
    """One ``array<double>`` column ``name`` from an array column or from one column per element."""
    if isinstance(columns, str):
        vector = F.col(columns).cast("array<double>")
    else:
        vector = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*([id_col] if keep_id else []), vector.alias(name))


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of data rows; Parquet answers from file footers."""
    return df.agg(F.count("*").alias("n_rows"))


def column_names(df: DataFrame) -> list[str]:
    return [str(c) for c in df.columns]
