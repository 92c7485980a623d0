"""Run a query on Spark and its SQL on DuckDB, and compare columns, types and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "array<string>": "VARCHAR[]",
    "array<double>": "DOUBLE[]",
    "array<bigint>": "BIGINT[]",
    "timestamp_ntz": "TIMESTAMP",
}


def _key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_key(v) for v in value)
    return repr(value)


def compare(df, connection, sql: str) -> list[str]:
    """Differences, empty if there are none."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    expected = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    types = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if _TYPES.get(types[name], types[name]) != kind:
            problems.append(f"type of {name}: {types[name]} != {kind}")
    got = df.select(*names).collect()
    left = sorted(tuple(_key(v) for v in row) for row in got)
    right = sorted(tuple(_key(v) for v in row) for row in expected)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    elif left != right:
        bad = [(a, b) for a, b in zip(left, right) if a != b]
        problems.append(f"{len(bad)} rows differ, first: {str(bad[0])[:400]}")
    return problems
