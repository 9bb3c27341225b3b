"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(folder, name)}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if names, types and rows agree, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    kinds = {n: str(t) for n, t in zip(names, [d[1] for d in result.description])}
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "boolean": "BOOLEAN", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}
    wrong = [(n, kinds[n], t) for n, t in df.dtypes if spark_kinds.get(t, t) != kinds[n]]
    if wrong:
        return f"types differ: {wrong}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    for one, two in zip(actual, expected):
        if one != two:
            return f"row {one} instead of {two}"
    return ""
