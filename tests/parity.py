"""Compare a query with its SQL: same columns, same types, same rows whatever their order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()
# Spark and SQL names of a type.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return connection


def _sorted(rows) -> list[tuple]:
    def key(row):
        return tuple((v is None, "" if v is None else str(v)) for v in row)

    return sorted(rows, key=key)


def differences(df, connection, sql: str) -> list[str]:
    found = []
    result = connection.execute(sql)
    names, kinds = [c[0] for c in result.description], [str(c[1]) for c in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    found += [f"type of {n}: {ours[n]} <> {k}" for n, k in zip(names, kinds) if ours[n] != k]
    order = sorted(names)
    expected = _sorted(tuple(row[names.index(n)] for n in order) for row in result.fetchall())
    actual = _sorted(tuple(row[n] for n in order) for row in df.collect())
    if len(actual) != len(expected):
        return [*found, f"rows {len(actual)} <> {len(expected)}"]
    wrong = [(a, e) for a, e in zip(actual, expected) if not _same(a, e)]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {order}: {wrong[0][0]} <> {wrong[0][1]}")
    return found


def _same(a: tuple, b: tuple) -> bool:
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if x != y and not (math.isnan(x) and math.isnan(y)):
                return False
        elif x != y:
            return False
    return True
