"""Row-by-row comparison of a Spark result with the SQL oracle."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# DuckDB type of each Spark type that the results use.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _sort_key(row):
    return tuple((value is not None, str(value)) for value in row)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str, limit: int = 5) -> list[str]:
    """What differs: columns, types, row count or values; empty if nothing does."""
    result = connection.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    ours = {name: TYPES[kind] for name, kind in df.dtypes}
    names = sorted(ours)
    if names != sorted(theirs):
        return [f"columns {names} != {sorted(theirs)}"]
    found = [f"type of {n}: {ours[n]} != {theirs[n]}" for n in names if ours[n] != theirs[n]]
    places = [list(theirs).index(n) for n in names]
    right = sorted((tuple(row[p] for p in places) for row in rows), key=_sort_key)
    left = sorted((tuple(row[n] for n in names) for row in df.select(*names).collect()), key=_sort_key)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    for a, b in zip(left, right, strict=False):
        if a != b and not all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b, strict=True)):
            found.append(f"{dict((n, (x, y)) for n, x, y in zip(names, a, b, strict=True) if x != y)} in {a}")
            if len(found) >= limit:
                break
    return found
