"""Compare a Spark result with DuckDB's answer to the same question."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()

# DuckDB type for each Spark type the queries may return.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def differences(frame, connection, sql: str) -> list[str]:
    """What differs: column names, types or rows; an empty list means equal."""
    answer = connection.execute(sql)
    theirs = {column[0]: str(column[1]) for column in answer.description}
    ours = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    problems = []
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} != {sorted(theirs)}"]
    for name in ours:
        if ours[name] != theirs[name]:
            problems.append(f"type of {name}: {ours[name]} != {theirs[name]}")
    names = sorted(ours)
    places = [list(theirs).index(name) for name in names]
    expected = Counter(tuple(_value(row[p]) for p in places) for row in answer.fetchall())
    found = Counter(tuple(_value(row[name]) for name in names) for row in frame.collect())
    if found != expected:
        extra, lacking = found - expected, expected - found
        problems.append(
            f"{sum(found.values())} rows, expected {sum(expected.values())}; "
            f"only here {list(extra)[:2]}, only there {list(lacking)[:2]} ({names})"
        )
    return problems
