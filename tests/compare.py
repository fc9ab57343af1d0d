"""Run a registered query and its SQL twin on the same folder and compare them value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.date, datetime.datetime)):
        raise AssertionError("dates must be reported as text")
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, query, sql: str, folder: str) -> list[str]:
    """Empty if names, row counts, types of values and all values agree exactly."""
    df = query(spark, folder)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns differ: {sorted(set(df.columns) ^ set(names))}"]
    if len(ours) != len(theirs):
        return [f"row counts differ: {len(ours)} and {len(theirs)}"]
    if not ours:
        return ["both results are empty"]
    columns = sorted(names)
    found = []
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            found.append(str([(c, x, y) for c, x, y in zip(columns, a, b, strict=True) if x != y][:4]) + f" in {a[:3]}")
    return found
