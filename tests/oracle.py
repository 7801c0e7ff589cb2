"""Run a registered query and its oracle SQL, and compare the rows as multisets."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (date, datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, sql: str, connection) -> str | None:
    """None if equal, else what differs."""
    found = connection.execute(sql)
    sql_columns = [d[0] for d in found.description]
    expected = rows_of(sql_columns, found.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    if actual != expected:
        extra, missing = actual - expected, expected - actual
        return (
            f"{sum(actual.values())} rows vs {sum(expected.values())}; "
            f"only spark {sum(extra.values())}: {list(extra)[:3]}; "
            f"only sql {sum(missing.values())}: {list(missing)[:3]}"
        )
    return None
