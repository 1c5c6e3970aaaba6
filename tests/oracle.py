"""Compare a registered query with its SQL equivalent, row by row."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat(" ")
    if isinstance(value, date):
        return f"date {value.isoformat()}"
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool):
        return str(value)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str:
    """Empty when both sides hold the same bag of rows, else what differs."""
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    found = _bag(frame.columns, frame.collect())
    expected = _bag(columns, expected_rows)
    if found == expected:
        return ""
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
    )
