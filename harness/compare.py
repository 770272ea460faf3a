"""Comparing a Spark result with DuckDB's, regardless of row and column order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, otherwise what differs."""
    cursor = con.execute(sql)
    expected_columns, expected = _counted([d[0] for d in cursor.description], cursor.fetchall())
    columns, found = _counted(result.columns, result.collect())
    if columns != expected_columns:
        return f"columns {sorted(set(columns) ^ set(expected_columns))}"
    if found != expected:
        extra, lacking = found - expected, expected - found
        return (
            f"{sum(found.values())} rows against {sum(expected.values())}; extra {list(extra.items())[:2]}; "
            f"lacking {list(lacking.items())[:2]}"
        )
    return None
