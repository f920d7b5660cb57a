"""Spark and DuckDB answers side by side."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb
from pyspark.sql import DataFrame


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with every table of the folder as a view."""
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def as_rows(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted; small results of checks only."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(answer: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or nothing."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(answer.columns):
        return f"columns {sorted(answer.columns)} and {sorted(names)}"
    wanted = as_rows(names, result.fetchall())
    got = as_rows(answer.columns, answer.collect())
    if len(wanted) != len(got):
        return f"{len(got)} rows and {len(wanted)} rows"
    wrong = [(g, w) for g, w in zip(got, wanted) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
