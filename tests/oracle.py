"""Compare a query with its SQL check, value by value."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from catalog.tables import NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)) or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat() + "T00:00:00"
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    ours, theirs = spark_rows(df), duck_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    for left, right in zip(ours[1], theirs[1], strict=True):
        kinds = [type(v) is not type(w) and None not in (v, w) for v, w in zip(left, right, strict=True)]
        if left != right or any(kinds):
            return f"{left} against {right}"
    return None
