"""Run a registered query and its SQL answer and compare them row by row."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "labels",
]


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def duckdb_rows(folder: str, sql: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return _table(columns, cursor.fetchall())


def spark_rows(df):
    return _table(df.columns, [tuple(r) for r in df.collect()])


def difference(df, folder: str, sql: str) -> str:
    """Empty when equal, else a short account of the first difference."""
    got_names, got = spark_rows(df)
    want_names, want = duckdb_rows(folder, sql)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{list(zip(got_names, a, b))}"
    return ""
