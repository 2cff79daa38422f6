"""Row-multiset comparison of a Spark result with DuckDB's answer to the SQL counterpart."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql) -> tuple[int, Counter, Counter]:
    """Number of Spark rows, rows only Spark has, rows only the SQL has."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns), (sorted(df.columns), sorted(names))
    expected = multiset(names, result.fetchall())
    rows = df.collect()
    actual = multiset(df.columns, rows)
    return len(rows), actual - expected, expected - actual
