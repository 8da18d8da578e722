"""Compare query results with their SQL statement in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

from tidemark.catalogue.inputs import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def _plain(value: object) -> tuple:
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, int(value))
    if isinstance(value, float):
        return (3, "NaN") if math.isnan(value) else (1, value + 0.0)
    if isinstance(value, int):
        return (1, value)
    return (2, str(value))


def _table(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results agree, else what differs."""
    got_names = frame.columns
    got = _table(got_names, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = _table(want_names, cursor.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None
