"""Comparing a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _sorted(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """Nothing when both give the same columns and rows, else what differs."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    wanted = _sorted(names, expected.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    seen = _sorted(frame.columns, [tuple(r) for r in frame.collect()])
    if len(seen) != len(wanted):
        return f"{len(seen)} rows instead of {len(wanted)}"
    for ours, theirs in zip(seen, wanted):
        if ours != theirs:
            return f"{ours} instead of {theirs}"
    return None
