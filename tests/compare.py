"""Run a query on Spark and its SQL twin on DuckDB and compare the two results."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tenura.sources.views import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _cell(v)) for k, v in value.items())
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences as short texts; an empty list means equal."""
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = canonical(names, result.fetchall())
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    if len(got) != len(want):
        found.append(f"{len(got)} rows against {len(want)}")
    if not found and got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        found.append(f"{len(bad)} rows differ, first: {bad[0]}")
    kinds = {type(v).__name__ for r in got for v in r}, {type(v).__name__ for r in want for v in r}
    if not found and kinds[0] != kinds[1]:
        found.append(f"types {kinds}")
    return found
