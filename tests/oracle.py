"""Run a query and its SQL twin, and compare the tables value by value."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def differences(df, con, sql) -> list[str]:
    """What differs, empty when the tables are equal."""
    mine_names, mine = _table(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    their_names, theirs = _table([d[0] for d in found.description], found.fetchall())
    if mine_names != their_names:
        return [f"columns {mine_names} != {their_names}"]
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows != {len(theirs)} rows"]
    types = [
        f"{name}: {type(a).__name__} != {type(b).__name__}"
        for x, y in zip(mine[:1], theirs[:1])
        for name, a, b in zip(mine_names, x, y)
        if type(a) is not type(b)
    ]
    return types + [f"{a} != {b}" for a, b in zip(mine, theirs) if a != b]
