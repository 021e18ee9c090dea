"""Comparing queries with SQL that DuckDB runs on the same tables."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = "/root/testdata/sf0.001"


def connect(folder: str = TABLES) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for f in os.listdir(folder):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return db


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def same(df, sql: str, folder: str = TABLES) -> None:
    names = sorted(df.columns)
    ours = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    cursor = connect(folder).execute(sql)
    theirs = [d[0] for d in cursor.description]
    assert sorted(theirs) == names
    rows = sorted((tuple(plain(r[theirs.index(n)]) for n in names) for r in cursor.fetchall()), key=repr)
    assert ours == rows
