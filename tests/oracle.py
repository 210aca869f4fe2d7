"""Compares a query with its SQL in DuckDB over the same files, as the driver does."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value if isinstance(value, (int, bool, type(None), str)) else str(value)


def same(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    names = sorted(columns)
    mine = sorted((tuple(_plain(r[c]) for c in names) for r in df.collect()), key=repr)
    theirs = sorted((tuple(_plain(r[columns.index(c)]) for c in names) for r in result.fetchall()), key=repr)
    assert mine == theirs
