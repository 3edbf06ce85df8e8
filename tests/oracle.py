"""Comparison of a query with its oracle SQL on the same files."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pandas as pd


def connect(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else f"{v:.9g}"
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return v


def compare(spark, data: str, query, sql: str) -> None:
    df = query(spark, data)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = connect(data).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert ours == theirs, (list((ours - theirs).items())[:3], list((theirs - ours).items())[:3])
