"""Compares a query with its SQL counterpart in DuckDB, over all rows."""

import glob
import math
import os

import duckdb


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


def check(spark, query, sql, sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, cur = query(spark, sf), con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda row: tuple((v is None, str(type(v)), v) if not isinstance(v, (int, float)) else (False, "", float(v)) for v in row)
    a = sorted((tuple(_plain(r[c]) for c in names) for r in got.collect()), key=key)
    b = sorted((tuple(map(_plain, r)) for r in cur.fetchall()), key=key)
    assert a == b
    assert a is not None
