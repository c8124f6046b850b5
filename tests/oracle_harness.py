"""Side-by-side check of a registered query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, equal multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from feedledger import fixtures as FX


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for b in FX.BASE_TABLES:
        con.execute(f"CREATE VIEW {b} AS SELECT * FROM read_parquet('{sf_dir}/{b}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of_spark(df):
    names = df.columns
    return names, [tuple(_norm(r[i]) for i in range(len(names))) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    return names, [tuple(_norm(v) for v in r) for r in rel.fetchall()]


def compare(df, con, sql):
    sn, sr = rows_of_spark(df)
    dn, dr = rows_of_duck(con, sql)
    problems = []
    if sorted(sn) != sorted(dn):
        problems.append(f"columns spark={sn} duck={dn}")
        return problems, len(sr), len(dr)
    order = [dn.index(c) for c in sn]
    dr = [tuple(r[i] for i in order) for r in dr]
    if len(sr) != len(dr):
        problems.append(f"rows spark={len(sr)} duck={len(dr)}")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    if sorted(sr, key=key) != sorted(dr, key=key):
        ss, dd = set(sr), set(dr)
        problems.append(f"values differ: spark-only={list(ss - dd)[:3]} duck-only={list(dd - ss)[:3]}")
    return problems, len(sr), len(dr)
