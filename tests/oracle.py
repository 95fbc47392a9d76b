"""Runs queries and their oracle SQL side by side and compares rows whatever their order."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows(names: list[str], found: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in found), key=repr)


def difference(spark, con, f, sql: str, sf_dir: str) -> str:
    """What differs, or an empty text."""
    df = f(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = rows(want_names, result.fetchall())
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} and {sorted(want_names)}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want, strict=False) if a != b][:2]
        return f"{len(got)} and {len(want)} rows; {odd}"
    return ""
