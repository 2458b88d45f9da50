"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(value)
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if not isinstance(v, (tuple, dict)) else str(v)) if v is not None else (True, "", "") for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def compare(spark, con, sf_dir, query, sql):
    """Difference report, empty when both sides agree."""
    df = query(spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    right = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if left != right:
        only_l = [r for r in left if r not in set(right)][:3]
        only_r = [r for r in right if r not in set(left)][:3]
        return f"{len(left)} vs {len(right)} rows; spark only {only_l}; sql only {only_r}"
    return f"" if left else "empty"
