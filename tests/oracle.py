"""Run a query and its DuckDB SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, query, sql: str) -> int:
    """Number of rows; an AssertionError tells the first difference."""
    df = query(spark, sf_dir)
    cur = connect(sf_dir).execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    got, want = rows_of(df.columns, df.collect()), rows_of(names, cur.fetchall())
    assert len(got) == len(want), (len(got), len(want))
    for a, b in zip(got, want, strict=True):
        assert a == b, (sorted(names), a, b)
    return len(got)
