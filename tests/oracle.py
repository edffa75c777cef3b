"""Side-by-side comparison of a Spark result and a DuckDB result."""

import os

import duckdb
import pandas as pd


def connect(sf):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in os.listdir(sf):
        con.sql(f"create view {name.split('.')[0]} as select * from '{sf}/{name}'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    plain = lambda v: None if pd.isna(v) else float(v) if isinstance(v, float) else v
    return cols, sorted((tuple(plain(v) for v in r) for r in frame[cols].astype(object).itertuples(index=False, name=None)), key=repr)


def same(df, con, sql):
    got, want = rows(df.toPandas()), rows(con.sql(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
