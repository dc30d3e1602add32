"""Compares a DataFrame with oracle SQL over the same Parquet tables."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(folder, f"{t}.parquet")
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)


def rows_of_sql(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    return cols, sorted((tuple(plain(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall()), key=str)


def assert_same(df, con, sql):
    assert rows_of(df) == rows_of_sql(con, sql)
