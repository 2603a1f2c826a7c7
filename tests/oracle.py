"""Comparison of a Spark result with what DuckDB makes of the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def assert_same(df, sql: str, con) -> int:
    columns = sorted(df.columns)
    got = sorted(tuple(_value(r[c]) for c in columns) for r in df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted(tuple(_value(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert got == want
    return len(got)
