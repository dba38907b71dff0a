"""Rows of a Spark result against DuckDB's, in any order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6) + 0.0:.6f}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def check(df, con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = rows(names, cur.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want)
    assert got == want
