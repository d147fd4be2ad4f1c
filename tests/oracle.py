"""Compares a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def plain(x):
    if x is None or x != x:
        return None
    if isinstance(x, bool | str):
        return x
    return round(float(x), 6)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def check(spark, duck, query, sql: str, sf_dir: str) -> None:
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    own = duck.execute(sql)
    names = [d[0] for d in own.description]
    want = rows(names, own.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert got == want, [(a, b) for a, b in zip(got, want, strict=True) if a != b][:3]
