"""Runs a query and its SQL over the same tables, and compares the rows as bags."""

import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata"


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {t} as select * from '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr([plain(r[i]) for i in order]) for r in rows)


def same(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection(sf_dir).execute(sql)
    want = bag([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
