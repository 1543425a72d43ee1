"""Rows of Spark and DuckDB in one form."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def same(df, sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    r = con.sql(sql)
    cols = sorted(df.columns)
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    want = sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=repr)
    got = sorted((tuple(map(plain, x)) for x in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    assert len(got) == len(want)
    assert got == want
