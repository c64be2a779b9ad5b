"""Order-blind comparison of a Spark result with DuckDB's."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float, decimal.Decimal)):
        return f"{float(x):.8g}"
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(plain(y) for y in x) + "]"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


def duck(sf):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def assert_equal(df, sql, sf):
    con = duck(sf)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
