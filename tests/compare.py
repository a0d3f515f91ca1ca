"""Rows of a Spark query against those of its SQL."""

from __future__ import annotations

import math
import os

import duckdb


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return round(float(x), 6)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


def same(df, sql, data):
    r = connect(data).execute(sql)
    columns = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, r.fetchall())
