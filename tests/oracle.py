"""Runs a query and its SQL form on the same tables and compares them."""

from __future__ import annotations

import glob
import math
import os

import duckdb

FOLDER = "/root/testdata/sf0.001"


def connection(folder: str = FOLDER):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def compare(spark, query, sql, folder: str = FOLDER):
    got = query(spark, folder)
    cursor = connection(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, cursor.fetchall())
