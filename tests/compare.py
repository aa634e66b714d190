"""Run registered queries and their SQL side by side and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return _rows(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    left_columns, left = spark_rows(df)
    right_columns, right = sql_rows(con, sql)
    if left_columns != right_columns:
        return f"columns {left_columns} <> {right_columns}"
    if len(left) != len(right):
        return f"rows {len(left)} <> {len(right)}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first:\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    return None
