"""Rows of a Spark query and of its DuckDB equivalent, in one comparable form."""

import datetime
import decimal
import glob
import os

import duckdb


def normal(v):
    if isinstance(v, decimal.Decimal):
        v = float(v) if v != int(v) else int(v)
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def duck_rows(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(([normal(r[i]) for i in order] for r in found.fetchall()), key=str)


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted(([normal(r[n]) for n in names] for r in frame.collect()), key=str)
