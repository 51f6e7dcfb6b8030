"""Runs a registered query beside its SQL and compares whole results."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS FROM read_parquet('{path}')")
    return con


def plain(value):
    """One spelling for a value whichever engine it comes from; types stay apart."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return value


def rows(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(record[i]) for i in order) for record in records]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return rows([d[0] for d in result.description], result.fetchall())
