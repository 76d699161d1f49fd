"""Order-insensitive comparison of a Spark result with the SQL oracle's."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return bag(df.columns, df.collect())


def oracle_bag(con, sql: str):
    cur = con.execute(sql)
    return bag([d[0] for d in cur.description], cur.fetchall())


def differences(got, want) -> list[str]:
    """Human-readable reasons why two bags differ; empty if they are equal."""
    out = []
    if got[0] != want[0]:
        out.append(f"columns {got[0]} != {want[0]}")
    if got[1] != want[1]:
        more, less = got[1] - want[1], want[1] - got[1]
        out.append(f"{sum(got[1].values())} rows against {sum(want[1].values())}")
        out += [f"only spark: {r}" for r in list(more)[:2]] + [f"only oracle: {r}" for r in list(less)[:2]]
    return out
