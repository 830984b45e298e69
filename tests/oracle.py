"""Compare a registered query with its SQL twin: columns by name, rows as multisets."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.10g}")
    if isinstance(value, Decimal):
        return ("decimal", value)
    if isinstance(value, (dt.date, dt.datetime)):
        return ("time", value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_bag(df):
    return _bag(df.columns, [tuple(r) for r in df.collect()])


def sql_bag(con, sql):
    cur = con.execute(sql)
    return _bag([c[0] for c in cur.description], cur.fetchall())


def difference(got, want):
    """None when equal, else a short text."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return None
    extra, missing = got[1] - want[1], want[1] - got[1]
    return (
        f"rows {sum(got[1].values())} vs {sum(want[1].values())}; extra {sum(extra.values())} {list(extra)[:2]}; "
        f"missing {sum(missing.values())} {list(missing)[:2]}"
    )
