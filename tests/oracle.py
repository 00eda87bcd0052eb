"""Run a registered query on Spark and its SQL on DuckDB, and compare row by row."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def difference(spark_df, con, sql: str) -> str | None:
    """None if both give the same columns and the same rows, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    order = sorted(names)
    at = [names.index(c) for c in order]
    expected = Counter(tuple(_cell(r[i]) for i in at) for r in cursor.fetchall())
    got = Counter(tuple(_cell(r[c]) for c in order) for r in spark_df.collect())
    kinds = lambda rows: {c: {_kind(r[i]) for r in rows if r[i] is not None} for i, c in enumerate(order)}
    if expected == got:
        a, b = kinds(expected), kinds(got)
        return None if a == b else f"types differ: {[(c, a[c], b[c]) for c in order if a[c] != b[c]]}"
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; {order}\n"
        f" missing {list(missing)[:3]}\n extra   {list(extra)[:3]}"
    )
