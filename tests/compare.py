"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(found, key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = fn(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            return f"row {str(g)[:300]} against {str(w)[:300]}"
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    kinds = {d[0]: str(d[1]) for d in cur.description}
    for name, kind in df.dtypes:
        if kind in types and kinds[name] not in (types[kind], "NULL"):
            return f"type of {name}: {kind} against {kinds[name]}"
    return None
