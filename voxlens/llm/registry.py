"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function under a name, with its SQL."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
