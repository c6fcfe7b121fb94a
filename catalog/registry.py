"""Collects the queries and the SQL that checks them."""

from __future__ import annotations

from voxlens.sources.files import read_parquet

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


# Tables of whole texts: the work per row is heavy. A session whose files do not split can ask
# for their rows to be dealt out; otherwise they are read as they lie.
TEXTS = {"documents", "pages", "conversations"}
DEAL_OUT = "spark.voxlens.text.partitions"


def table(spark, sf_dir: str, name: str):
    partitions = int(spark.conf.get(DEAL_OUT, "0")) if name in TEXTS else 0
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", partitions=partitions)
