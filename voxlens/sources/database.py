"""Database tables over JDBC. Connection data comes from options or the environment."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str | None = None, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **more) -> dict[str, str]:
    """Options of a connection; what is not given is taken from ``VOXLENS_JDBC_*``."""
    given = {"url": url, "user": user, "password": password, "driver": driver}
    found = {k: v or os.environ.get(f"VOXLENS_JDBC_{k.upper()}") for k, v in given.items()}
    if not found["url"]:
        raise ValueError("no JDBC url given and VOXLENS_JDBC_URL not set")
    return {k: str(v) for k, v in {**found, **more}.items() if v is not None}


def partition_options(column: str, lower, upper, parts: int) -> dict[str, str]:
    """Options of a parallel read: the bounds only place the stride, rows beyond them
    are read too."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    return {
        "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def read_jdbc(spark: SparkSession, opts: dict[str, str], table: str, partitioning: dict[str, str] | None = None,
              fetch: int = 10_000) -> DataFrame:
    """Read a table in parallel. Without ``partitioning`` the read is one task, which is
    only right for small tables."""
    reader = spark.read.format("jdbc").options(**opts).option("dbtable", table).option("fetchsize", fetch)
    return reader.options(**(partitioning or {})).load()


def write_jdbc(df: DataFrame, opts: dict[str, str], table: str, mode: str = "append",
               batch: int = 10_000, connections: int | None = None) -> int:
    """Append to a table, or refresh it (truncate, then append). Returns the rows written.

    ``connections`` limits how many tasks write at the same time. A task that is retried
    after an executor loss may add its rows twice; ``publish_jdbc`` is the way to write
    that finds and survives this.
    """
    if mode not in ("append", "refresh"):
        raise ValueError("mode must be 'append' or 'refresh'")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("jdbc").options(**opts)
    writer = writer.option("dbtable", table).option("batchsize", batch)
    if connections:
        writer = writer.option("numPartitions", connections)
    if mode == "refresh":
        writer = writer.mode("overwrite").option("truncate", True)
    else:
        writer = writer.mode("append")
    writer.save()
    return seen.get["n"]


def publish_jdbc(df: DataFrame, opts: dict[str, str], table: str, staging: str, execute, mode: str = "append") -> int:
    """Write to a staging table, check the count, then move the rows in one transaction.

    ``execute`` takes a list of statements and runs them as one transaction on the same
    database. Readers of ``table`` see the old or the new rows, never an empty table, and
    rows doubled by a task retry stop the publication.
    """
    n = write_jdbc(df, opts, staging, "refresh")
    stored = read_jdbc(df.sparkSession, opts, f"(SELECT COUNT(*) AS n FROM {staging}) c").first()["n"]
    if stored != n:
        raise RuntimeError(f"{staging} holds {stored} rows, {n} were sent; nothing was published")
    columns = ", ".join(df.columns)
    statements = [f"DELETE FROM {table}"] if mode == "refresh" else []
    statements.append(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
    execute(statements)
    return n
