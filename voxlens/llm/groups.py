"""Group minima under skew, and connected components of a link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlens.session import stage

SALTS = 32


def with_group(df: DataFrame, keys: list[str], member: Column, spread: Column, salts: int = SALTS) -> DataFrame:
    """``df`` plus ``__first`` (least ``member`` of the rows with equal keys) and ``__size``
    (their number). Keys must not be null.

    Rows of one key are dealt over ``salts`` parts by the hash of ``spread``. Each part is
    combined on its own, a key is at most ``salts`` rows when the parts meet, and the result
    goes back to the rows part by part, so a key that holds a third of all rows is handled
    by ``salts`` tasks.
    """
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    parts = salted.groupBy(*keys, "__salt").agg(F.min(member).alias("__first"), F.count(F.lit(1)).alias("__size"))
    whole = parts.groupBy(*keys).agg(
        F.min("__first").alias("__first"), F.sum("__size").alias("__size"), F.collect_list("__salt").alias("__salts")
    )
    whole = whole.select(*keys, "__first", "__size", F.explode("__salts").alias("__salt"))
    return salted.join(whole, [*keys, "__salt"]).drop("__salt")


def join_salted(df: DataFrame, dim: DataFrame, keys: list[str], spread: Column, salts: int = SALTS) -> DataFrame:
    """Inner join of ``df`` with a table holding few rows per key, safe for hot keys: a key's
    rows are dealt over ``salts`` parts, and the key's row goes to the parts that exist."""
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    wanted = salted.select(*keys, "__salt").distinct().join(dim, keys)
    return salted.join(wanted, [*keys, "__salt"]).drop("__salt")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _star(rows: DataFrame) -> DataFrame:
    """Every neighbour v of u, and u itself, is linked with the least of them."""
    near = with_group(rows, ["u"], F.col("v"), F.col("v"))
    near = near.withColumn("m", F.least("u", "__first"))
    edges = near.select("m", "v").union(near.select("m", F.col("u").alias("v")))
    return edges.where("m <> v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the least node
    reachable. Nodes without a link are not in the result.

    Alternates large-star (every larger neighbour moves to the least of the neighbourhood)
    and small-star (so do the smaller neighbours) until all edges are stars; each round is
    written to the shared folder, so its plan stays short and a lost executor costs one round.
    Edges that repeat or link a node with itself change nothing.
    """
    links = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    edges = links.where("a <> b")
    seen = None
    while True:
        rows = _both_ways(edges)
        near = with_group(rows, ["u"], F.col("v"), F.col("v"))
        moved = near.where("v > u").select(F.least("u", "__first").alias("a"), F.col("v").alias("b"))
        moved = moved.where("a <> b").distinct()
        edges = stage(_star(moved.select(F.col("b").alias("u"), F.col("a").alias("v"))), "links")
        found = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if seen == found:
            break
        seen = found
    return (
        nodes.join(edges.select(F.col("b").alias("node"), F.col("a").alias("component")), "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"))
    )
