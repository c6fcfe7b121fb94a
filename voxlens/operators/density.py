"""Density clusters of low-dimensional points by grid cells, and connected components.

Points are counted per grid cell. Cells with enough points are dense; dense cells that touch
(also at a corner) are one cluster; other cells join the fullest dense cell they touch, and the
rest is noise. After the count only cells move, never points.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlens.session import discard, stage
from voxlens.operators.skew import number_rows

#: Each further dimension triples the cells that touch one.
MAX_DIMS = 6
NOISE = -1


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): the least node that can be reached over ``links`` (a, b), itself included.

    Every round takes the least label among the neighbours and then the label of that label, so
    chains shorten by more than half. Rounds are staged, the one before is removed.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "touching")
    labels = stage(nodes.select("node", F.col("node").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        taken = stage(labels.join(near, "node", "left").select(
            "node", F.coalesce(F.least("label", "near"), F.col("label")).alias("label"), F.col("label").alias("was")), "labels")
        jump = taken.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stage(taken.join(jump, "label").select("node", F.col("next").alias("label"), "was"), "labels")
        changed = jumped.where("label <> was").limit(1).count()
        discard(taken)
        discard(labels)
        labels = jumped
        if not changed:
            discard(both)
            return labels.select("node", "label")


def cell_of(point: Column, width: float) -> Column:
    return F.transform(point, lambda x: F.floor(x / width).cast("int"))


def touching(cells: DataFrame, dims: int) -> DataFrame:
    """(cell, near) for every cell and each place that touches it."""
    if dims > MAX_DIMS:
        raise ValueError(f"more than {MAX_DIMS} dimensions")
    offsets = [o for o in product((-1, 0, 1), repeat=dims) if any(o)]
    steps = F.array(*[F.array(*[F.lit(x) for x in o]) for o in offsets])
    moved = cells.select("cell", F.explode(steps).alias("step"))
    return moved.select("cell", F.zip_with("cell", "step", lambda a, b: a + b).alias("near"))


def cell_clusters(cells: DataFrame, dims: int, min_cell: int) -> DataFrame:
    """(cell, component) of the cells (cell, n) that belong to a cluster; a component is the least
    of its dense cells."""
    dense = stage(cells.where(F.col("n") >= min_cell).select("cell", "n"), "dense")
    near = touching(dense.select("cell"), dims)
    links = near.join(dense.select(F.col("cell").alias("near")), "near").where("cell < near")
    labels = stage(connected(dense.select(F.col("cell").alias("node")), links.select(F.col("cell").alias("a"), F.col("near").alias("b")))
                   .select(F.col("node").alias("cell"), F.col("label").alias("component")), "dense_labels")
    offers = near.join(dense.join(labels, "cell"), "cell").groupBy(F.col("near").alias("cell")).agg(
        F.max_by("component", F.struct("n", "component")).alias("component"))
    thin = cells.where(F.col("n") < min_cell).select("cell").join(offers, "cell")
    return labels.unionByName(thin)


def density_clusters(points: DataFrame, col: str, width: float, min_cell: int = 4, min_size: int = 10,
                     out: str = "cluster") -> DataFrame:
    """``points`` with a cluster number, 0 for the largest, or -1 for noise, clusters of fewer
    than ``min_size`` points and rows without a point. ``col`` is an array of at most six numbers,
    ``width`` that of a cell, ``min_cell`` the points that make it dense."""
    placed = points.withColumn("__cell", cell_of(F.col(col), width))
    known = placed.where(F.col("__cell").isNotNull())
    cells = stage(known.groupBy(F.col("__cell").alias("cell")).agg(F.count(F.lit(1)).alias("n")), "cells")
    first = cells.select(F.size("cell")).first()
    found = cell_clusters(cells, first[0] if first else 1, min_cell)
    found = stage(found, "cell_clusters")
    sizes = found.join(cells, "cell").groupBy("component").agg(F.sum("n").alias("size")).where(F.col("size") >= min_size)
    numbers = number_rows(sizes, [F.desc("size"), F.asc("component")], "__no")
    named = found.join(numbers, "component").select(F.col("cell").alias("__cell"), (F.col("__no") - 1).cast("int").alias(out))
    return placed.join(named, "__cell", "left").withColumn(out, F.coalesce(out, F.lit(NOISE))).drop("__cell")
