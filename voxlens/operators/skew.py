"""Joining and numbering when one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxlens.session import cut

# A key is hot if its rows are more than this part of what one shuffle partition gets on average.
HOT_PART = 0.25


def hot_share(spark: SparkSession) -> float:
    """Share of all rows above which a key is hot: a part of the mean shuffle partition."""
    return HOT_PART / int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_rows(dim: DataFrame, weight: str, share: float | None = None) -> DataFrame:
    """Rows of a key table whose weight (row count on the big side) is above ``share`` of
    all weight, by default ``hot_share``. Their number is below ``1 / share`` whatever the data
    (four per shuffle partition), so the result is small enough to broadcast by construction."""
    total = dim.agg(F.sum(weight)).scalar()
    return dim.where(F.col(weight) > (share or hot_share(dim.sparkSession)) * total)


def join_split(big: DataFrame, dim: DataFrame, key: str, weight: str, share: float | None = None) -> DataFrame:
    """Inner equi-join of ``big`` with a key table holding one row per key. ``dim`` is read
    several times and should be staged.

    ``weight`` is the column of ``dim`` that counts the rows of ``big`` per key. Keys
    above ``share`` meet their rows in place (broadcast of fewer than ``1 / share``
    rows), the others are shuffled: by default none of them has more than a quarter of the
    rows of a mean partition.
    """
    hot = F.broadcast(hot_rows(dim, weight, share))
    cold = big.join(hot.select(key), key, "left_anti").join(dim, key)
    return big.join(hot, key).unionByName(cold)


def number_rows(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """1, 2, 3, ... over the whole table in the given total order, without a single-task
    window: rows are range-sorted, fixed by a checkpoint, and numbered within their
    partition; partition offsets come from one count per partition."""
    placed = cut(df.orderBy(*order)).withColumn("__at", F.monotonically_increasing_id())
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition of the sorted table.
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + within + 1)
        .drop("__part", "__at", "__start")
    )
