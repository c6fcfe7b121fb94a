"""Sorting, limits, ranking per group and sampling."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, key, ts: str) -> DataFrame:
    """One row per key, the one with the largest time (then the largest other columns).
    An aggregate, so a hot key is reduced before the shuffle. Rows without a time lose
    against rows with one."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != ts]
    newest = df.groupBy(*keys).agg(F.max(F.struct(ts, *rest)).alias("__r"))
    return newest.select(*keys, "__r.*").select(*df.columns)


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rank",
                  slices: int | None = None) -> DataFrame:
    """First ``n`` rows of each group in the given total order, with their rank.

    Each group is first cut within hashed slices, as many as there are shuffle partitions
    unless given, so that a hot group never meets one task whole, whatever ``n`` is."""
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn("__s", F.pmod(F.xxhash64(*df.columns), F.lit(slices)))
    part = Window.partitionBy(*keys, "__s").orderBy(*order)
    df = sliced.withColumn(name, F.row_number().over(part)).where(F.col(name) <= n).drop("__s", name)
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(ranked)).where(F.col(name) <= n)


def rank_slice(df: DataFrame, order: list[Column], skip: int, take: int, by: list[str] = ()) -> DataFrame:
    """Skip the first rows and take the next ones, over all rows or per group."""
    if not by:
        return df.orderBy(*order).offset(skip).limit(take)
    return top_per_group(df, list(by), order, skip + take, "__k").where(F.col("__k") > skip).drop("__k")


def content_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def sort(df: DataFrame, *cols) -> DataFrame:
    """Rows in the given order. Equal rows of the order follow by content, so that the
    range partitioner can cut a value that very many rows share."""
    return df.orderBy(*cols, content_hash(df))


def extreme_text(df: DataFrame, col: str, n: int, key: str, longest: bool = True) -> DataFrame:
    """Longest or shortest texts, ties by key."""
    sized = df.where(F.col(col).isNotNull()).withColumn("length", F.length(col))
    first = F.desc("length") if longest else F.asc("length")
    return sized.orderBy(first, key).limit(n)


def top_n(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(col), tie).limit(n)


def preview(df: DataFrame, n: int, *order) -> DataFrame:
    """First rows in a stated order (pass descending columns for the tail)."""
    return df.orderBy(*order).limit(n)


def unit_interval(key, seed: int) -> Column:
    """A stable number in [0, 1) for each key: the same row gets the same number in any
    run, on any partitioning and after any task retry."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def sample(df: DataFrame, fraction: float, seed: int = 42, key: str | None = None) -> DataFrame:
    """Fraction sample. With a key the choice depends on the key alone."""
    if key is None:
        return df.sample(fraction, seed)
    return df.where(unit_interval(key, seed) < fraction)


def split(df: DataFrame, weights: list[float], seed: int = 42, key: str | None = None) -> list[DataFrame]:
    """Disjoint parts that together hold every row, sized by weight. With a key the
    parts are stable and rows of one key stay together."""
    if key is None:
        return df.randomSplit(weights, seed)
    total = sum(weights)
    bounds = [0.0, *(w / total for w in accumulate(weights))]
    bounds[-1] = 2.0
    at = unit_interval(key, seed)
    return [df.where((at >= lo) & (at < hi)) for lo, hi in zip(bounds, bounds[1:])]


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)
