"""Row filters: DataFrame -> DataFrame, all pushed to the scan where the source can."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlens.functions.text import any_of


def exclude_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is none of the listed ones; a missing value is none of them."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(list(values)))


def published_after(df: DataFrame, col: str, ts) -> DataFrame:
    return df.where(F.col(col) >= ts)


def drop_incomplete(df: DataFrame, cols: list[str] | None = None, how: str = "any") -> DataFrame:
    return df.dropna(how, subset=cols)


def keep_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def contains(df: DataFrame, col: str, word: str) -> DataFrame:
    return df.where(F.col(col).contains(word))


def contains_any(df: DataFrame, col: str, words: list[str]) -> DataFrame:
    return df.where(F.col(col).rlike(any_of(words)))


def keep_text(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def coalesce_tokens(df: DataFrame, col: str) -> DataFrame:
    """A missing token list becomes the empty list."""
    return df.withColumn(col, F.coalesce(F.col(col), F.array().cast("array<string>")))


def valid_links(df: DataFrame, col: str, marker: str) -> DataFrame:
    """Links that lead somewhere and carry the marker."""
    link = F.col(col)
    return df.where((link != "#") & (link != "") & link.contains(marker))
