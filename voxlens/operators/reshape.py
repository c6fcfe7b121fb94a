"""Projection, parsing and reshaping: DataFrame -> DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlens.functions.arrays import each
from voxlens.functions.text import drop_special, has_special

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def flatten_threads(df: DataFrame, col: str = "threads") -> DataFrame:
    """Thread documents (map of video to thread) to one row per comment."""
    videos = df.select(F.explode(each(col)).alias("video_id", "thread"))
    comments = videos.select("video_id", "thread", F.explode(each("thread.comments")).alias("c"))
    return comments.select(
        "video_id",
        F.col("thread.title").alias("title"),
        F.col("thread.published_at").alias("publish_date"),
        F.col("thread.channel_title").alias("channel_name"),
        F.col("c.comment").alias("comment"),
        F.col("c.like_count").alias("like_count"),
        F.col("c.published_at").alias("comment_publish_date"),
    )


def project_fields(df: DataFrame, mapping: dict[str, str], json_col: str | None = None, keep: list[str] = ()) -> DataFrame:
    """Pick nested fields by path and name them. With ``json_col`` the paths are looked
    up in that JSON text column, otherwise in struct columns."""
    if json_col is None:
        return df.select(*keep, *[F.col(path).alias(name) for name, path in mapping.items()])
    return df.select(*keep, *[
        F.get_json_object(json_col, f"$.{path}").alias(name) for name, path in mapping.items()
    ])


def parse_timestamps(df: DataFrame, cols: list[str], fmt: str = ISO_FORMAT) -> DataFrame:
    """ISO text to timestamp, each column from itself; malformed text gives NULL."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in cols})


# Dates as the review pages and tables write them.
DATE_FORMATS = ("yyyy.MM.dd.", "yyyy.MM.dd", "yyyy/MM/dd")


def parse_dates(df: DataFrame, cols: list[str], formats=DATE_FORMATS) -> DataFrame:
    """Date text to timestamp: what a cast reads, else the first format that fits; malformed
    text gives NULL."""
    return df.withColumns({
        c: F.coalesce(F.col(c).try_cast("timestamp"), *[F.try_to_timestamp(F.col(c), F.lit(f)) for f in formats])
        for c in cols
    })


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast; a value that does not fit gives NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def parse_score(df: DataFrame, col: str, suffix: str = "점", to: str = "double") -> DataFrame:
    """Score text such as ``100점`` to a number; anything else gives NULL."""
    return df.withColumn(col, F.trim(F.replace(F.col(col), F.lit(suffix), F.lit(""))).try_cast(to))


def reorder(df: DataFrame, cols: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Keep the listed columns in this order, then rename."""
    return df.select(*cols).withColumnsRenamed(rename or {})


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def zip_fields(df: DataFrame, cols: list[str], keep: list[str] = ()) -> DataFrame:
    """Parallel field lists to rows, cut to the shortest list."""
    shortest = F.least(*[F.size(c) for c in cols]) if len(cols) > 1 else F.size(cols[0])
    # No list: NULL, an empty list: nothing to slice; neither gives a row.
    even = df.select(*keep, *[F.slice(F.col(c), F.lit(1), shortest).alias(c) for c in cols])
    return even.select(*keep, F.inline(F.arrays_zip(*cols)))


def tag_item(df: DataFrame, title_col: str, targets: list[str], name: str = "item") -> DataFrame:
    """First target found in the title; NULL when none is."""
    found = reduce(
        lambda acc, t: acc.when(F.col(title_col).contains(t), t),
        targets[1:],
        F.when(F.col(title_col).contains(targets[0]), targets[0]),
    )
    return df.withColumn(name, found)


def fill_blank(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing text becomes ''."""
    return df.fillna("", subset=cols)


def blank_as_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """The way back: '' becomes NULL, so that incomplete rows can be dropped."""
    return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in cols})


def stamp(df: DataFrame, name: str, ts) -> DataFrame:
    """Load time of the row; the time is passed in, so a rerun gives the same rows."""
    return df.withColumn(name, F.lit(ts).cast("timestamp"))


def flag_special(df: DataFrame, cols: list[str]) -> DataFrame:
    """One flag per column: does the value hold a special character."""
    return df.withColumns({f"{c}_specials": has_special(c) for c in cols})


def clean_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Remove special characters from every column, each read as text."""
    return df.withColumns({c: drop_special(c) for c in (cols or df.columns)})


def row_struct(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])
