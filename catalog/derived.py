"""Tables of the reference's shape, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table


def two_digits(c) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def comments_raw(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    day = F.concat(F.lit("2024-02-"), two_digits(1 + F.col("turn") % 28), F.lit("T10:00:00Z"))
    return c.select(
        F.concat(F.lit("v"), "conv_id").alias("video_id"),
        F.concat(F.lit("conversation "), "conv_id").alias("title"),
        F.concat(F.lit("2024-01-"), two_digits(1 + F.col("conv_id") % 28), F.lit("T08:30:00Z")).alias("publish_date"),
        F.concat(F.lit("channel"), F.col("conv_id") % 5).alias("channel_name"),
        F.col("text").alias("comment"),
        F.length("text").cast("long").alias("like_count"),
        F.when(F.col("turn") % 7 == 3, "yesterday").otherwise(day).alias("comment_publish_date"),
    )


def reviews_raw(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    kind = F.col("doc_id") % 10
    score = F.concat((F.col("n_chars") % 101).cast("string"), F.lit("점"))
    return d.select(
        F.when(kind == 0, "점").when(kind == 1, F.lit(None)).when(kind == 2, "n/a").otherwise(score).alias("scoring"),
        F.col("source").alias("market"),
        F.concat(F.lit("2024-"), two_digits(1 + F.col("doc_id") % 12), F.lit("-15")).alias("purchasing_date"),
        F.concat("lang", F.lit(" "), "source").alias("review_title"),
        F.col("text").alias("review_content"),
        F.col("lang").alias("item"),
    )
