"""Declared schemas of the canonical tables, and the check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COMMENTS_RAW = T.StructType([
    T.StructField("video_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("publish_date", T.StringType()),
    T.StructField("channel_name", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("like_count", T.LongType()),
    T.StructField("comment_publish_date", T.StringType()),
])

REVIEWS_RAW = T.StructType([
    T.StructField("scoring", T.StringType()),
    T.StructField("market", T.StringType()),
    T.StructField("purchasing_date", T.StringType()),
    T.StructField("review_title", T.StringType()),
    T.StructField("review_content", T.StringType()),
    T.StructField("item", T.StringType()),
])

THREAD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("comments", T.ArrayType(T.StructType([
        T.StructField("comment", T.StringType()),
        T.StructField("like_count", T.LongType()),
        T.StructField("published_at", T.StringType()),
    ]))),
    # Of threads that are written in parts: the number of this one and the comments of all.
    T.StructField("part", T.LongType()),
    T.StructField("total", T.LongType()),
])

THREADS = T.StructType([T.StructField("threads", T.MapType(T.StringType(), THREAD))])

KEYWORD_CACHE = T.StructType(
    [T.StructField("hobby", T.StringType())]
    + [T.StructField(f"keyword{i}", T.StringType()) for i in range(1, 6)]
    + [T.StructField("created_at", T.TimestampType())]
)


def conform(df: DataFrame, schema: T.StructType, extra: str = "error") -> DataFrame:
    """Select the declared columns in order; a missing column or another type is an error. So
    is a column that is not declared, unless ``extra`` is ``drop``."""
    if extra not in ("error", "drop"):
        raise ValueError(f"extra: {extra}")
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, found "
        f"{found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in schema.fields
        if found.get(f.name) != f.dataType
    ]
    if extra == "error":
        wrong += [f"{name}: not declared" for name in found if name not in schema.fieldNames()]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select(*schema.fieldNames())
