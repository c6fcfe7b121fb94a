"""Composed jobs. A sink is any function from DataFrame to the number of rows it stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens import schemas, wordlists
from voxlens.functions.text import (
    classify_brand,
    clean_comment,
    clean_review,
    lexicon_sentiment,
    min_length,
    without,
    word_tokens,
    words,
)
from voxlens.operators import aggregate, filters, lookup, models, ranking, reshape
from voxlens.session import stage
from voxlens.sources import database, files

Sink = Callable[[DataFrame], int]


def landing_sink(path: str) -> Sink:
    return lambda df: files.refresh_landing(df, path)


def table_sink(opts: dict[str, str], table: str, staging: str, execute) -> Sink:
    return lambda df: database.publish_jdbc(df, opts, table, staging, execute, mode="refresh")


def clean_comments(raw: DataFrame) -> DataFrame:
    """Both dates parsed from their own text, incomplete rows and copies dropped."""
    parsed = reshape.parse_timestamps(raw, ["publish_date", "comment_publish_date"])
    return lookup.dedup(filters.drop_incomplete(parsed))


def comment_etl(spark: SparkSession, src, sink: Sink) -> int:
    """Landed comments to the served table."""
    return sink(clean_comments(files.read_parquet(spark, src, schemas.COMMENTS_RAW)))


def _parsed_reviews(raw: DataFrame) -> DataFrame:
    parsed = reshape.parse_score(raw, "scoring", to="int")
    return reshape.parse_dates(parsed, ["purchasing_date"])


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Score and date as values, incomplete rows and copies dropped; ``rejected_reviews``
    has the dropped ones."""
    return lookup.dedup(filters.drop_incomplete(_parsed_reviews(raw)))


def rejected_reviews(raw: DataFrame) -> DataFrame:
    """The raw rows that ``clean_reviews`` leaves out as incomplete, with the columns that
    are missing or unreadable as ``reason``."""
    as_read = F.struct(*[F.col(c) for c in raw.columns]).alias("__raw")
    parsed = _parsed_reviews(raw.withColumn("__raw", as_read))
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in raw.columns]))
    return parsed.where(F.size(missing) > 0).select("__raw.*", F.array_join(missing, ", ").alias("reason"))


def review_etl(spark: SparkSession, src, sink: Sink) -> int:
    """Landed reviews to the served table."""
    return sink(clean_reviews(files.read_parquet(spark, src, schemas.REVIEWS_RAW)))


def ingest_threads(spark: SparkSession, src: str, sink: Sink, published_after: str,
                   excluded=wordlists.EXCLUDED_CHANNELS, multiline: bool = False) -> int:
    """Thread files to flat landed comments of wanted channels and dates."""
    flat = reshape.flatten_threads(files.read_threads(spark, src, multiline))
    kept = filters.exclude_values(flat, "channel_name", list(excluded))
    kept = filters.published_after(kept, "publish_date", published_after)
    return sink(reshape.fill_blank(kept, ["title", "channel_name", "comment"]))


def corpus_profile(df: DataFrame, text: str, score: str, ts: str, key: str, bins: int = 30) -> dict[str, DataFrame]:
    """The reports of a corpus; every report is lazy."""
    return {
        "profile": aggregate.profile(df.select(key, score, F.length(text).alias("text_length"))),
        "per_day": aggregate.count_by_day(df, ts),
        "per_month": aggregate.count_by_month(df, ts),
        "scores": aggregate.value_counts(df, score),
        "lengths": aggregate.histogram(df, F.length(text), bins),
        "longest": ranking.extreme_text(df, text, 1, key),
        "shortest": ranking.extreme_text(df, text, 1, key, longest=False),
    }


def sentiment_words(df: DataFrame, item: str, text: str, positive=wordlists.POSITIVE_WORDS,
                    negative=wordlists.NEGATIVE_WORDS, stop=wordlists.REVIEW_STOPWORDS, n: int = 30,
                    exclude=()) -> DataFrame:
    """Most frequent words of positive and of negative texts per item."""
    tokens = min_length(without(words(clean_review(text)), stop), 1)
    scored = df.select(item, tokens.alias("tokens")).withColumn(
        "sentiment", lexicon_sentiment("tokens", positive, negative)
    )
    # Neutral texts lose their words here instead of by a filter, which would be moved
    # below the projection and clean every text a second time.
    polar = scored.withColumn("tokens", F.when(F.col("sentiment") != "neutral", F.col("tokens")))
    return aggregate.word_counts_by(polar, "tokens", [item, "sentiment"], n, exclude)


def brand_report(df: DataFrame, text: str, first, second, dim: DataFrame, stop=(), n: int = 10) -> dict[str, DataFrame]:
    """Shares of the brands, their most frequent words and the keyword hits per brand. The
    distinct texts are staged once for all reports."""
    rows = stage(lookup.dedup(df.select(text)), "distinct_texts")
    branded = rows.withColumn("brand", classify_brand(text, first, second))
    tokens = branded.select("brand", without(word_tokens(clean_comment(text)), stop).alias("tokens"))
    named = tokens.where(F.col("brand").isin(first[0], second[0]))
    found = lookup.keyword_hits(branded.where(F.col("brand").isin(first[0], second[0])), dim, ["brand"], text)
    return {
        "shares": aggregate.class_share(branded, "brand"),
        "words": aggregate.word_counts_by(named, "tokens", ["brand"], n),
        "keywords": aggregate.count_by(found, ["brand", "topic", "keyword"]),
    }


def cluster_corpus(df: DataFrame, key: str, text: str, k: int = 2, seed: int = 42, ks=range(2, 10),
                   judged=range(2, 6), **vectors) -> dict:
    """TF-IDF clusters with sizes, members, cost and silhouette per k, the fits and the sparse rows
    they are of. Every k is fitted once, all of them in the same scans over rows that are written once."""
    vectors = models.text_vectors(df.select(key, text), text, keep=[key], **vectors).select(key, "tfidf_features")
    rows, fits = models.fit_clusters(vectors, {k, *ks, *judged}, seed)
    clustered = stage(models.assign(rows, fits[k], "cluster"), "clusters")
    return {
        "vectors": rows,
        "fits": fits,
        "clusters": clustered,
        "sizes": models.cluster_sizes(clustered),
        "elbow": models.cost_table(df.sparkSession, {i: fits[i] for i in ks}),
        "silhouette": models.silhouette_table(rows, {i: fits[i] for i in judged}),
    }


def score_report(df: DataFrame, item: str, score: str, suffix: str = "점") -> DataFrame:
    """Mean and maximum score per item, and over all (item NULL)."""
    parsed = reshape.parse_score(df.select(item, score), score, suffix)
    return parsed.where(F.col(score).isNotNull()).rollup(item).agg(
        F.grouping(item).alias("is_total"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score")
    )
