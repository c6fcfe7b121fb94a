"""Lookups as joins, deduplication and unions.

No join here carries a broadcast hint: the planner broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``, otherwise it shuffles
and splits skewed partitions at run time.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.functions.text import without, word_tokens


def semi_match(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Rows of ``a`` whose key occurs in ``b``."""
    keys = [key] if isinstance(key, str) else list(key)
    return a.join(b.select(*keys), keys, "left_semi")


def anti_match(a: DataFrame, b: DataFrame, key) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``."""
    keys = [key] if isinstance(key, str) else list(key)
    return a.join(b.select(*keys), keys, "left_anti")


def lookup(a: DataFrame, dim: DataFrame, key) -> DataFrame:
    """All rows of ``a`` with the columns of the key table, NULL where it has none."""
    return a.join(dim, key, "left")


def remove_words(tokens: DataFrame, words, col: str) -> DataFrame:
    """Drop listed words. A Python list works on a token array column; a DataFrame with
    one column ``word`` works on exploded tokens (one token per row)."""
    if isinstance(words, DataFrame):
        listed = words.select(F.col(words.columns[0]).alias(col))
        return tokens.join(listed, col, "left_anti")
    return tokens.withColumn(col, without(col, words))


def word_table(spark: SparkSession, words) -> DataFrame:
    """A word list as a one-column table. Made from Arrow, so that the planner knows its
    size and can decide on a broadcast before the other side is shuffled (a table made
    from Python rows counts as of unknown size)."""
    return spark.createDataFrame(pa.table({"word": pa.array(list(words), pa.string())}))


def keyword_table(spark: SparkSession, topics: dict[str, list[str]]) -> DataFrame:
    """Dictionary of topic to keywords as a (topic, keyword) table of known size."""
    rows = [(t, k) for t, ks in topics.items() for k in ks]
    return spark.createDataFrame(pa.table({
        "topic": pa.array([t for t, _ in rows], pa.string()),
        "keyword": pa.array([k for _, k in rows], pa.string()),
    }))


def keyword_hits(df: DataFrame, dim: DataFrame, keep: list[str], col: str, min_token_len: int = 2) -> DataFrame:
    """One row per occurrence of a keyword of any number of words: (keep, topic, keyword).

    The keyword table is indexed by first word. Only tokens that begin a keyword pass the first
    join, each with as many of the following tokens as the longest keyword of that word has; they
    are cut to the lengths of its keywords and met by the whole keyword. Texts are cut into
    tokens once, and no text is tested against every keyword.
    """
    named = dim.select("topic", "keyword", F.lower("keyword").alias("__gram")).where("__gram is not null")
    named = named.withColumn("__words", F.split("__gram", " "))
    firsts = named.groupBy(F.element_at("__words", 1).alias("__first")).agg(F.collect_set(F.size("__words")).alias("__lengths"))
    tokens = df.select(*keep, word_tokens(col, min_token_len).alias("__t"))
    begun = tokens.select(*keep, "__t", F.posexplode("__t").alias("__at", "__first")).join(firsts, "__first")
    begun = begun.select(*keep, F.slice("__t", F.col("__at") + 1, F.array_max("__lengths")).alias("__t"), "__lengths")
    sized = begun.select(*keep, "__t", F.explode("__lengths").alias("__n")).where(F.size("__t") >= F.col("__n"))
    grams_ = sized.select(*keep, F.array_join(F.slice("__t", F.lit(1), F.col("__n")), " ").alias("__gram"))
    return grams_.join(named.select("__gram", "topic", "keyword"), "__gram").select(*keep, "topic", "keyword")


def match_keywords(df: DataFrame, dim: DataFrame, key: str, col: str, min_token_len: int = 2) -> DataFrame:
    """Keywords found in each text: (key, topic, keyword, hits), see ``keyword_hits``."""
    found = keyword_hits(df, dim, [key], col, min_token_len)
    return found.groupBy(key, "topic", "keyword").agg(F.count(F.lit(1)).alias("hits"))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column missing in one table is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup(df: DataFrame) -> DataFrame:
    return df.distinct()


def merge_cache(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Known rows stay; of the new rows one per unknown key is added."""
    one = new.groupBy(key).agg(F.min(F.struct(*[c for c in new.columns if c != key])).alias("__r"))
    added = one.select(key, "__r.*")
    return old.unionByName(anti_match(added, old, key))


def merge_words(*lists: DataFrame) -> DataFrame:
    """Several one-column word tables as one flat table without repeats."""
    named = [d.select(F.col(d.columns[0]).alias("word")) for d in lists]
    return union_all(named).distinct()
