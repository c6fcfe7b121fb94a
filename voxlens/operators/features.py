"""Text features. The long form (one row per document and term) is the plain SQL form;
vector forms use Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from voxlens.functions.text import grams, without, word_tokens
from voxlens.operators.aggregate import _rows, word_counts, word_rows
from voxlens.operators.ranking import top_per_group
from voxlens.operators.skew import hot_rows, join_split, number_rows
from voxlens.session import stage

#: Characters that a tokenizer gets at once: its lists take many times their memory.
CHARACTERS = 1 << 20


def tokenize(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    """Lower-case and cut at single white-space characters."""
    return Tokenizer(inputCol=col, outputCol=out).transform(df)


def remove_stopwords(df: DataFrame, col: str, words: list[str] | None = None, out: str = "filtered_words") -> DataFrame:
    """Default English list, or an own one; case does not matter."""
    remover = StopWordsRemover(inputCol=col, outputCol=out, locale="en_US")
    return (remover if words is None else remover.setStopWords(list(words))).transform(df)


def count_vectors(df: DataFrame, col: str = "filtered_words", out: str = "features",
                  min_df: float = 1.0):
    """Term count vectors and the fitted vocabulary model, which has every term. The model is
    on the driver; ``count_arrays`` has no such limit."""
    terms = max(1, word_rows(df, col).select("word").distinct().count())
    model = CountVectorizer(inputCol=col, outputCol=out, vocabSize=terms, minDF=min_df).fit(df)
    return model.transform(df), model


def count_arrays(df: DataFrame, key: str, col: str) -> tuple[DataFrame, DataFrame]:
    """Count vectors without a vocabulary on the driver: (key, entries), entries being the
    (idx, tf) of a document by index, and the table (token, idx, n) of all terms."""
    counts = stage(term_counts(df, key, col), "term_counts")
    totals = counts.groupBy("term").agg(F.sum("tf").alias("n"))
    index = number_rows(totals, [F.desc("n"), F.asc("term")], "rank").select(
        F.col("term").alias("token"), (F.col("rank") - 1).alias("idx"), "n"
    )
    index = stage(index, "term_index")
    held = counts.groupBy("term").agg(_rows().alias("df"))
    dim = held.join(index.withColumnRenamed("token", "term"), "term").select("term", "idx", "df")
    met = join_split(counts, stage(dim, "term_index"), "term", "df")
    entries = met.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("idx", "tf"))).alias("entries"))
    return entries, index


def tfidf_vectors(df: DataFrame, col: str = "features", out: str = "tfidf_features") -> DataFrame:
    return IDF(inputCol=col, outputCol=out).fit(df).transform(df)


def term_counts(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """Long form of count vectors: (key, term, tf)."""
    return (
        word_rows(df, tokens, [key]).withColumnRenamed("word", "term")
        .groupBy(key, "term").agg(_rows().alias("tf"))
    )


def document_frequency(counts: DataFrame) -> DataFrame:
    """Documents per term: (term, df)."""
    return counts.groupBy("term").agg(_rows().alias("df"))


def with_frequency(counts: DataFrame) -> DataFrame:
    """Staged term counts with the ``df`` of their term. The frequencies are aggregated once and
    staged: hot terms, their total and the cold side read them from there."""
    return join_split(counts, stage(document_frequency(counts), "term_frequency"), "term", "df")


def idf_weights(counts: DataFrame, n_docs: int | DataFrame, key: str) -> DataFrame:
    """``tf * ln((n + 1) / (df + 1))`` in long form. ``n_docs`` counts all documents, also
    those without a term. The counts are staged, so the texts are cut into terms once; terms
    found nearly everywhere do not gather in one task."""
    n = n_docs.agg(_rows()).scalar() if isinstance(n_docs, DataFrame) else F.lit(n_docs)
    counts = stage(counts, "term_counts")
    joined = with_frequency(counts)
    weight = F.col("tf") * F.log((n + 1) / (F.col("df") + 1))
    return joined.select(key, "term", "tf", "df", weight.alias("weight"))


def vocabulary(df: DataFrame, col: str, n: int) -> DataFrame:
    """Most frequent terms, ties by term."""
    return word_counts(df, col, n)


def vocabulary_index(df: DataFrame, col: str) -> DataFrame:
    """(token, idx, n): index by frequency rank, 0 and 1 left free for padding and unknown."""
    counts = word_rows(df, col).groupBy("word").agg(_rows().alias("n")).withColumnRenamed("word", "token")
    ranked = number_rows(counts, [F.desc("n"), F.asc("token")], "rank")
    return ranked.select("token", (F.col("rank") + 1).alias("idx"), "n")


PAD, UNKNOWN = 0, 1


def encode_tokens(df: DataFrame, key: str, col: str, vocab: DataFrame, max_len: int = 10) -> DataFrame:
    """(key, encoded): token indexes cut or padded to ``max_len``; unknown tokens get 1.
    Only the first ``max_len`` tokens can appear, so lists are cut before they are joined."""
    head = df.select(key, F.posexplode_outer(F.slice(col, 1, max_len)).alias("pos", "token"))
    hot = F.broadcast(hot_rows(vocab, "n").select("token", F.col("idx").alias("hot_idx")))
    placed = head.join(hot, "token", "left")
    in_place = placed.where("hot_idx is not null or token is null").select(key, "pos", F.col("hot_idx").alias("idx"))
    looked_up = placed.where("hot_idx is null and token is not null").join(
        vocab.select("token", "idx"), "token", "left"
    ).select(key, "pos", F.coalesce("idx", F.lit(UNKNOWN)).alias("idx"))
    rows = in_place.unionByName(looked_up)
    lists = rows.groupBy(key).agg(F.sort_array(F.collect_list(
        F.when(F.col("pos").isNotNull(), F.struct("pos", "idx"))
    )).alias("l"))
    ids = F.transform("l", lambda x: x["idx"].cast("long"))
    fill = F.array_repeat(F.lit(PAD).cast("long"), F.lit(max_len) - F.size("l"))
    return lists.select(key, F.concat(ids, fill).alias("encoded"))


def tfidf_l2(counts: DataFrame, n_docs: int | DataFrame, key: str) -> DataFrame:
    """``tf * (ln((1 + n) / (1 + df)) + 1)``, each document scaled to length one. The
    window per document holds the terms of one text only."""
    n = n_docs.agg(_rows()).scalar() if isinstance(n_docs, DataFrame) else F.lit(n_docs)
    counts = stage(counts, "term_counts")
    raw = with_frequency(counts).select(
        key, "term", (F.col("tf") * (F.log((n + 1) / (F.col("df") + 1)) + 1)).alias("w")
    )
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("w") / length).alias("weight"))


def mean_tfidf(df: DataFrame, key: str, col: str, n: int, by: str | None = None, min_token_len: int = 2) -> DataFrame:
    """Mean TF-IDF weight per term over all documents, top ``n``. With ``by`` every group
    is a corpus of its own."""
    tokens = df.select(key, *([by] if by else []), word_tokens(col, min_token_len).alias("t"))
    if by is None:
        weights = tfidf_l2(term_counts(tokens, key, "t"), df, key)
        total = df.agg(_rows()).scalar()
        mean = weights.groupBy("term").agg((F.sum("weight") / total).alias("mean_weight"))
        return mean.orderBy(F.desc("mean_weight"), "term").limit(n)
    counts = stage(word_rows(tokens, "t", [by, key]).groupBy(by, key, "word").agg(_rows().alias("tf")), "term_counts")
    dfs = counts.groupBy(by, "word").agg(_rows().alias("df"))
    sizes = df.groupBy(by).agg(_rows().alias("n_docs"))
    # Group and word form one key; a word of every document of a large group is hot.
    pair = F.struct(by, "word")
    terms = stage(dfs.join(sizes, by).select(pair.alias("pair"), "df", "n_docs"), "term_frequency")
    raw = join_split(counts.select(key, pair.alias("pair"), "tf"), terms, "pair", "df").select(
        key, "pair", "n_docs",
        (F.col("tf") * (F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1)).alias("w"),
    )
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(F.col(f"pair.{by}"), key)))
    mean = raw.withColumn("w", F.col("w") / length).groupBy("pair", "n_docs").agg(F.sum("w").alias("w"))
    mean = mean.select("pair.*", (F.col("w") / F.col("n_docs")).alias("mean_weight"))
    mean = mean.withColumnRenamed("word", "term")
    return top_per_group(mean, [by], [F.desc("mean_weight"), F.asc("term")], n)


def ngrams(df: DataFrame, col: str, n: int = 2, min_token_len: int = 2) -> DataFrame:
    """Counts of 1..n grams of the corpus."""
    tokens = df.select(word_tokens(col, min_token_len).alias("t"))
    every = tokens.select(F.explode(F.concat(*[grams("t", i) for i in range(1, n + 1)])).alias("gram"))
    return every.groupBy("gram").agg(_rows().alias("n"))


def class_tfidf(df: DataFrame, cls: str, col: str, n: int) -> DataFrame:
    """Top words per class by ``tf * ln(1 + A / f)``: tf is the count in the class, f the
    count over all classes, A the mean number of words per class."""
    counts = word_rows(df, col, [cls]).groupBy(cls, "word").agg(_rows().alias("tf"))
    overall = counts.groupBy("word").agg(F.sum("tf").alias("f"))
    mean = counts.groupBy(cls).agg(F.sum("tf").alias("s")).agg(F.avg("s")).scalar()
    weighted = counts.join(overall, "word").select(
        cls, "word", (F.col("tf") * F.log(1 + mean / F.col("f"))).alias("weight")
    )
    return top_per_group(weighted, [cls], [F.desc("weight"), F.asc("word")], n)


def extract_terms(df: DataFrame, col: str, stop=(), tokenizer: Callable[[pd.Series], pd.Series] | None = None,
                  out: str = "terms") -> DataFrame:
    """Token list per text without stop words. The default takes words of two and more
    characters in the JVM; a ``tokenizer`` (text series to list series, such as a noun
    extractor) runs in Arrow batches, on parts of about CHARACTERS characters of them."""
    if tokenizer is None:
        tokens = word_tokens(col)
    else:
        @F.pandas_udf(T.ArrayType(T.StringType()))
        def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in texts:
                ends = batch.str.len().fillna(0).cumsum().to_numpy()
                at = 0
                while at < len(batch):
                    stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARACTERS, "right")))
                    yield tokenizer(batch.iloc[at:stop])
                    at = stop

        tokens = run(col)
    return df.withColumn(out, tokens).withColumn(out, without(F.coalesce(out, F.array().cast("array<string>")), stop))
