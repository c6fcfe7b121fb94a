"""Scoring rows with a model passed in as a function over pandas batches, and the keyword
table that is filled by a generator.

No model is shipped. The built-in scorers are plain word rules that stand in for one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.functions.answers import (
    build_prompt,
    gather_keywords,
    last_line,
    parse_flag,
    parse_keywords,
    spread_keywords,
    valid_keywords,
)
from voxlens.functions.text import any_of, lexicon_score, word_tokens
from voxlens.operators.lookup import anti_match, lookup, merge_cache
from voxlens.operators.ranking import latest_per_key
from voxlens.schemas import KEYWORD_CACHE
from voxlens.session import cut
from voxlens.wordlists import NEGATIVE_WORDS, POSITIVE_WORDS

SCORE = T.StructType([T.StructField("label", T.StringType()), T.StructField("confidence", T.DoubleType())])


def score_text(df: DataFrame, col: str, scorer: Callable[[pd.Series], pd.DataFrame] | None = None, out: str = "score",
               positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS) -> DataFrame:
    """Label and confidence in one struct, so the model runs once per row. The default is a
    word rule in the JVM; a ``scorer`` takes a text batch and returns columns ``label`` and
    ``confidence``."""
    if scorer is None:
        return df.withColumn(out, lexicon_score(col, positive, negative))

    @F.pandas_udf(SCORE)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield scorer(batch)[["label", "confidence"]]

    return df.withColumn(out, run(F.col(col)))


def score_relevance(df: DataFrame, col: str, load: Callable[[], Callable[[pd.Series], pd.Series]] | None = None,
                    out: str = "relevant", words=()) -> DataFrame:
    """1 / 0 from the answer of a model, or by default whether any of ``words`` occurs. ``load``
    is called once per task and returns the function from text batch to answer batch."""
    if load is None:
        found = F.coalesce(F.col(col).rlike(any_of(list(words))), F.lit(False))
        return df.withColumn(out, found.cast("int"))

    @F.pandas_udf(T.StringType())
    def ask(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        answer = load()
        for batch in texts:
            yield answer(batch)

    return df.withColumn(out, parse_flag(ask(F.col(col))))


def embed(df: DataFrame, col: str, encoder: Callable[[pd.Series], list] | None = None, dims: int = 64,
          out: str = "embedding") -> DataFrame:
    """Text to a float array. The default is a hashed bag of words of unit length, made in
    the JVM; an ``encoder`` maps text batches to vectors in Arrow batches."""
    if encoder is not None:
        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in texts:
                yield pd.Series([np.asarray(v, dtype=np.float32) for v in encoder(batch.fillna(""))])

        return df.withColumn(out, run(F.col(col)))
    tokens = df.withColumn("__t", F.coalesce(word_tokens(col), F.array().cast("array<string>")))
    counted = HashingTF(inputCol="__t", outputCol="__tf", numFeatures=dims).transform(tokens)
    unit = Normalizer(inputCol="__tf", outputCol="__u").transform(counted)
    return unit.withColumn(out, vector_to_array("__u", "float32")).drop("__t", "__tf", "__u")


def resolve_keywords(
    topics: DataFrame, cache: DataFrame, generator: Callable[[pd.Series], pd.Series], created_at,
    attempts: int = 3, n: int = 5, tasks: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Keywords for each requested topic, and the grown cache.

    ``topics`` has a column ``hobby``. Topics found in the cache keep the newest row; the
    others, each once, go to ``generator`` (topics to answer texts) and are asked again while the
    answer is not exactly ``n`` non-blank items. New rows are fixed by a checkpoint before
    they are used twice: a generator need not answer alike after a task retry. Topics
    without a valid answer come back with NULL keywords and are not stored.
    """
    known = latest_per_key(cache, "hobby", "created_at")
    missing = anti_match(topics.select("hobby").where("hobby is not null").distinct(), known, "hobby")

    def ask(batches):
        for batch in batches:
            yield pd.DataFrame({"hobby": batch["hobby"], "answer": generator(batch["hobby"])})

    tasks = tasks or topics.sparkSession.sparkContext.defaultParallelism
    new = None
    for _ in range(attempts):
        # Few bytes but slow answers: a fixed number of tasks, not one per amount of data.
        answers = missing.repartition(tasks).mapInPandas(ask, "hobby string, answer string")
        tried = cut(answers.select("hobby", parse_keywords(last_line("answer")).alias("k")))
        good = tried.where(valid_keywords("k", n))
        new = good if new is None else new.unionByName(good)
        missing = tried.where(~valid_keywords("k", n)).select("hobby")
        if missing.isEmpty():
            break
    fields = KEYWORD_CACHE["created_at"].dataType
    rows = new.select("hobby", *spread_keywords("k", n), F.lit(created_at).cast(fields).alias("created_at"))
    table = known.unionByName(rows)
    resolved = lookup(topics, table.drop("created_at"), "hobby")
    return resolved, merge_cache(cache, rows, "hobby")


def recommendation_requests(resolved: DataFrame, template: str, run_date, date_format: str = "yyyy년 MM월 dd일",
                            n: int = 5) -> DataFrame:
    """One prompt per request with resolved keywords; places ``{hobby}``, ``{keywords}``
    and ``{date}``. The date is passed in, so a rerun gives the same prompts."""
    listed = gather_keywords(n)
    ready = resolved.where(F.size(listed) > 0)
    return ready.withColumn("prompt", build_prompt(
        template,
        hobby="hobby",
        keywords=F.array_join(listed, ", "),
        date=F.date_format(F.lit(run_date).cast("date"), date_format),
    ))
