"""Hot keys, hot copies and large groups give the same rows as the plain form."""

import random

import numpy as np
from pyspark.sql import functions as F

from voxlens import schemas
from voxlens.operators import aggregate, features, ranking, skew
from voxlens.operators.reshape import flatten_threads
from voxlens.sources.files import nest_threads


def test_hot_rows_are_few(spark):
    dim = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") == 7, 3000).otherwise(1).alias("n"))
    assert [r["k"] for r in skew.hot_rows(dim, "n").collect()] == [7]


def test_split_join_equals_join(spark):
    big = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2500).alias("k"), F.col("id").alias("x"))
    dim = big.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k % 5 <> 1")
    got = skew.join_split(big, dim, "k", "n").select("k", "x", "n")
    want = big.join(dim, "k").select("k", "x", "n")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rows_are_numbered_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
    rows = skew.number_rows(df, [F.asc("v")]).collect()
    assert all(r["row_no"] == r["v"] + 1 for r in rows) and len(rows) == 5000


def test_hot_video_is_spread_and_whole(spark):
    rows = [("hot", "t", "2024", "c", f"text {i}", i, "2024") for i in range(300)]
    rows += [("hot", "t", "2024", "c", "copy", 1, "2024")] * 250 + [("cold", "t", "2024", "c", "x", 1, None)] * 2
    df = spark.createDataFrame(rows, schemas.COMMENTS_RAW)
    docs = nest_threads(df, max_comments=50)
    sizes = docs.select(F.explode("threads")).select("key", F.size("value.comments").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 552
    assert max(r["n"] for r in sizes) < 200 and sum(r["key"] == "cold" for r in sizes) == 1
    back = flatten_threads(docs)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_ranks_beyond_the_planner_limit(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), (F.col("id") * 31 % 6007).alias("v"))
    got = ranking.top_per_group(df, ["g"], [F.desc("v")], 1200).collect()
    for g in (0, 1):
        want = sorted((i * 31 % 6007 for i in range(g, 6000, 2)), reverse=True)[:1200]
        assert [r["v"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])] == want


def test_quantiles_are_exact_on_large_and_skewed_columns(spark):
    rng = random.Random(5)
    ps = (0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0)
    for values in (
        [rng.lognormvariate(0, 3) for _ in range(30_000)],
        [1.0] * 12_000 + [rng.random() * 10 for _ in range(20_000)],
        [rng.gauss(0, 1) for _ in range(37)],
        [4.0],
    ):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
        found = {r["p"]: r["value"] for r in aggregate.quantiles(df, "v", ps).collect()}
        for p in ps:
            assert np.isclose(found[p], np.quantile(values, p), rtol=1e-12), (len(values), p)


def test_quantiles_of_many_columns(spark):
    df = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(None).cast("int").alias("c"))
    found = {(r["column"], r["p"]): r["value"] for r in aggregate.quantiles_of(
        df, {c: F.col(c) for c in df.columns}, (0.25, 0.5)).collect()}
    assert found[("a", 0.5)] == 9999.5 and found[("b", 0.25)] == 1.0
    assert ("c", 0.5) not in found


def test_latest_row_of_a_hot_key(spark):
    df = spark.range(3000).select(F.lit("k").alias("key"), F.col("id").alias("ts"), (F.col("id") * 2).alias("x"))
    assert [tuple(r) for r in ranking.latest_per_key(df, "key", "ts").collect()] == [("k", 2999, 5998)]


def test_long_form_weights_equal_vector_form(spark):
    rows = [(i, ["the"] + [f"w{(i * j) % 11}" for j in range(1, 6)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    weights = features.idf_weights(features.term_counts(df, "id", "t"), df, "id")
    long = {(r["id"], r["term"]): r["weight"] for r in weights.collect()}
    vectors, model = features.count_vectors(df, "t")
    for r in features.tfidf_vectors(vectors).collect():
        v = r["tfidf_features"]
        for i, x in zip(v.indices, v.values):
            assert np.isclose(long[(r["id"], model.vocabulary[i])], x)


def test_vector_length_is_one(spark):
    rows = [(i, [f"w{(i * j) % 11}" for j in range(1, 6)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    sizes = features.tfidf_l2(features.term_counts(df, "id", "t"), df, "id").groupBy("id").agg(
        F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert len(sizes) == 40 and all(np.isclose(r["s"], 1.0) for r in sizes)


def test_encoding(spark):
    known = spark.createDataFrame([(1, ["b", "a", "b"])], "id int, t array<string>")
    vocab = features.vocabulary_index(known, "t")
    assert {r["token"]: r["idx"] for r in vocab.collect()} == {"b": 2, "a": 3}
    df = spark.createDataFrame([(1, ["a", "zzz", "b"]), (2, []), (3, None), (4, ["b"] * 9)], "id int, t array<string>")
    out = {r["id"]: r["encoded"] for r in features.encode_tokens(df, "id", "t", vocab, 5).collect()}
    assert out == {1: [3, 1, 2, 0, 0], 2: [0] * 5, 3: [0] * 5, 4: [2] * 5}


def test_count_arrays_have_every_term(spark):
    n = (1 << 18) + 5000
    rows = spark.range(n).select((F.col("id") % 1000).alias("id"), F.array(F.lit("common"), F.concat(F.lit("t"), "id")).alias("t"))
    docs = rows.groupBy("id").agg(F.flatten(F.collect_list("t")).alias("t"))
    vectors, index = features.count_arrays(docs, "id", "t")
    assert index.count() == n + 1 and index.where("idx = 0").first()["token"] == "common"
    found = vectors.select(F.inline("entries")).agg(F.count_distinct("idx"), F.sum("tf")).first()
    assert tuple(found) == (n + 1, 2 * n)


def test_keywords_of_any_length(spark):
    from voxlens.operators import lookup

    dim = lookup.keyword_table(spark, {"a": ["Battery life", "very long battery life", "screen"], "b": ["battery", "screen", "long battery"]})
    docs = spark.createDataFrame([
        (1, "Very long battery life, very long battery"), (2, "screen SCREEN"), (3, None), (4, ""), (5, "life battery"),
    ], "id int, text string")
    got = sorted(tuple(r) for r in lookup.match_keywords(docs, dim, "id", "text").collect())
    assert got == [
        (1, "a", "Battery life", 1), (1, "a", "very long battery life", 1), (1, "b", "battery", 2), (1, "b", "long battery", 2),
        (2, "a", "screen", 2), (2, "b", "screen", 2), (5, "b", "battery", 1),
    ]
    counts = {(r["topic"], r["keyword"]): r["n"] for r in aggregate.keyword_frequency(docs, dim, "text").collect()}
    assert counts[("a", "very long battery life")] == 1 and counts[("b", "battery")] == 3 and counts[("a", "screen")] == 2
