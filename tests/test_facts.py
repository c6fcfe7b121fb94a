"""The facts that the queries on fits return fail for wrong fits."""

import copy
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import modelled
from voxlens.operators import factors, models
from voxlens.session import stage

WORDS = ["apple pear plum cherry grape", "hammer nail screw saw drill", "rain snow wind storm cloud"]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, " ".join(WORDS[i % 3].split()[j % 5] for j in range(i, i + 3 + i % 4))) for i in range(60)] + [(60, ""), (61, "apple")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vectors = models.text_vectors(docs, "text", dims=64, keep=["doc_id"])
    return models.fit_clusters(vectors.select("doc_id", "tfidf_features"), [2, 3, 4])


def every(facts, *names):
    return [facts.agg(F.every(n)).first()[0] for n in names]


def test_clusters(fitted):
    rows, fits = fitted
    clustered = stage(models.assign(rows, fits[3], "cluster"), "clusters")
    assert every(modelled.placed(rows, fits[3], clustered), "placed") == [True]
    assert clustered.count() == 62 and sorted(r["n"] for r in models.cluster_sizes(clustered).collect()) == sorted(fits[3].sizes.tolist())
    hashed = clustered.withColumn("cluster", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int"))
    assert every(modelled.placed(rows, fits[3], hashed), "placed") == [False]
    shifted = copy.copy(fits[3])
    shifted.centres = fits[3].centres[:, ::-1]
    assert every(modelled.placed(rows, shifted, clustered), "placed") == [False]


def test_costs(spark, fitted):
    rows, fits = fitted
    costs = models.cost_table(spark, fits)
    assert every(modelled.cost_facts(rows, fits, costs), "recomputed", "better_than_one") == [True, True]
    wrong = costs.withColumn("cost", F.when(F.col("k") == 3, F.col("cost") * 1.001).otherwise(F.col("cost")))
    assert every(modelled.cost_facts(rows, fits, wrong), "recomputed") == [False]
    far = {2: copy.copy(fits[2])}
    far[2].centres = fits[2].centres + 5
    assert every(modelled.cost_facts(rows, far, costs.where("k = 2")), "recomputed") == [False]


def test_centres_are_means(fitted):
    _, fits = fitted
    for fit in fits.values():
        full = fit.sizes > 0
        assert np.allclose(fit.centres[:, full], (fit.sums / np.maximum(fit.sizes, 1))[:, full], atol=0.2)
        assert fit.sizes.sum() == 62


def test_silhouettes(fitted):
    rows, fits = fitted
    scores = models.silhouette_table(rows, fits)
    assert every(modelled.silhouette_facts(rows, fits, scores), "recomputed") == [True]
    assert every(modelled.silhouette_facts(rows, fits, scores.withColumn("silhouette", F.col("silhouette") * 0.99)), "recomputed") == [False]
    best = {r["k"]: r["silhouette"] for r in scores.collect()}
    assert best[3] > 0.3


def test_seeds_and_empty_tables(spark, fitted):
    rows, fits = fitted
    again = models.kmeans(rows, [2, 3, 4])
    assert all(np.array_equal(again[k].centres, fits[k].centres) for k in fits)
    none = models.kmeans(rows.limit(0), [2])
    assert none[2].sizes.tolist() == [0, 0] and none[2].cost == 0


def test_sentiment_scores(spark):
    rows = spark.createDataFrame([(i, " ".join(WORDS[i % 2].split()[j % 5] for j in range(i, i + 3))) for i in range(80)], "doc_id long, text string")
    rows = rows.withColumn("label", (F.col("doc_id") % 2).cast("double"))
    model, train, test = models.train_sentiment(rows, "text", "label", 1 << 10, key="doc_id")
    scored = stage(models.predict(model, test).select("doc_id", "score", "sentiment"), "scored")
    assert every(modelled.score_facts(model, test, scored), "recomputed", "by_threshold") == [True, True]
    hashed = scored.withColumn("score", F.pmod(F.xxhash64("doc_id"), F.lit(1000)) / 1000)
    assert every(modelled.score_facts(model, test, hashed), "recomputed") == [False]
    assert modelled.learned(model, train)
    turned = train.withColumn("label", 1 - F.col("label"))
    assert not modelled.learned(model, turned)


def test_embeddings(spark):
    from catalog.scored import embed_facts
    from voxlens.operators import scoring

    docs = spark.createDataFrame([(i, WORDS[i % 3] + f" w{i}") for i in range(20)] + [(20, ""), (21, None), (22, "rain rain rain")], "doc_id long, text string")
    embedded = stage(scoring.embed(docs, "text"), "embedded")
    facts = embed_facts(docs, embedded)
    assert facts.count() == 23 and every(facts, "from_words") == [True]
    assert every(embed_facts(docs, embedded.withColumn("embedding", F.reverse("embedding"))), "from_words") == [False]


def test_topics(spark):
    rows = [(i, t, 1.0 + (i + j) % 3) for i in range(30) for j, t in enumerate(WORDS[i % 3].split())]
    weights = spark.createDataFrame(rows, "doc_id long, term string, weight double")
    found = models.nmf(weights, "doc_id", k=3, rounds=3)
    assert modelled.factor_facts(weights, found, 3) == (True, True)
    other = factors.Factors(found.documents, found.terms.withColumn("h1", F.col("h1") * 1.1), found.scores)
    assert modelled.factor_facts(weights, other, 3) == (True, False)
    assert modelled.factor_facts(weights, factors.Factors(found.documents, found.terms, found.scores[::-1]), 3)[0] is False
    counts = weights.withColumnRenamed("weight", "tf")
    found = models.lda(counts, "doc_id", k=3, rounds=3)
    assert modelled.mixture_facts(counts, found, 3) == (True, True)
    swapped = found.documents.select("doc_id", F.col("w1").alias("w0"), F.col("w0").alias("w1"), "w2")
    assert modelled.mixture_facts(counts, factors.Factors(swapped, found.terms, found.scores), 3) == (True, False)
    assert modelled.mixture_facts(counts, factors.Factors(found.documents, found.terms, found.scores[::-1]), 3)[0] is False


def test_sums_are_made_in_place(spark, fitted):
    """Entries are not shuffled by dimension, nor embeddings by document and dimension."""
    from catalog.scored import embed_facts
    from voxlens.operators import scoring

    rows, fits = fitted
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = modelled.distances(rows, fits)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [idx" in plan and "SortMergeJoin [idx" not in plan
        docs = spark.createDataFrame([(1, WORDS[0]), (2, WORDS[1])], "doc_id long, text string")
        plan = embed_facts(docs, stage(scoring.embed(docs, "text"), "embedded"))._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and not re.search(r"Join \[[^]]*dim#", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
