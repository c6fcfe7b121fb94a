"""Invariants of clusters, topics and the classifier; scoring with passed functions."""

import datetime as dt
import math
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxlens.functions.text import word_tokens
from voxlens.operators import clusters, factors, features, models, scoring
from voxlens.schemas import KEYWORD_CACHE

FRUIT, TOOLS = "apple pear plum cherry grape", "hammer nail screw saw drill"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(60):
        base = (FRUIT if i % 2 else TOOLS).split()
        rows.append((i, " ".join(base[j % 5] for j in range(i, i + 3 + i % 4)), i % 2))
    return spark.createDataFrame(rows, "id int, text string, label int").repartition(4).cache()


@pytest.fixture(scope="module")
def vectors(corpus):
    return models.text_vectors(corpus, "text"), None


def test_clusters(vectors):
    rows, _ = vectors
    placed, _ = models.cluster(rows, 2)
    pairs = {(r["label"], r["cluster"]) for r in placed.select("label", "cluster").collect()}
    assert len(pairs) == 2
    assert sum(r["n"] for r in models.cluster_sizes(placed).collect()) == 60
    assert models.cluster_members(placed, "id", 1).count() == 30


def test_cost_and_silhouette(vectors):
    rows, _ = vectors
    cost = [r["cost"] for r in models.elbow(rows, range(2, 5)).orderBy("k").collect()]
    assert all(c > 0 for c in cost) and cost[0] >= cost[-1]
    scores = models.silhouette(rows, range(2, 4)).collect()
    assert len(scores) == 2 and all(-1 <= r["silhouette"] <= 1 for r in scores)


def test_lda(corpus):
    counts = features.term_counts(corpus.select("id", word_tokens("text").alias("t")), "id", "t")
    tops = models.lda_topics(counts, "id", k=2, n=3, rounds=8).collect()
    sides = {t: {r["term"] in FRUIT for r in tops if r["topic"] == t} for t in (0, 1)}
    assert len(tops) == 6 and all(r["weight"] > 0 for r in tops)
    assert sorted(map(tuple, sides.values())) == [(False,), (True,)]


@pytest.mark.parametrize("fit, value", [(models.nmf, "weight"), (models.lda, "tf")])
def test_odd_entries(spark, monkeypatch, fit, value):
    """Null keys, terms and values, many blocks and an empty table."""
    monkeypatch.setattr(factors, "ENTRIES", 4)
    rows = [(i % 7 or None, f"t{i % 5}", 1.0 + i % 3) for i in range(35)] + [(1, None, 2.0), (2, "t1", None), (9, "t9", 0.0)]
    df = spark.createDataFrame(rows, f"id int, term string, {value} double")
    df = df.groupBy("id", "term").agg(F.sum(value).alias(value))
    before = len(spark.catalog.listTables())
    found = fit(df, "id", k=2, rounds=2)
    assert {r["id"] for r in found.documents.collect()} == {None, 1, 2, 3, 4, 5, 6}
    assert {r["term"] for r in found.terms.collect()} == {f"t{i}" for i in range(5)}
    monkeypatch.setattr(factors, "ENTRIES", 1 << 17)
    whole = fit(df, "id", k=2, rounds=2)
    assert np.allclose(found.scores, whole.scores, rtol=1e-6)
    empty = fit(df.limit(0), "id", k=2, rounds=2)
    assert empty.documents.count() == empty.terms.count() == 0
    assert len(spark.catalog.listTables()) == before


@pytest.mark.parametrize("fit, value", [(models.nmf, "weight"), (models.lda, "tf")])
def test_rounds_move_no_row_per_term(spark, monkeypatch, fit, value):
    """Blocks and parts send each other one row, however many terms they share."""
    monkeypatch.setattr(factors, "ENTRIES", 500)
    rows = [(i, f"t{(i * 7 + j * j) % 400}", 1.0 + j % 3) for i in range(40) for j in range(50)]
    df = spark.createDataFrame(rows, f"id int, term string, {value} double").groupBy("id", "term").agg(F.sum(value).alias(value))
    staged, stage = {}, factors.stage

    def noted(df, name, **options):
        out = stage(df, name, **options)
        staged.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(factors, "stage", noted)
    found = fit(df, "id", k=2, rounds=2)
    assert found.terms.count() == df.select("term").distinct().count() > 100
    blocks = max(math.ceil(df.count() / 500), 1)
    assert blocks > 2 and staged["topic_sums"] and max(staged["topic_sums"]) <= blocks * (blocks + 1)


def test_nmf(corpus):
    counts = features.term_counts(corpus.select("id", word_tokens("text").alias("t")), "id", "t")
    weights = features.tfidf_l2(counts, corpus, "id")
    found = models.nmf(weights, "id", k=2, rounds=3)
    assert all(a >= b - 1e-9 for a, b in zip(found.errors, found.errors[1:])) and found.errors[-1] > 0
    low = found.terms.agg(F.min("h0"), F.min("h1")).first()
    assert min(low) >= 0 and found.documents.count() == 60
    # The error that is reported is the error of the factors.
    terms = {r["term"]: np.array([r["h0"], r["h1"]]) for r in found.terms.collect()}
    docs = {r["id"]: np.array([r["w0"], r["w1"]]) for r in found.documents.collect()}
    x = {(r["id"], r["term"]): r["weight"] for r in weights.collect()}
    error = sum((x.get((d, t), 0.0) - docs[d] @ terms[t]) ** 2 for d in docs for t in terms)
    assert np.isclose(error, found.errors[-1], rtol=1e-6)
    tops = models.nmf_topics(weights, "id", k=2, n=3, rounds=3).collect()
    assert len(tops) == 6
    sides = {t: {r["term"] in FRUIT for r in tops if r["topic"] == t} for t in (0, 1)}
    assert sorted(map(tuple, sides.values())) == [(False,), (True,)]


def test_embedding_topics(corpus):
    embedded = scoring.embed(corpus, "text")
    length = embedded.select(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x).alias("l")).collect()
    assert all(np.isclose(r["l"], 1.0, atol=1e-5) for r in length)
    out = models.embedding_topics(embedded, "text", "embedding", dims=3, min_size=10, n=5).collect()
    sizes = {r["topic"]: r["size"] for r in out}
    assert sum(sizes.values()) == 60 and all(n >= 10 for t, n in sizes.items() if t >= 0) and any(t >= 0 for t in sizes)
    # A topic does not mix fruit and tools.
    for topic in {t for t in sizes if t >= 0}:
        assert len({r["word"] in FRUIT for r in out if r["topic"] == topic}) == 1
    assert models.embedding_topics(embedded, "text", "embedding", dims=3, min_size=1000).select("topic").distinct().first()[0] == -1


def test_density_clusters_with_noise(spark):
    from catalog.modelled import density_facts
    from voxlens.operators.density import density_clusters

    rng = np.random.default_rng(4)
    blobs = [rng.normal(c, 0.5, (n, 3)) for c, n in (((0, 0, 0), 400), ((12, 0, 3), 200), ((-3, 14, 0), 100))]
    curve = np.array([(x, 30 + np.sin(x), -20 + x / 2) for x in np.linspace(0, 12, 300)])
    far = rng.uniform(-60, -30, (40, 3))
    rows = np.concatenate([*blobs, curve, far])
    made = [(i, [float(x) for x in p]) for i, p in enumerate(rows)] + [(9000, None)]
    points = spark.createDataFrame(made, "key int, point array<double>").repartition(4)
    got = {r["key"]: r["cluster"] for r in density_clusters(points, "point", 1.0).select("key", "cluster").collect()}
    assert len(got) == len(made) and got[9000] == -1
    # The blobs and the long curve, by size; what lies far is noise.
    at = 0
    for k, size in ((0, 400), (2, 200), (3, 100), (1, 300)):
        own = [got[i] for i in range(at, at + size)]
        assert own.count(k) > 0.9 * size and set(own) <= {k, -1}
        at += size
    assert {got[i] for i in range(at, at + 40)} == {-1}
    clustered = spark.createDataFrame(list(got.items()), "key int, cluster int")
    known = points.where("point is not null")
    assert density_facts(known, clustered, 1.0, 4, 10)[0]
    hashed = clustered.withColumn("cluster", F.pmod(F.xxhash64("key"), F.lit(4)).cast("int"))
    assert not density_facts(known, hashed, 1.0, 4, 10)[0]
    assert not density_facts(known, clustered.withColumn("cluster", F.lit(-1)), 1.0, 4, 10)[0]
    assert density_clusters(points.limit(0), "point", 1.0).count() == 0


def test_connected_components(spark):
    from voxlens.operators.density import connected

    links = [(i, i + 1) for i in range(1, 60) if i != 20] + [(70, 61), (61, 66), (80, 80)]
    nodes = spark.range(1, 90).withColumnRenamed("id", "node")
    got = {r["node"]: r["label"] for r in connected(nodes, spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 21)) and all(got[i] == 21 for i in range(21, 61))
    assert got[70] == got[66] == got[61] == 61 and got[80] == 80 and got[88] == 88 and len(got) == 89


def test_sentiment_model(corpus):
    model, train, test = models.train_sentiment(corpus, "text", "label", 1 << 10, key="id")
    assert train.count() + test.count() == 60
    out = models.predict(model, test).collect()
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0.5) == (r["sentiment"] == "positive") for r in out)
    assert all((r["label"] == 1.0) == (r["sentiment"] == "positive") for r in out)
    again, _, same = models.train_sentiment(corpus, "text", "label", 1 << 10, key="id")
    assert [r["score"] for r in models.predict(again, same).orderBy("id").collect()] == pytest.approx(
        [r["score"] for r in models.predict(model, test).orderBy("id").collect()])


def test_model_runs_once_per_row(spark):
    calls = spark.sparkContext.accumulator(0)

    def scorer(texts):
        calls.add(len(texts))
        return pd.DataFrame({"label": ["x"] * len(texts), "confidence": [0.5] * len(texts)})

    rows = scoring.score_text(spark.createDataFrame([("a",), (None,)], "t string"), "t", scorer)
    assert [(r[0], r[1]) for r in rows.select("score.label", "score.confidence").collect()] == [("x", 0.5)] * 2
    assert calls.value == 2


def test_relevance(spark):
    df = spark.createDataFrame([("배터리 좋다",), ("그냥",), (None,), ("",)], "t string")
    out = scoring.score_relevance(df, "t", words=["배터리"]).collect()
    assert [r["relevant"] for r in out] == [1, 0, 0, 0]


def test_keyword_table(spark):
    cache = spark.createDataFrame([
        ("게임", "a", "b", "c", "d", "e", dt.datetime(2025, 1, 1)),
        ("게임", "화면", "성능", None, "발열", "저장", dt.datetime(2025, 2, 1)),
    ], KEYWORD_CACHE)
    topics = spark.createDataFrame([("게임",), ("독서",), ("독서",), ("여행",), (None,)], "hobby string")
    asked = spark.sparkContext.accumulator(0)

    def generator(names):
        asked.add(len(names))
        return names.map(lambda t: "a, b, , d, e" if t == "여행" else f"preface\n'{t}1', 2, 3, 4, 5")

    resolved, grown = scoring.resolve_keywords(topics, cache, generator, "2025-03-01", attempts=2)
    found = {r["hobby"]: (r["keyword1"], r["keyword3"]) for r in resolved.collect()}
    assert found == {"게임": ("화면", None), "독서": ("독서1", "3"), "여행": (None, None), None: (None, None)}
    assert resolved.count() == 5 and asked.value == 3
    assert sorted(r["hobby"] for r in grown.collect()) == ["게임", "게임", "독서"]
    requests = scoring.recommendation_requests(resolved, "{hobby}/{keywords}/{date}", "2025-03-01").collect()
    assert {r["prompt"] for r in requests} == {"게임/화면, 성능, 발열, 저장/2025년 03월 01일", "독서/독서1, 2, 3, 4, 5/2025년 03월 01일"}


def test_documents_are_solved_apart(spark):
    """A document's shares do not depend on the others of its block, and what moves per term is k sums."""
    draw = np.random.default_rng(3)
    h = draw.random((50, 3)) + 0.01
    docs = [draw.choice(50, size, replace=False) for size in (1, 2, 30, 5, 50, 1)]
    solve = factors._mixtures(0.1)
    alone = [solve(np.zeros(len(t), np.int32), t, np.ones(len(t)), h) for t in docs]
    d = np.repeat(np.arange(len(docs), dtype=np.int32), [len(t) for t in docs])
    theta, sums, whole = solve(d, np.concatenate(docs), np.ones(len(d)), h)
    assert np.allclose(theta, np.concatenate([a[0] for a in alone]), atol=1e-6)
    assert np.allclose(sums, sum(a[1] for a in alone)) and np.allclose(whole, sum(a[2] for a in alone))
    rows = spark.createDataFrame([(i, f"t{t}", 1.0) for i, ts in enumerate(docs) for t in ts], "doc_id long, term string, weight double")
    with factors._packed(rows, "doc_id", "weight") as (blocks, needs, words):
        tops = words.select("word", *[F.lit(0.5).alias(f"h{i}") for i in range(3)])
        assert factors._sums(blocks, needs, tops, 3, solve).columns == ["word", "at", "s0", "s1", "s2"]


def test_a_round_in_long_form(spark, monkeypatch):
    """Sums that blocks and parts send each other are those of all documents solved together."""
    monkeypatch.setattr(factors, "ENTRIES", 20)
    draw = np.random.default_rng(5)
    docs = [np.sort(draw.choice(40, size, replace=False)) for size in (3, 20, 7, 1, 30)]
    h, solve = draw.random((40, 2)) + 0.01, factors._mixtures(0.1)
    d = np.repeat(np.arange(len(docs)), [len(t) for t in docs])
    _, want, whole = solve(d, np.concatenate(docs), np.ones(len(d)), h)
    rows = spark.createDataFrame([(i, f"t{t}", 1.0) for i, ts in enumerate(docs) for t in ts.tolist()], "doc_id long, term string, weight double")
    with factors._packed(rows, "doc_id", "weight") as (blocks, needs, words):
        given = spark.createDataFrame([(f"t{i}", *x) for i, x in enumerate(h.tolist())], "term string, h0 double, h1 double")
        sums = factors._sums(blocks, needs, words.join(given, "term"), 2, solve)
        found = {r["term"]: (r["s0"], r["s1"]) for r in sums.join(words, "word").collect()}
        ends = [x for r in sums.where("word is null").orderBy("at").collect() for x in r[2:]]
    assert set(found) == {f"t{t}" for t in np.concatenate(docs)}
    assert all(np.allclose(x, want[int(t[1:])]) for t, x in found.items()) and np.allclose(ends[:3], whole)


def test_blocks_grow_with_the_entries(spark, monkeypatch):
    """Large tables have large blocks, so a term is sent to few of them; small ones keep tasks busy."""
    rows = spark.range(4000).selectExpr("id div 4 as doc_id", "concat('t', id % 7) as term", "1.0d as weight")
    monkeypatch.setattr(factors, "ENTRIES", 1000)
    monkeypatch.setattr(factors, "FEWEST", 10)
    with factors._packed(rows, "doc_id", "weight") as (blocks, _, _):
        assert blocks.count() == int(spark.conf.get("spark.sql.shuffle.partitions"))

def test_sums_of_a_task_are_bounded():
    """The memory of a scan follows the centres, not the rows."""
    draw, peaks = np.random.default_rng(1), []
    fits = [clusters.Fit(draw.random((1 << 14, 2)))]

    def batches(n):
        for _ in range(n):
            rows = [np.sort(draw.choice(1 << 14, 50, replace=False)).astype(np.int32) for _ in range(1000)]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array([np.ones(50)] * 1000), pa.array([50.0] * 1000)], names=["idx", "val", "norm"])

    for n in (2, 40):
        tracemalloc.start()
        found = list(clusters._sums(SimpleNamespace(value=clusters._columns(fits)), None)(batches(n)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        sums = sum(part.sum() for b in found for number, _, part in clusters._unpacked(b) if number >= 0)
        assert sums == n * 50_000
    assert peaks[1] < 2 * peaks[0]


def test_tokenizer_gets_parts(spark):
    """A batch of texts is not handed to a tokenizer at once."""
    docs = spark.createDataFrame([(i, "ab " * 40_000) for i in range(30)] + [(30, None), (31, "ab " * 1_000_000)], "id int, text string").coalesce(1)
    told = features.extract_terms(docs, "text", tokenizer=lambda texts: pd.Series([[str(int(texts.str.len().sum()))]] * len(texts)))
    got = {r["id"]: int(r["terms"][0]) for r in told.collect()}
    assert len(got) == 32 and got[31] >= 3_000_000
    assert all(n <= features.CHARACTERS for i, n in got.items() if i < 30)
