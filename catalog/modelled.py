"""T9 to T18: clusters, topics, classifier.

No SQL states what a fit finds, so these queries return facts about it that SQL can state: what
the fit says, recomputed from its centres, factors or weights by joins and aggregates over all
rows. ``tests/test_facts.py`` puts in wrong fits and sees the facts fail."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog.lookups import POINT
from catalog.profiling import EXCLUDE
from catalog.registry import query, table
from voxlens.functions.text import word_tokens
from voxlens.operators import density, features, lookup, models, scoring
from voxlens.operators.clusters import sparse_rows
from voxlens.session import stage


def vectors(spark, sf):
    """Hashed vectors of all terms."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return models.text_vectors(docs, "text", EXCLUDE, keep=["doc_id"]).select("doc_id", "tfidf_features")


def products(rows, matrix):
    """(doc_id, norm, p0, p1, ...): products of sparse rows with the columns c0, c1, ... of a table
    by ``idx``, as a join and sums."""
    names = [c for c in matrix.columns if c != "idx"]
    entries = rows.select("doc_id", F.explode(F.arrays_zip("idx", "val")).alias("e")).select("doc_id", "e.idx", "e.val")
    # One row per dimension, of which there are no more than the hashed ones: a row's products are summed in place.
    sums = entries.join(F.broadcast(matrix), "idx").groupBy("doc_id").agg(
        *[F.sum(F.col("val") * F.col(c)).alias(f"p{i}") for i, c in enumerate(names)])
    return rows.select("doc_id", "norm").join(sums, "doc_id", "left").fillna(0.0)


def distances(rows, fits):
    """(doc_id, norm, d2_0, d2_1, ...): squared distance of every row to every centre of every k."""
    columns = {f"c{k}_{j}": fit.centres[:, j] for k, fit in fits.items() for j in range(k)}
    used = np.flatnonzero(np.any([c != 0 for c in columns.values()], axis=0)).astype(np.int32)
    matrix = rows.sparkSession.createDataFrame(pa.table({"idx": used, **{name: c[used] for name, c in columns.items()}}))
    found = products(rows, matrix)
    return found.select("doc_id", "norm", *[
        (F.col("norm") + float(c @ c) - 2 * F.col(f"p{i}")).alias(f"d{name[1:]}") for i, (name, c) in enumerate(columns.items())])


def least(k):
    return F.least(*[F.col(f"d{k}_{j}") for j in range(k)])


def placed(rows, fit, clustered):
    """(doc_id, placed): whether a row's cluster is its nearest centre."""
    k = fit.centres.shape[1]
    found = clustered.select("doc_id", "cluster").join(distances(rows, {k: fit}), "doc_id")
    own = F.element_at(F.array(*[F.col(f"d{k}_{j}") for j in range(k)]), F.col("cluster") + 1)
    return found.select("doc_id", (own <= least(k) + 1e-9 * (1 + F.col("norm"))).alias("placed"))


def cost_facts(rows, fits, costs):
    """Per k of (k, cost): whether the cost is that of the centres, and below that of one cluster."""
    n = rows.count()
    sums = rows.select(F.explode(F.arrays_zip("idx", "val")).alias("e")).groupBy("e.idx").agg(F.sum("e.val").alias("s"))
    one = rows.agg(F.sum("norm")).first()[0] - sums.agg(F.sum(F.col("s") * F.col("s"))).first()[0] / max(1, n)
    again = distances(rows, fits).agg(*[F.sum(F.greatest(least(k), F.lit(0.0))).alias(str(k)) for k in fits]).first()
    want = rows.sparkSession.createDataFrame([(k, again[str(k)]) for k in fits], "k int, again double")
    return costs.join(want, "k").select(
        "k", (F.abs(F.col("cost") - F.col("again")) <= 1e-8 * F.col("again")).alias("recomputed"),
        (F.col("cost") < one).alias("better_than_one"))


def silhouette_facts(rows, fits, scores):
    """Per k of (k, silhouette): whether it is the mean over all rows, from sums of the clusters."""
    spark, apart = rows.sparkSession, distances(rows, fits)
    label = {k: F.array_position(F.array(*[F.col(f"d{k}_{j}") for j in range(k)]), least(k)) - 1 for k in fits}
    labels = stage(apart.select("doc_id", "norm", *[c.cast("int").alias(f"l{k}") for k, c in label.items()]), "facts")
    entries = rows.select("doc_id", "idx", "val").join(labels.drop("norm"), "doc_id").withColumn("e", F.explode(F.arrays_zip("idx", "val")))
    cells = [(k, j) for k in fits for j in range(k)]
    stats = labels.agg(*[x for k, j in cells for x in (
        F.count(F.when(F.col(f"l{k}") == j, 1)), F.sum(F.when(F.col(f"l{k}") == j, F.col("norm"))))]).first()
    size = {c: stats[2 * i] for i, c in enumerate(cells)}
    spread = {c: (stats[2 * i + 1] or 0.0) / max(1, stats[2 * i]) for i, c in enumerate(cells)}
    means = entries.groupBy("e.idx").agg(*[
        (F.sum(F.when(F.col(f"l{k}") == j, F.col("e.val")).otherwise(0.0)) / max(1, size[k, j])).alias(f"c{k}_{j}") for k, j in cells])
    found = products(rows, means).join(labels.drop("norm"), "doc_id")
    mean = {c: F.greatest(F.col("norm") + spread[c] - 2 * F.col(f"p{i}"), F.lit(0.0)) for i, c in enumerate(cells)}

    def score(k):
        out = F.lit(0.0)
        for j in range(k):
            others = [mean[k, i] for i in range(k) if i != j and size[k, i]]
            if size[k, j] > 1 and others:
                a = mean[k, j] * (size[k, j] / (size[k, j] - 1))
                b = F.least(*others) if len(others) > 1 else others[0]
                out = F.when(F.col(f"l{k}") == j, F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))).otherwise(out)
        return out

    again = found.agg(*[F.avg(score(k)).alias(str(k)) for k in fits]).first()
    want = spark.createDataFrame([(k, again[str(k)]) for k in fits], "k int, again double")
    return scores.join(want, "k").select("k", (F.abs(F.col("silhouette") - F.col("again")) < 1e-6).alias("recomputed"))


def falling(topics, group, order, weight):
    """Rows with whether their weight is no larger than that of the rank before."""
    before = F.lag(weight).over(Window.partitionBy(group).orderBy(order))
    return topics.withColumn("falls", F.coalesce(F.col(weight) <= before, F.lit(True)))


def topic_facts(topics, terms):
    """Per topic of (topic, rank, term, weight): words, whether weights fall, are positive, and
    whether every word is one of ``terms``."""
    known = topics.join(terms.select("term", F.lit(True).alias("known")), "term", "left")
    return falling(known, "topic", "rank", "weight").groupBy("topic").agg(
        F.count_distinct("term").alias("n_words"), F.every("falls").alias("falling"),
        F.every(F.col("weight") > 0).alias("positive"), F.every(F.coalesce("known", F.lit(False))).alias("known"),
    )


@query("t9_cluster", "SELECT doc_id, true AS placed FROM documents")
def t9(spark, sf):
    rows, fits = models.fit_clusters(vectors(spark, sf), [2])
    return placed(rows, fits[2], models.assign(rows, fits[2], "cluster"))


@query("t10_elbow", "SELECT CAST(k AS INTEGER) AS k, true AS recomputed, true AS better_than_one FROM range(2, 10) t(k)")
def t10(spark, sf):
    rows, fits = models.fit_clusters(vectors(spark, sf), range(2, 10))
    return cost_facts(rows, fits, models.cost_table(spark, fits))


@query("t11_silhouette", "SELECT CAST(k AS INTEGER) AS k, true AS recomputed FROM range(2, 6) t(k)")
def t11(spark, sf):
    rows, fits = models.fit_clusters(vectors(spark, sf), range(2, 6))
    return silhouette_facts(rows, fits, models.silhouette_table(rows, fits))


@query("t12_cluster_members", "SELECT doc_id, true AS placed, true AS member_of_size FROM documents")
def t12(spark, sf):
    rows, fits = models.fit_clusters(vectors(spark, sf), [2])
    clustered = stage(models.assign(rows, fits[2], "cluster"), "clusters")
    members = lookup.union_all([models.cluster_members(clustered, "doc_id", c) for c in (0, 1)])
    listed = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("listed"))
    right = models.cluster_sizes(clustered).join(listed, "cluster", "left").select(
        "cluster", F.coalesce(F.col("n") == F.col("listed"), F.lit(False)).alias("member_of_size"))
    return members.join(right, "cluster").join(placed(rows, fits[2], members), "doc_id").select("doc_id", "placed", "member_of_size")


def weights(spark, sf):
    docs = table(spark, sf, "documents")
    counts = features.term_counts(docs.select("doc_id", word_tokens("text").alias("t")), "doc_id", "t")
    return features.tfidf_l2(counts, docs, "doc_id")


def mixed(rows, value, found, k):
    """(doc_id, term, value, mixed) of a long table: the product of the factors by plain joins."""
    met = rows.select("doc_id", "term", F.col(value).alias("value")).join(found.terms, "term").join(found.documents, "doc_id")
    return met.select("doc_id", "term", "value", sum(F.col(f"w{i}") * F.col(f"h{i}") for i in range(k)).alias("mixed"))


def close(a, b):
    return abs(a - b) <= 1e-6 * max(1.0, abs(b))


def factor_facts(rows, found, k):
    """Whether the squared error, recomputed from the factors over all documents and terms, is the
    last one reported, and whether errors fall."""
    def gram(df, prefix):
        names = [f"{prefix}{i}" for i in range(k)]
        row = df.agg(*[F.sum(F.col(a) * F.col(b)) for a in names for b in names]).first()
        return np.array([x or 0.0 for x in row])

    v, cross = mixed(rows, "weight", found, k).agg(
        F.coalesce(F.sum(F.col("value") ** 2), F.lit(0.0)), F.coalesce(F.sum(F.col("value") * F.col("mixed")), F.lit(0.0))).first()
    error = v - 2 * cross + float(gram(found.documents, "w") @ gram(found.terms, "h"))
    fall = all(0 < b <= a * (1 + 1e-6) for a, b in zip(found.errors, found.errors[1:]))
    return fall, close(error, found.errors[-1])


def mixture_facts(rows, found, k, alpha=0.1, eta=0.01):
    """Whether shares add up to one, the log posterior, recomputed from the shares, is the last one
    reported, and whether it rises."""
    logs = sum(F.log(f"w{i}") for i in range(k)), sum(F.log(f"h{i}") for i in range(k))
    seen = mixed(rows, "tf", found, k).agg(F.coalesce(F.sum(F.col("value") * F.log("mixed")), F.lit(0.0))).first()[0]
    of_docs, off = found.documents.agg(F.sum(logs[0]), F.max(F.abs(sum(F.col(f"w{i}") for i in range(k)) - 1))).first()
    of_terms, *whole = found.terms.agg(F.sum(logs[1]), *[F.sum(f"h{i}") for i in range(k)]).first()
    bound = seen + alpha * (of_docs or 0.0) + eta * (of_terms or 0.0)
    rise = all(b >= a - 1e-6 * abs(a) for a, b in zip(found.bounds, found.bounds[1:]))
    shares = (off or 0.0) < 1e-9 and all(close(x, 1.0) for x in whole if x is not None)
    return rise, close(bound, found.bounds[-1]) and shares


@query("t13_lda_topics", """
SELECT CAST(t AS INTEGER) AS topic, CAST(10 AS BIGINT) AS n_words, true AS falling, true AS positive, true AS known,
       true AS bounds_rise, true AS bound_holds
FROM range(3) r(t)
""")
def t13(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    tokens = features.remove_stopwords(features.tokenize(docs, "text"), "words", EXCLUDE)
    counts = stage(features.term_counts(tokens, "doc_id", "filtered_words"), "facts")
    found = models.lda(counts, "doc_id", k=3)
    rise, holds = mixture_facts(counts, found, 3)
    facts = topic_facts(models.factor_topics(found.terms, 3, 10), counts.select("term").distinct())
    return facts.withColumns({"bounds_rise": F.lit(rise), "bound_holds": F.lit(holds)})


@query("t14_nmf_topics", """
SELECT CAST(t AS INTEGER) AS topic, CAST(5 AS BIGINT) AS n_words, true AS falling, true AS positive, true AS known,
       true AS errors_fall, true AS error_holds
FROM range(3) r(t)
""")
def t14(spark, sf):
    rows = stage(weights(spark, sf), "facts")
    found = models.nmf(rows, "doc_id", k=3)
    fall, holds = factor_facts(rows, found, 3)
    facts = topic_facts(models.factor_topics(found.terms, 3, 5), found.terms.select("term"))
    return facts.withColumns({"errors_fall": F.lit(fall), "error_holds": F.lit(holds)})


def density_facts(points, clustered, width, min_cell, min_size):
    """(key, point) against (key, cluster): whether touching dense cells are one cluster, clusters
    hold ``min_size`` rows, and noise is nowhere dense or beside it, but for small clusters."""
    rows = points.select("key", density.cell_of(F.col("point"), width).alias("cell")).join(clustered, "key")
    cells = stage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("cluster").alias("lo"), F.max("cluster").alias("hi")), "facts")
    dims = cells.select(F.size("cell")).first()[0]
    dense = cells.where(F.col("n") >= min_cell)
    pairs = density.touching(dense.select("cell"), dims).join(dense.select("cell", F.col("lo").alias("own")), "cell").join(
        cells.select(F.col("cell").alias("near"), "n", F.col("lo").alias("other")), "near")
    joined = pairs.agg(
        F.coalesce(F.every((F.col("own") == F.col("other")) | (F.col("n") < min_cell)), F.lit(True)).alias("dense_meet"),
        F.coalesce(F.every((F.col("own") < 0) | (F.col("other") >= 0)), F.lit(True)).alias("border_joins"))
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where("cluster >= 0")
    large = sizes.agg(F.coalesce(F.every(F.col("size") >= min_size), F.lit(True)).alias("large"))
    lonely = pairs.groupBy(F.col("near").alias("cell")).agg(F.max("own").alias("beside"))
    alone = cells.join(lonely, "cell", "left").where(F.col("n") < min_cell).agg(F.coalesce(F.every(
        (F.coalesce("beside", F.lit(-1)) >= 0) | (F.col("hi") < 0)), F.lit(True)).alias("noise_is_alone"))
    full = F.col("n") >= max(min_cell, min_size)
    whole = cells.agg(F.every(F.col("lo") == F.col("hi")).alias("cells_are_whole"),
                      F.every(~full | (F.col("lo") >= 0)).alias("full_cells_count"))
    facts = {**joined.first().asDict(), **large.first().asDict(), **alone.first().asDict(), **whole.first().asDict()}
    return all(facts.values()), facts


@query("t15_embedding_topics", """
SELECT count(*) AS n_documents, true AS falling, true AS ranked, true AS dense_clusters FROM documents
""")
def t15(spark, sf):
    embedded = scoring.embed(table(spark, sf, "documents").select("doc_id", "text"), "text")
    # The steps of ``embedding_topics``, so that the facts are about the same clusters.
    points = stage(models.reduced_points(embedded, "embedding", 5, ["doc_id", "text"]), "points")
    clustered = stage(density.density_clusters(points, "point", 1.0, 4, 10, "topic").select("doc_id", "text", "topic"), "density")
    topics = models.topic_words(clustered, "text")
    per_topic = falling(topics, "topic", "rank", "weight").groupBy("topic", "size").agg(
        F.every("falls").alias("falls"), (F.max("rank") == F.count("word")).alias("ranked"))
    keyed = points.where("point is not null").select(F.col("doc_id").alias("key"), "point")
    good, _ = density_facts(keyed, clustered.select(F.col("doc_id").alias("key"), F.col("topic").alias("cluster")), 1.0, 4, 10)
    return per_topic.agg(F.sum("size").alias("n_documents"), F.every("falls").alias("falling"), F.every("ranked").alias("ranked")).withColumn(
        "dense_clusters", F.lit(good))


def score_facts(model, rows, scored):
    """(doc_id, recomputed, by_threshold): whether a score is the logistic function of the sum of
    term counts times the saved weights, and the label that of the score."""
    _, idf, fit = model.stages
    weights = np.asarray(fit.coefficients.toArray()) * np.asarray(idf.idf.toArray())
    used = np.flatnonzero(weights).astype(np.int32)
    matrix = rows.sparkSession.createDataFrame(pa.table({"idx": used, "c0": weights[used]}))
    counted = sparse_rows(model.stages[0].transform(rows), "tf", ["doc_id"])
    again = products(counted, matrix).select("doc_id", (1 / (1 + F.exp(-(F.col("p0") + float(fit.intercept))))).alias("again"))
    return scored.join(again, "doc_id").select(
        "doc_id", (F.abs(F.col("score") - F.col("again")) < 1e-9).alias("recomputed"),
        (F.col("sentiment") == F.when(F.col("score") > 0.5, "positive").otherwise("negative")).alias("by_threshold"))


def learned(model, train):
    """Whether the loss over the training rows is below that of always giving their share."""
    scored = models.predict(model, train).select("label", F.greatest(F.least("score", F.lit(1 - 1e-15)), F.lit(1e-15)).alias("score"))
    loss = F.avg(-F.log(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))))
    found, share = scored.agg(loss, F.avg("label")).first()
    plain = 0.0 if share in (0.0, 1.0) else -(share * np.log(share) + (1 - share) * np.log(1 - share))
    return bool(found < plain)


@query("t18_sentiment_model", f"""
SELECT doc_id, true AS recomputed, true AS by_threshold, true AS learned FROM documents JOIN labels USING (doc_id)
WHERE {POINT.format('doc_id')} >= 0.8
""")
def t18(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").join(table(spark, sf, "labels"), "doc_id")
    model, train, test = models.train_sentiment(docs, "text", "quality", key="doc_id")
    scored = models.predict(model, test).select("doc_id", "score", "sentiment")
    return score_facts(model, test, scored).withColumn("learned", F.lit(learned(model, train)))
