"""X: scoring with functions passed in, embeddings, keyword table."""

import pandas as pd
from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.profiling import in_list, rounded
from catalog.registry import query, table
from catalog.textual import NEGATIVE, POSITIVE
from voxlens.functions.text import clean_basic, word_tokens
from voxlens.operators import features, scoring
from voxlens.operators.skew import join_split
from voxlens.session import stage

POS = f"len(list_filter({q.words('t')}, lambda w: w IN ({in_list(POSITIVE)})))"
NEG = f"len(list_filter({q.words('t')}, lambda w: w IN ({in_list(NEGATIVE)})))"


@query("x1_score_text", f"""
WITH d AS (SELECT doc_id, {q.clean_basic('text')} AS t FROM documents), c AS (SELECT doc_id, {POS} AS p, {NEG} AS n FROM d)
SELECT doc_id, CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS sentiment,
       round(CASE WHEN p + n = 0 THEN 0 ELSE greatest(p, n) / (p + n) END, 4) AS confidence FROM c
""")
def x1(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", clean_basic("text").alias("t"))
    scored = scoring.score_text(docs, "t", positive=POSITIVE, negative=NEGATIVE)
    return rounded(scored.select(
        "doc_id", F.col("score.label").alias("sentiment"), F.col("score.confidence").alias("confidence")
    ), "confidence")


@query("x2_sentiment_counts", f"""
WITH d AS (SELECT {q.clean_basic('text')} AS t FROM documents), c AS (SELECT {POS} AS p, {NEG} AS n FROM d)
SELECT CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' ELSE 'neutral' END AS sentiment, count(*) AS n,
       round(avg(CASE WHEN p + n = 0 THEN 0 ELSE greatest(p, n) / (p + n) END), 4) AS mean_confidence FROM c GROUP BY 1
""")
def x2(spark, sf):
    docs = table(spark, sf, "documents").select(clean_basic("text").alias("t"))
    scored = scoring.score_text(docs, "t", positive=POSITIVE, negative=NEGATIVE)
    return rounded(scored.groupBy(F.col("score.label").alias("sentiment")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score.confidence").alias("mean_confidence")
    ), "mean_confidence")


@query("x3_score_relevance", """
SELECT doc_id, CASE WHEN contains(text, 'ption') OR contains(text, 'heit') THEN 1 ELSE 0 END AS relevant FROM documents
""")
def x3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return scoring.score_relevance(docs, "text", words=["ption", "heit"]).select("doc_id", "relevant")


def embed_facts(docs, embedded):
    """(doc_id, n_dims, from_words): whether an embedding is the sum of the embeddings of its words,
    each of which has one dimension, at unit length; zero without words."""
    counts = stage(features.term_counts(docs.select("doc_id", word_tokens("text").alias("t")), "doc_id", "t"), "term_counts")
    words = scoring.embed(features.document_frequency(counts).withColumnRenamed("term", "text"), "text")
    places = words.select(F.col("text").alias("term"), "df", F.posexplode("embedding").alias("dim", "x")).where("x <> 0")
    met = join_split(counts, stage(places, "term_places"), "term", "df")
    sums = met.groupBy("doc_id", "dim").agg(F.sum(F.col("tf") * F.col("x")).alias("s"))
    # One row per document from here on, not one per dimension.
    want = sums.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("length"),
                                      F.map_from_entries(F.collect_list(F.struct("dim", "s"))).alias("sums"))
    got = embedded.select("doc_id", F.size("embedding").alias("n_dims"), "embedding").where("n_dims > 0")
    def wanted(i):
        return F.coalesce(F.try_element_at("sums", i) / F.col("length"), F.lit(0.0))
    same = F.transform("embedding", lambda x, i: F.abs(x - wanted(i)) < 1e-5)
    found = got.join(want, "doc_id", "left").select("doc_id", "n_dims", F.forall(same, lambda x: x).alias("same"))
    return found.groupBy("doc_id", "n_dims").agg(F.every("same").alias("from_words"))


@query("x5_embed", "SELECT doc_id, 64 AS n_dims, true AS from_words FROM documents")
def x5(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return embed_facts(docs, scoring.embed(docs, "text"))


def letter_encoder(texts: pd.Series) -> list:
    """Stand-in encoder: share of the letters a to e."""
    return [[t.count(c) / max(len(t), 1) for c in "abcde"] for t in texts]


@query("x5_embed_encoder", """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS dim,
       round(CAST(CAST((length(text) - length(replace(text, substr('abcde', i, 1), ''))) / length(text) AS FLOAT) AS DOUBLE), 4) AS weight
FROM documents, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS i)
""")
def x5_encoder(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    embedded = scoring.embed(docs, "text", encoder=letter_encoder)
    return rounded(embedded.select("doc_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "weight")), "weight")


def answer(topics: pd.Series) -> pd.Series:
    """Stand-in generator: five items after a preface; for some topics only four."""
    last = topics.map(lambda t: "" if t.endswith("7") else ", 'light'")
    return "Keywords follow.\n" + "'" + topics + " size', fast, cheap , small" + last


# Sources with an even number are in the cache, with an older and a newer row.
CACHE = """
SELECT DISTINCT source AS hobby, 'old' AS keyword1, 'b' AS keyword2, 'c' AS keyword3, 'd' AS keyword4, 'e' AS keyword5,
       TIMESTAMP '2025-02-01 00:00:00' AS created_at FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 2 = 0
UNION ALL
SELECT DISTINCT source, source || ' new', 'b', 'c', 'd', 'e',
       TIMESTAMP '2025-02-18 00:00:00' FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 4 = 0
"""
NEW = """
SELECT DISTINCT source AS hobby, source || ' size' AS keyword1, 'fast' AS keyword2, 'cheap' AS keyword3, 'small' AS keyword4,
       'light' AS keyword5, TIMESTAMP '2025-02-26 00:00:00' AS created_at FROM documents
WHERE CAST(substr(source, 4) AS INTEGER) % 2 = 1 AND source NOT LIKE '%7'
"""
RESOLVED = f"""
SELECT d.doc_id, d.source AS hobby, keyword1, keyword2, keyword3, keyword4, keyword5 FROM documents d LEFT JOIN (
  SELECT * FROM ({CACHE}) QUALIFY row_number() OVER (PARTITION BY hobby ORDER BY created_at DESC) = 1
  UNION ALL {NEW}) k ON d.source = k.hobby
"""


def resolved(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("hobby"))
    no = F.substring("hobby", 4, 10).cast("int")
    known = docs.select("hobby").distinct()
    rest = [F.lit(x).alias(f"keyword{i}") for i, x in enumerate("bcde", 2)]

    def rows(kept, first, at):
        return known.where(kept).select("hobby", first.alias("keyword1"), *rest, F.lit(at).cast("timestamp").alias("created_at"))

    cache = rows(no % 2 == 0, F.lit("old"), "2025-02-01").unionByName(
        rows(no % 4 == 0, F.concat("hobby", F.lit(" new")), "2025-02-18")
    )
    return scoring.resolve_keywords(docs, cache, answer, "2025-02-26", attempts=2)


@query("x6_resolve_keywords", RESOLVED)
def x6(spark, sf):
    return resolved(spark, sf)[0]


@query("x6_keyword_cache", f"{CACHE} UNION ALL {NEW}")
def x6_cache(spark, sf):
    return resolved(spark, sf)[1].withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("x7_recommendation_requests", f"""
SELECT doc_id, hobby, '취미: ' || hobby || chr(10) || '기능: ' || concat_ws(', ', keyword1, keyword2, keyword3, keyword4, keyword5)
       || chr(10) || '기준일: 2025년 02월 26일' AS prompt FROM ({RESOLVED}) WHERE keyword1 IS NOT NULL
""")
def x7(spark, sf):
    requests = scoring.recommendation_requests(
        resolved(spark, sf)[0], "취미: {hobby}\n기능: {keywords}\n기준일: {date}", "2025-02-26"
    )
    return requests.select("doc_id", "hobby", "prompt")
