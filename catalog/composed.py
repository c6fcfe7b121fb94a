"""B: composed jobs. Inputs are landed first, results are read back from the sink."""

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.derived import comments_raw, reviews_raw
from catalog.modelled import cost_facts, placed, silhouette_facts
from catalog.modelled import table
from catalog.profiling import EXCLUDE, TOPICS, in_list, rounded, topic_rows
from catalog.registry import query
from catalog.textual import BRAND, FIRST, NEGATIVE, POSITIVE, SECOND, polarity
from voxlens.operators import lookup
from voxlens.plans import jobs
from voxlens.session import fresh_path
from voxlens.sources import files

PARSED = """
SELECT DISTINCT video_id, title, try_strptime(publish_date, '%Y-%m-%dT%H:%M:%SZ') AS publish_date, channel_name, comment,
       like_count, try_strptime(comment_publish_date, '%Y-%m-%dT%H:%M:%SZ') AS comment_publish_date
"""


@query("b1_comment_etl", f"SELECT * FROM ({PARSED} FROM ({q.COMMENTS_RAW})) WHERE comment_publish_date IS NOT NULL")
def b1(spark, sf):
    raw = comments_raw(spark, sf)
    # Landed twice: the job has to drop the copies.
    landed = [files.round_trip(raw, "comments"), files.round_trip(raw, "comments")]
    target = fresh_path(spark, "comments_served")
    jobs.comment_etl(spark, landed, jobs.landing_sink(target))
    served = files.read_parquet(spark, target)
    return served.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("publish_date", "comment_publish_date")})


@query("b2_review_etl", f"""
SELECT DISTINCT try_cast(trim(replace(scoring, '점', '')) AS INTEGER) AS scoring, market,
       CAST(purchasing_date AS TIMESTAMP) AS purchasing_date, review_title, review_content, item
FROM ({q.REVIEWS_RAW}) WHERE try_cast(trim(replace(scoring, '점', '')) AS INTEGER) IS NOT NULL
""")
def b2(spark, sf):
    landed = files.round_trip(reviews_raw(spark, sf), "reviews")
    target = fresh_path(spark, "reviews_served")
    jobs.review_etl(spark, landed, jobs.landing_sink(target))
    served = files.read_parquet(spark, target)
    return served.withColumn("purchasing_date", F.col("purchasing_date").cast("timestamp_ntz"))


@query("b3_ingest_threads", f"""
SELECT * FROM ({q.COMMENTS_RAW}) WHERE channel_name <> 'channel3' AND publish_date >= '2024-01-10T00:00:00Z'
""")
def b3(spark, sf):
    source, landing = fresh_path(spark, "threads"), fresh_path(spark, "landing")
    files.write_threads(comments_raw(spark, sf), source)
    jobs.ingest_threads(spark, source, jobs.landing_sink(landing), "2024-01-10T00:00:00Z", ["channel3"])
    return files.read_parquet(spark, landing)


@query("b4_corpus_profile", """
WITH r AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority || ' of ' || o_custkey AS text FROM orders),
b AS (SELECT min(length(text)) AS lo, (max(length(text)) - min(length(text))) / 30 AS step FROM r),
h AS (SELECT least(CAST(floor((length(text) - lo) / step) AS BIGINT), 29) AS bin, count(*) AS n FROM r, b GROUP BY 1)
SELECT 'per_day' AS report, strftime(o_orderdate, '%Y-%m-%d') AS label, count(*) AS n FROM r GROUP BY 2
UNION ALL SELECT 'per_month', CAST(year(o_orderdate) AS VARCHAR) || '-' || month(o_orderdate), count(*) FROM r GROUP BY 2
UNION ALL SELECT 'scores', CAST(o_custkey AS VARCHAR), count(*) FROM r GROUP BY 2
UNION ALL SELECT 'lengths', CAST(range AS VARCHAR), coalesce(n, 0) FROM range(30) LEFT JOIN h ON bin = range
UNION ALL SELECT 'longest', text, length(text) FROM (SELECT text FROM r ORDER BY length(text) DESC, o_orderkey LIMIT 1)
UNION ALL SELECT 'shortest', text, length(text) FROM (SELECT text FROM r ORDER BY length(text), o_orderkey LIMIT 1)
UNION ALL SELECT 'profile', unnest(['o_orderkey', 'o_custkey', 'text_length']),
  unnest([count(DISTINCT o_orderkey), count(DISTINCT o_custkey), count(DISTINCT length(text))]) FROM r
""")
def b4(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.concat("o_orderpriority", F.lit(" of "), F.col("o_custkey").cast("string")).alias("text"),
    )
    reports = jobs.corpus_profile(rows, "text", "o_custkey", "o_orderdate", "o_orderkey")
    label = {
        "per_day": (F.col("day").cast("string"), "n"),
        "per_month": (F.concat_ws("-", "year", "month"), "n"),
        "scores": (F.col("o_custkey").cast("string"), "n"),
        "lengths": (F.col("bin").cast("string"), "n"),
        "longest": (F.col("text"), "length"),
        "shortest": (F.col("text"), "length"),
        "profile": (F.col("column"), "value"),
    }
    reports["profile"] = reports["profile"].where("measure = 'n_distinct'")
    return lookup.union_all([
        reports[name].select(F.lit(name).alias("report"), col.alias("label"), F.col(n).cast("long").alias("n"))
        for name, (col, n) in label.items()
    ])


@query("b5_sentiment_words", f"""
WITH t AS (SELECT lang, list_filter({q.words(q.clean_review('text'))}, lambda w: w NOT IN ('to', 'in')) AS t FROM documents),
s AS (SELECT lang, {polarity('t')} AS sentiment, t FROM t),
c AS (SELECT lang, sentiment, word, count(*) AS n FROM (SELECT lang, sentiment, unnest(t) AS word FROM s WHERE sentiment <> 'neutral')
      WHERE word NOT IN ({in_list(EXCLUDE)}) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, sentiment ORDER BY n DESC, word) AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 30
""")
def b5(spark, sf):
    return jobs.sentiment_words(
        table(spark, sf, "documents"), "lang", "text", POSITIVE, NEGATIVE, ["to", "in"], 30, EXCLUDE
    )


BRANDED = f"SELECT text, {BRAND} AS brand FROM (SELECT DISTINCT text FROM documents)"


def brand_report(spark, sf):
    dim = lookup.keyword_table(spark, TOPICS)
    return jobs.brand_report(table(spark, sf, "documents"), "text", FIRST, SECOND, dim, EXCLUDE)


@query("b6_brand_shares", f"""
SELECT brand, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent FROM ({BRANDED}) GROUP BY brand
""")
def b6_shares(spark, sf):
    return rounded(brand_report(spark, sf)["shares"], "percent")


@query("b6_brand_words", f"""
WITH w AS (SELECT brand, unnest({q.tokens(q.clean_comment('text'))}) AS word FROM ({BRANDED}) WHERE brand IN ('alpha', 'beta')),
c AS (SELECT brand, word, count(*) AS n FROM w WHERE word NOT IN ({in_list(EXCLUDE)}) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY brand ORDER BY n DESC, word) AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 10
""")
def b6_words(spark, sf):
    return brand_report(spark, sf)["words"]


@query("b6_brand_keywords", f"""
WITH dim(topic, keyword) AS (VALUES {topic_rows()}),
t AS (SELECT brand, {q.tokens('text')} AS t FROM ({BRANDED}) WHERE brand IN ('alpha', 'beta')),
g AS (SELECT brand, gram, count(*) AS n FROM (SELECT brand, unnest({q.grams('t')}) AS gram FROM t) GROUP BY ALL)
SELECT brand, topic, keyword, n FROM g JOIN dim ON gram = lower(keyword)
""")
def b6_keywords(spark, sf):
    return brand_report(spark, sf)["keywords"]


@query("b7_cluster_corpus", """
SELECT 'size' AS report, CAST(count(*) AS BIGINT) AS n, true AS good FROM documents
UNION ALL SELECT 'cost', 8, true UNION ALL SELECT 'silhouette', 4, true
""")
def b7(spark, sf):
    reports = jobs.cluster_corpus(table(spark, sf, "documents"), "doc_id", "text", words=EXCLUDE)
    rows, fits = reports["vectors"], reports["fits"]
    sizes = placed(rows, fits[2], reports["clusters"]).agg(F.count("doc_id").alias("n"), F.every("placed").alias("placed"))
    sizes = sizes.join(reports["sizes"].agg(F.sum("n").alias("n")), "n")
    cost = cost_facts(rows, fits, reports["elbow"])
    scores = silhouette_facts(rows, {k: fits[k] for k in range(2, 6)}, reports["silhouette"])
    return lookup.union_all([
        sizes.select(F.lit("size").alias("report"), "n", F.col("placed").alias("good")),
        cost.agg(F.lit("cost").alias("report"), F.count("k").alias("n"), F.every(F.col("recomputed") & F.col("better_than_one")).alias("good")),
        scores.agg(F.lit("silhouette").alias("report"), F.count("k").alias("n"), F.every("recomputed").alias("good")),
    ])


@query("b8_score_report", f"""
WITH s AS (SELECT item, try_cast(trim(replace(scoring, '점', '')) AS DOUBLE) AS score FROM ({q.REVIEWS_RAW}))
SELECT item, CAST(grouping(item) AS TINYINT) AS is_total, max(score) AS max_score, round(avg(score), 4) AS mean_score
FROM s WHERE score IS NOT NULL GROUP BY ROLLUP (item)
""")
def b8(spark, sf):
    return rounded(jobs.score_report(reviews_raw(spark, sf), "item", "scoring"), "mean_score")
