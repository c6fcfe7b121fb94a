"""A: counts, statistics, word counts and reports."""

from pyspark.sql import functions as F

from catalog.registry import query, table
from catalog.reshaping import GAPS, gaps
from catalog.sqltext import clean_basic, grams, tokens, words
from voxlens.functions.text import clean_basic as clean
from voxlens.functions.text import words as split_words
from voxlens.operators import aggregate, lookup

# Frequent words of the corpus as exclude list, and as a keyword dictionary.
EXCLUDE = ["the", "of", "de", "la", "der", "die"]
TOPICS = {
    "function words": ["the", "of the", "in der", "Que", "nowhere to be found"],
    "endings": ["ation", "and the", "en la", "x"],
    "shared": ["the", "und"],
}


def in_list(ws) -> str:
    return ", ".join(f"'{w}'" for w in ws)


def topic_rows() -> str:
    return ", ".join(f"('{t}', '{k}')" for t, ks in TOPICS.items() for k in ks)


def rounded(df, *cols, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query("a1_count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def a1(spark, sf):
    return aggregate.count_rows(table(spark, sf, "lineitem"))


@query("a2_distinct_counts", f"""
WITH g AS ({GAPS})
SELECT 'event_id' AS "column", count(DISTINCT event_id) + max(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END) AS n_distinct FROM g
UNION ALL SELECT 'kind', count(DISTINCT kind) + max(CASE WHEN kind IS NULL THEN 1 ELSE 0 END) FROM g
UNION ALL SELECT 'props', count(DISTINCT props) + max(CASE WHEN props IS NULL THEN 1 ELSE 0 END) FROM g
""")
def a2(spark, sf):
    return aggregate.distinct_counts(gaps(spark, sf))


@query("a3_null_counts", f"""
WITH g AS ({GAPS})
SELECT 'event_id' AS "column", count(*) - count(event_id) AS n_missing FROM g
UNION ALL SELECT 'kind', count(*) - count(kind) FROM g
UNION ALL SELECT 'ratio', (SELECT count(*) FROM events WHERE user_id % 4 = 0) FROM (SELECT 1)
""")
def a3(spark, sf):
    ratio = F.when(F.col("user_id") % 4 == 0, float("nan")).otherwise(F.col("value"))
    kind = F.when(F.col("user_id") % 3 != 0, F.col("event_type"))
    return aggregate.null_counts(table(spark, sf, "events").select("event_id", kind.alias("kind"), ratio.alias("ratio")))


def describe_sql(tab: str, numbers: list[str], texts: list[str]) -> str:
    parts = [f"""
SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
       CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
       CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM {tab}""" for c in numbers]
    parts += [f"""
SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c}) FROM {tab}""" for c in texts]
    return " UNION ALL ".join(parts)


@query("a4_describe", describe_sql("part", ["p_partkey", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"]))
def a4(spark, sf):
    return rounded(aggregate.describe(table(spark, sf, "part")), "mean", "stddev")


QUARTERS = "VALUES (0.0), (0.25), (0.5), (0.75), (1.0)"


@query("a5_quantiles", f"""
SELECT CAST(p AS DOUBLE) AS p, round(quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0])[i], 4) AS value
FROM lineitem, (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS p, unnest([1, 2, 3, 4, 5]) AS i) GROUP BY p, i
""")
def a5(spark, sf):
    return rounded(aggregate.quantiles(table(spark, sf, "lineitem"), "l_extendedprice"), "value")


@query("a6_length_stats", """
WITH s AS (SELECT max(length(text)) AS a, min(length(text)) AS b, avg(length(text)) AS c, stddev_pop(length(text)) AS d,
  quantile_cont(length(text), 0.25) AS e, quantile_cont(length(text), 0.5) AS f, quantile_cont(length(text), 0.75) AS g FROM documents)
SELECT unnest(['max', 'min', 'mean', 'stddev_pop', 'q1', 'median', 'q3']) AS measure,
       round(CAST(unnest([a, b, c, d, e, f, g]) AS DOUBLE), 4) AS value FROM s
""")
def a6(spark, sf):
    return rounded(aggregate.length_stats(table(spark, sf, "documents"), "text"), "value")


@query("a7_count_by", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def a7(spark, sf):
    return aggregate.count_by(table(spark, sf, "documents"), ["lang", "source"])


@query("a8_count_by_day", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def a8(spark, sf):
    return aggregate.count_by_day(table(spark, sf, "events"), "ts")


@query("a9_count_by_month", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "year", CAST(month(o_orderdate) AS INTEGER) AS "month", count(*) AS n
FROM orders GROUP BY 1, 2
""")
def a9(spark, sf):
    return aggregate.count_by_month(table(spark, sf, "orders"), "o_orderdate")


@query("a10_mean_by", "SELECT event_type, round(avg(value), 4) AS mean FROM events GROUP BY event_type")
def a10(spark, sf):
    return rounded(aggregate.mean_by(table(spark, sf, "events"), "event_type", "value"), "mean")


@query("a11_score_summary", "SELECT max(value) AS max_score, round(avg(value), 4) AS mean_score FROM events")
def a11(spark, sf):
    return rounded(aggregate.score_summary(table(spark, sf, "events"), "value"), "mean_score")


@query("a12_class_share", """
SELECT lang, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent FROM documents GROUP BY lang
""")
def a12(spark, sf):
    return rounded(aggregate.class_share(table(spark, sf, "documents"), "lang"), "percent")


@query("a13_value_counts", "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY l_quantity")
def a13(spark, sf):
    return aggregate.value_counts(table(spark, sf, "lineitem"), "l_quantity")


@query("a14_histogram", """
WITH v AS (SELECT CAST(length(text) AS DOUBLE) AS v FROM documents),
b AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 30 AS step FROM v),
c AS (SELECT least(CAST(floor((v - lo) / step) AS BIGINT), 29) AS bin, count(*) AS n FROM v, b GROUP BY 1)
SELECT r.range AS bin, round(lo + r.range * step, 4) AS bin_from, round(lo + (r.range + 1) * step, 4) AS bin_to,
       coalesce(n, 0) AS n FROM range(30) r CROSS JOIN b LEFT JOIN c ON c.bin = r.range
""")
def a14(spark, sf):
    return rounded(aggregate.histogram(table(spark, sf, "documents"), F.length("text")), "bin_from", "bin_to")


@query("a15_unique_values", "SELECT DISTINCT source FROM documents")
def a15(spark, sf):
    return aggregate.unique_values(table(spark, sf, "documents"), "source")


@query("a16_overlap_count", """
SELECT count(*) AS n_common FROM (SELECT DISTINCT text FROM documents WHERE lang = 'en' AND source < 'src2'
  INTERSECT SELECT DISTINCT text FROM documents WHERE source >= 'src2')
""")
def a16(spark, sf):
    docs = table(spark, sf, "documents")
    return aggregate.overlap_count(docs.where("lang = 'en' and source < 'src2'"), docs.where("source >= 'src2'"), "text")


@query("a17_word_counts", f"""
SELECT word, count(*) AS n FROM (SELECT unnest({words(clean_basic('text'))}) AS word FROM documents)
GROUP BY word ORDER BY n DESC, word LIMIT 10
""")
def a17(spark, sf):
    return aggregate.word_counts(table(spark, sf, "documents").select(clean("text").alias("text")), "text", 10)


@query("a18_word_counts_by", f"""
WITH w AS (SELECT lang, unnest({words(clean_basic('text'))}) AS word FROM documents),
c AS (SELECT lang, word, count(*) AS n FROM w WHERE word NOT IN ({in_list(EXCLUDE)}) GROUP BY lang, word),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS INTEGER) AS rank FROM c)
SELECT * FROM r WHERE rank <= 30
""")
def a18(spark, sf):
    docs = table(spark, sf, "documents").select("lang", clean("text").alias("text"))
    return aggregate.word_counts_by(docs, "text", ["lang"], 30, EXCLUDE)


@query("a19_keyword_frequency", f"""
WITH dim(topic, keyword) AS (VALUES {topic_rows()}),
t AS (SELECT {tokens('text')} AS t FROM documents),
g AS (SELECT gram, count(*) AS hits FROM (SELECT unnest({grams('t')}) AS gram FROM t) GROUP BY gram)
SELECT topic, keyword, coalesce(hits, 0) AS n FROM dim LEFT JOIN g ON gram = lower(keyword)
""")
def a19(spark, sf):
    return aggregate.keyword_frequency(table(spark, sf, "documents"), lookup.keyword_table(spark, TOPICS), "text")


@query("a21_profile", f"""
WITH d AS ({describe_sql('customer', ['c_custkey', 'c_nationkey', 'c_acctbal'], ['c_name', 'c_mktsegment'])}),
l AS (
  SELECT "column", unnest(['n', 'mean', 'stddev', 'min_value', 'max_value']) AS measure,
         unnest([CAST(n AS DOUBLE), mean, stddev, min_value, max_value]) AS value, CAST(NULL AS VARCHAR) AS text FROM d
  UNION ALL SELECT "column", unnest(['min_text', 'max_text']), NULL, unnest([min_text, max_text]) FROM d
  UNION ALL SELECT unnest(['c_custkey', 'c_nationkey', 'c_acctbal', 'c_name', 'c_mktsegment']), 'n_distinct',
    CAST(unnest([count(DISTINCT c_custkey), count(DISTINCT c_nationkey), count(DISTINCT c_acctbal),
                 count(DISTINCT c_name), count(DISTINCT c_mktsegment)]) AS DOUBLE), NULL FROM customer
  UNION ALL SELECT unnest(['c_custkey', 'c_nationkey', 'c_acctbal', 'c_name', 'c_mktsegment']), 'n_missing',
    CAST(unnest([count(*) - count(c_custkey), count(*) - count(c_nationkey), count(*) - count(c_acctbal),
                 count(*) - count(c_name), count(*) - count(c_mktsegment)]) AS DOUBLE), NULL FROM customer
  UNION ALL SELECT unnest(['c_custkey', 'c_nationkey', 'c_acctbal', 'c_name', 'c_mktsegment']), 'type', NULL,
    unnest(['bigint', 'int', 'double', 'string', 'string']) FROM (SELECT 1)
  UNION ALL SELECT 'c_custkey', unnest(['p0', 'p25', 'p50', 'p75', 'p100']),
    unnest(quantile_cont(c_custkey, [0, 0.25, 0.5, 0.75, 1])), NULL FROM customer
  UNION ALL SELECT 'c_nationkey', unnest(['p0', 'p25', 'p50', 'p75', 'p100']),
    unnest(quantile_cont(c_nationkey, [0, 0.25, 0.5, 0.75, 1])), NULL FROM customer
  UNION ALL SELECT 'c_acctbal', unnest(['p0', 'p25', 'p50', 'p75', 'p100']),
    unnest(quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1])), NULL FROM customer)
SELECT "column", measure, round(value, 4) AS value, text FROM l WHERE value IS NOT NULL OR text IS NOT NULL
""")
def a21(spark, sf):
    return rounded(aggregate.profile(table(spark, sf, "customer")), "value")


@query("a22_answer_stability", f"""
WITH runs AS (SELECT lang, source, {words(clean_basic('text'))} AS items FROM documents),
n AS (SELECT lang, count(DISTINCT source) AS n_runs FROM runs GROUP BY lang),
h AS (SELECT lang, item, count(*) AS n_hits FROM (SELECT DISTINCT lang, source, unnest(items) AS item FROM runs) GROUP BY 1, 2)
SELECT lang, item, n_hits, n_runs, round(n_hits / n_runs, 4) AS share FROM h JOIN n USING (lang)
""")
def a22(spark, sf):
    runs = table(spark, sf, "documents").select("lang", "source", split_words(clean("text")).alias("items"))
    return rounded(aggregate.answer_stability(runs, "lang", "source", "items"), "share")


@query("t19_cloud_table", f"""
WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest({words(clean_basic('text'))}) AS word FROM documents)
  GROUP BY word ORDER BY n DESC, word LIMIT 50)
SELECT word, n, round(n / max(n) OVER (), 4) AS weight FROM c
""")
def t19(spark, sf):
    docs = table(spark, sf, "documents").select(clean("text").alias("text"))
    return rounded(aggregate.cloud_table(docs, "text", 50), "weight")
