"""J, W and L: lookups, ranking, limits, sampling."""

from pyspark.sql import functions as F

from catalog.profiling import TOPICS, topic_rows
from catalog.registry import query, table
from catalog.sqltext import clean_basic, grams, tokens, words
from voxlens.functions.text import clean_basic as clean
from voxlens.functions.text import words as split_words
from voxlens.operators import lookup, ranking

STOP = ["the", "of", "de", "la"]


@query("j1_semi_match", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def j1(spark, sf):
    owing = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return lookup.semi_match(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), owing, "o_custkey")


@query("j2_anti_match", """
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def j2(spark, sf):
    known = table(spark, sf, "labels").select("doc_id")
    return lookup.anti_match(table(spark, sf, "documents").select("doc_id", "source"), known, "doc_id")


@query("j3_lookup", """
SELECT d.doc_id, source, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def j3(spark, sf):
    return lookup.lookup(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


@query("j4_remove_words", f"""
SELECT doc_id, array_to_string(list_filter({words(clean_basic('text'))}, lambda w: w NOT IN ('the', 'of', 'de', 'la')), ' ') AS kept
FROM documents
""")
def j4(spark, sf):
    tokens_ = table(spark, sf, "documents").select("doc_id", split_words(clean("text")).alias("t"))
    return lookup.remove_words(tokens_, STOP, "t").select("doc_id", F.array_join("t", " ").alias("kept"))


@query("j4_remove_words_table", f"""
SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({words(clean_basic('text'))}) AS word FROM documents)
WHERE word NOT IN (SELECT unnest(['the', 'of', 'de', 'la'])) GROUP BY doc_id, word
""")
def j4_table(spark, sf):
    stop = lookup.word_table(spark, STOP)
    rows = table(spark, sf, "documents").select("doc_id", F.explode(split_words(clean("text"))).alias("word"))
    return lookup.remove_words(rows, stop, "word").groupBy("doc_id", "word").agg(F.count("word").alias("n"))


@query("j5_match_keywords", f"""
WITH dim(topic, keyword) AS (VALUES {topic_rows()}),
t AS (SELECT doc_id, {tokens('text')} AS t FROM documents),
g AS (SELECT doc_id, gram, count(*) AS hits FROM (SELECT doc_id, unnest({grams('t')}) AS gram FROM t) GROUP BY 1, 2)
SELECT doc_id, topic, keyword, hits FROM g JOIN dim ON gram = lower(keyword)
""")
def j5(spark, sf):
    return lookup.match_keywords(
        table(spark, sf, "documents"), lookup.keyword_table(spark, TOPICS), "doc_id", "text"
    )


LONG_KEYWORDS = {"license": ["released under the MIT license", "the apache license", "gnu general public license", "license"], "more": ["the mit license"]}


@query("j5_long_keywords", f"""
WITH dim(topic, keyword) AS (VALUES {', '.join(f"('{t}', '{k}')" for t, ks in LONG_KEYWORDS.items() for k in ks)}),
t AS (SELECT doc_id, {tokens('text')} AS t FROM documents),
c AS (SELECT topic, keyword, string_split(lower(keyword), ' ') AS k FROM dim),
h AS (SELECT doc_id, topic, keyword, len(list_filter(range(1, len(t) + 1), lambda i: t[i:i + len(k) - 1] = k)) AS hits
      FROM t JOIN c ON list_contains(t, k[1]))
SELECT doc_id, topic, keyword, hits FROM h WHERE hits > 0
""")
def j5_long(spark, sf):
    return lookup.match_keywords(
        table(spark, sf, "documents"), lookup.keyword_table(spark, LONG_KEYWORDS), "doc_id", "text"
    )


@query("w1_latest_per_key", """
SELECT user_id, ts, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def w1(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return ranking.latest_per_key(events, "user_id", "ts")


@query("w2_rank_slice", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 50 OFFSET 1")
def w2(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return ranking.rank_slice(events, [F.desc("value"), F.asc("event_id")], skip=1, take=50)


@query("w2_rank_slice_by", """
SELECT event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r BETWEEN 3 AND 12
""")
def w2_by(spark, sf):
    events = table(spark, sf, "events").select("event_type", "event_id", "value")
    return ranking.rank_slice(events, [F.desc("value"), F.asc("event_id")], skip=2, take=10, by=["event_type"])


@query("w3_top_per_group", """
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS r
  FROM lineitem) WHERE r <= 1500
""")
def w3(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey"
    )
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return ranking.top_per_group(lines, ["l_returnflag"], order, 1500).drop("l_partkey")


@query("l1_sort", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def l1(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ranking.sort(orders, F.desc("o_orderdate"), "o_orderkey")


@query("l2_longest_text", """
SELECT doc_id, text, CAST(length(text) AS INTEGER) AS "length" FROM documents ORDER BY length(text) DESC, doc_id LIMIT 1
""")
def l2(spark, sf):
    return ranking.extreme_text(table(spark, sf, "documents").select("doc_id", "text"), "text", 1, "doc_id")


@query("l2_shortest_text", """
SELECT doc_id, text, CAST(length(text) AS INTEGER) AS "length" FROM documents ORDER BY length(text), doc_id LIMIT 3
""")
def l2_short(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ranking.extreme_text(docs, "text", 3, "doc_id", longest=False)


@query("l3_top_n", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 50")
def l3(spark, sf):
    return ranking.top_n(table(spark, sf, "events").select("event_id", "value"), "value", 50, "event_id")


@query("l4_preview", "SELECT * FROM supplier ORDER BY s_suppkey DESC LIMIT 5")
def l4(spark, sf):
    return ranking.preview(table(spark, sf, "supplier"), 5, F.desc("s_suppkey"))


POINT = "try_cast('0x' || substr(md5('42:' || {0}), 1, 8) AS UBIGINT) / 4294967296.0"


@query("l5_sample", f"SELECT event_id, event_type FROM events WHERE {POINT.format('event_id')} < 0.1")
def l5(spark, sf):
    return ranking.sample(table(spark, sf, "events").select("event_id", "event_type"), 0.1, 42, "event_id")


@query("l5_sample_rows", "SELECT true AS from_table, true AS once, true AS a_tenth")
def l5_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    drawn = ranking.sample(events, 0.1, 42).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("times"))
    met = events.join(drawn, ["event_id", "event_type"], "full")
    rows = events.agg(F.count(F.lit(1))).scalar()
    return met.agg((F.count(F.lit(1)) == rows).alias("from_table"), F.every(F.coalesce("times", F.lit(1)) == 1).alias("once"),
                   (F.count("times") / F.count(F.lit(1))).between(0.05, 0.15).alias("a_tenth"))


@query("l6_split", f"""
SELECT doc_id, CASE WHEN {POINT.format('doc_id')} < 0.8 THEN 'train' ELSE 'test' END AS part FROM documents
""")
def l6(spark, sf):
    train, test = ranking.split(table(spark, sf, "documents").select("doc_id"), [0.8, 0.2], 42, "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("l6_split_rows", "SELECT doc_id, 1 AS n_parts FROM documents")
def l6_rows(spark, sf):
    train, test = ranking.split(table(spark, sf, "documents").select("doc_id"), [0.8, 0.2], 42)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("doc_id").agg(F.count("part").cast("int").alias("n_parts"))
