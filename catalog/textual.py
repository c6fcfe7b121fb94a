"""C: text cleaning, classes, answers."""

from pyspark.sql import functions as F

from catalog import sqltext as q
from catalog.profiling import in_list, rounded
from catalog.registry import query, table
from voxlens.functions import answers, text, vectors
from voxlens.operators import aggregate, reshape

FIRST = ("alpha", ["tion", "heit", "The"])
SECOND = ("beta", ["ción", "sch", "ment"])
POSITIVE = ["the", "der", "la", "que"]
NEGATIVE = ["of", "de", "and", "die"]


def docs(spark, sf, *cols):
    return table(spark, sf, "documents").select("doc_id", *cols)


def cleaner(name, fn, sql):
    @query(name, f"SELECT doc_id, {sql} AS cleaned FROM documents")
    def run(spark, sf):
        return docs(spark, sf, fn("text").alias("cleaned"))


cleaner("c1_clean_review", text.clean_review, q.clean_review("text"))
cleaner("c2_clean_basic", text.clean_basic, q.clean_basic("text"))
cleaner("c3_hangul_only", text.hangul_only, f"regexp_replace(text, '[^가-힣ㄱ-ㅎㅏ-ㅣ{q.SPACE}]', '', 'g')")
cleaner("c4_drop_emoticons", text.drop_emoticons, f"regexp_replace(text, '[^가-힣0-9a-zA-Z{q.SPACE}]', '', 'g')")
cleaner("c5_flatten_lines", text.flatten_lines, "replace(text, chr(10), ' ')")
cleaner("c6_clean_comment", text.clean_comment, q.clean_comment("text"))
cleaner("c8_ascii_only", text.ascii_only, r"regexp_replace(text, '[^\x00-\x7F]+', '', 'g')")
cleaner("c11_join_words", lambda c: text.join_words(text.words(c)), f"array_to_string({q.words('text')}, ' ')")
cleaner(
    "c12_min_length", lambda c: text.join_words(text.min_length(text.words(c), 2)),
    f"array_to_string(list_filter({q.words('text')}, lambda w: length(w) >= 2), ' ')",
)
cleaner("c17_last_line", answers.last_line, f"""
regexp_replace(string_split(regexp_replace(text, '^[{q.SPACE}]+|[{q.SPACE}]+$', '', 'g'), chr(10))[-1],
               '^[{q.SPACE}]+|[{q.SPACE}]+$', '', 'g')""")

# Runs of one letter are cut by looking two letters back, without a back-reference.
SOCIAL = f"""
WITH a AS (SELECT doc_id, regexp_replace(text, '{text.SOCIAL_DROP}', ' ', 'g') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '[{text.EMOJI}]', '', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '{text.URL}', '', 'g') AS t FROM b),
d AS (SELECT doc_id, unnest(string_split(t, '')) AS ch, generate_subscripts(string_split(t, ''), 1) AS i FROM c),
e AS (SELECT *, lag(ch) OVER w AS p1, lag(ch, 2) OVER w AS p2 FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, string_agg(ch, '' ORDER BY i) FILTER (WHERE NOT (regexp_matches(ch, '[{q.WORD}]')
      AND p1 IS NOT DISTINCT FROM ch AND p2 IS NOT DISTINCT FROM ch)) AS t FROM e GROUP BY doc_id)
SELECT doc_id, trim(regexp_replace(coalesce(t, ''), '[{q.SPACE}]+', ' ', 'g')) AS cleaned FROM documents LEFT JOIN f USING (doc_id)
"""


@query("c7_clean_social", SOCIAL)
def c7(spark, sf):
    return docs(spark, sf, text.clean_social("text").alias("cleaned"))


@query("c9_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS size, length(text) = n_chars AS same FROM documents")
def c9(spark, sf):
    return docs(spark, sf, F.length("text").alias("size"), (F.length("text") == F.col("n_chars")).alias("same"))


@query("c10_words", f"""
SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({q.words('text')}) AS word FROM documents) GROUP BY doc_id, word
""")
def c10(spark, sf):
    return docs(spark, sf, F.explode(text.words("text")).alias("word")).groupBy("doc_id", "word").agg(F.count("word").alias("n"))


@query("c13_date_parts", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS "year",
       CAST(month(o_orderdate) AS INTEGER) AS "month" FROM orders
""")
def c13(spark, sf):
    return aggregate.date_parts(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


def has_any(c, ws):
    return "(" + " OR ".join(f"contains({c}, '{w}')" for w in ws) + ")"


BRAND = (
    f"CASE WHEN {has_any('text', FIRST[1])} AND {has_any('text', SECOND[1])} THEN 'both' "
    f"WHEN {has_any('text', FIRST[1])} THEN 'alpha' WHEN {has_any('text', SECOND[1])} THEN 'beta' ELSE 'neither' END"
)


@query("c14_classify_brand", f"SELECT doc_id, {BRAND} AS brand FROM documents")
def c14(spark, sf):
    return docs(spark, sf, text.classify_brand("text", FIRST, SECOND).alias("brand"))


def polarity(tokens):
    pos = f"len(list_filter({tokens}, lambda w: w IN ({in_list(POSITIVE)})))"
    neg = f"len(list_filter({tokens}, lambda w: w IN ({in_list(NEGATIVE)})))"
    return f"CASE WHEN {pos} > {neg} THEN 'positive' WHEN {pos} < {neg} THEN 'negative' ELSE 'neutral' END"


@query("c15_lexicon_sentiment", f"SELECT doc_id, {polarity(q.words(q.clean_basic('text')))} AS sentiment FROM documents")
def c15(spark, sf):
    tokens = text.words(text.clean_basic("text"))
    return docs(spark, sf, text.lexicon_sentiment(tokens, POSITIVE, NEGATIVE).alias("sentiment"))


STRIP = f"regexp_replace(w, '^[{q.SPACE}]+|[{q.SPACE}]+$', '', 'g')"
ITEMS = f"list_transform(string_split(replace(text, '''', ''), ','), lambda w: {STRIP})"


@query("c16_parse_keywords", f"SELECT doc_id, CAST(len({ITEMS}) AS INTEGER) AS n, array_to_string({ITEMS}, '|') AS items FROM documents")
def c16(spark, sf):
    items = answers.parse_keywords("text")
    return docs(spark, sf, F.size(items).alias("n"), F.array_join(items, "|").alias("items"))


@query("c18_valid_keywords", f"""
SELECT doc_id, len({ITEMS}) = 5 AND len(list_filter({ITEMS}, lambda w: length(w) = 0)) = 0 AS valid FROM documents
""")
def c18(spark, sf):
    return docs(spark, sf, answers.valid_keywords(answers.parse_keywords("text")).alias("valid"))


@query("c19_spread_gather", f"""
WITH t AS (SELECT doc_id, {ITEMS} AS k FROM documents)
SELECT doc_id, k[1] AS keyword1, k[2] AS keyword2, k[3] AS keyword3, k[4] AS keyword4, k[5] AS keyword5,
       array_to_string(list_filter(k[1:5], lambda w: w IS NOT NULL AND w <> ''), '|') AS gathered FROM t
""")
def c19(spark, sf):
    items = docs(spark, sf, answers.parse_keywords("text").alias("k"))
    spread = items.select("doc_id", *answers.spread_keywords("k"))
    return spread.withColumn("gathered", F.array_join(answers.gather_keywords(), "|"))


@query("c20_build_prompt", """
SELECT o_orderkey, 'Order ' || o_orderkey || ' (' || o_orderstatus || ') on ' || strftime(o_orderdate, '%Y-%m-%d')
       || ': ' || o_orderpriority || ', again ' || o_orderkey || '.' AS prompt FROM orders
""")
def c20(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", answers.build_prompt(
        "Order {key} ({status}) on {day}: {priority}, again {key}.", key="o_orderkey", status="o_orderstatus",
        day=F.date_format("o_orderdate", "yyyy-MM-dd"), priority="o_orderpriority",
    ).alias("prompt"))


@query("c21_parse_flag", """
SELECT event_id, CASE WHEN contains(props->>'$.k', '1') THEN 1 ELSE 0 END AS flag FROM events
""")
def c21(spark, sf):
    return table(spark, sf, "events").select("event_id", answers.parse_flag(F.get_json_object("props", "$.k")).alias("flag"))


@query("c22_top_label", """
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 50 AS a, l_discount * 10 AS b, l_tax * 10 AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN a >= b AND a >= c THEN 'negative' WHEN b >= c THEN 'neutral' ELSE 'positive' END AS label,
       round(exp(greatest(a, b, c)) / (exp(a) + exp(b) + exp(c)), 4) AS confidence,
       round((exp(a) + exp(b) + exp(c)) / (exp(a) + exp(b) + exp(c)), 4) AS total FROM s
""")
def c22(spark, sf):
    scores = F.array(F.col("l_quantity") / 50, F.col("l_discount") * 10, F.col("l_tax") * 10)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scores.alias("s"))
    best = lines.withColumn("b", vectors.top_label("s", ["negative", "neutral", "positive"]))
    total = F.aggregate(vectors.softmax("s"), F.lit(0.0), lambda a, x: a + x)
    return rounded(best.withColumn("total", total).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "b.label", "b.confidence", "total"
    ), "confidence", "total")


@query("c23_parse_nested", """
SELECT doc_id, array_to_string(list_transform(string_split(replace(text, '''', ''), ','), lambda w: w), '|') AS items FROM documents
""")
def c23(spark, sf):
    pieces = F.transform(F.split(F.translate("text", "'", ""), ","), lambda w: F.concat(F.lit("['"), w, F.lit("']")))
    printed = docs(spark, sf, F.concat(F.lit("["), F.array_join(pieces, ", "), F.lit("]")).alias("outputs"))
    return printed.select("doc_id", F.array_join(answers.parse_nested("outputs"), "|").alias("items"))


def special(c):
    return f"regexp_matches({c}, '[^{q.WORD}{q.SPACE}]')"


@query("c24_flag_special", f"""
SELECT *, {special('p_name')} AS p_name_specials, {special('p_brand')} AS p_brand_specials,
       {special('CAST(p_retailprice AS VARCHAR)')} AS p_retailprice_specials
FROM (SELECT p_partkey, p_name, p_brand, p_retailprice FROM part)
""")
def c24(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    return reshape.flag_special(part, ["p_name", "p_brand", "p_retailprice"])


def cleaned(c):
    return f"regexp_replace(CAST({c} AS VARCHAR), '[^{q.WORD}{q.SPACE}]', '', 'g')"


@query("c25_clean_all", f"""
SELECT {cleaned('doc_id')} AS doc_id, {cleaned('text')} AS text, {cleaned('lang')} AS lang, {cleaned('source')} AS source FROM documents
""")
def c25(spark, sf):
    return reshape.clean_all(docs(spark, sf, "text", "lang", "source"))
