"""P, F and U: parsing, reshaping, filters, set operations."""

from pyspark.sql import functions as F

from catalog.derived import comments_raw, reviews_raw
from catalog.registry import query, table
from catalog.sqltext import COMMENTS_RAW, REVIEWS_RAW, tokens, unescape
from voxlens.functions.text import word_tokens
from voxlens.operators import filters, lookup, pages, reshape
from voxlens.sources.files import nest_threads


@query("p1_flatten_threads", COMMENTS_RAW)
def p1(spark, sf):
    return reshape.flatten_threads(nest_threads(comments_raw(spark, sf), max_comments=5))


@query("p2_project_fields", "SELECT event_id, props->>'$.k' AS k, props->>'$.missing' AS missing FROM events")
def p2(spark, sf):
    events = table(spark, sf, "events")
    return reshape.project_fields(events, {"k": "k", "missing": "missing"}, json_col="props", keep=["event_id"])


@query("p2_project_struct", "SELECT event_id AS id, event_type AS kind, user_id AS author FROM events")
def p2_struct(spark, sf):
    snippet = F.struct("event_type", F.struct("user_id").alias("channel")).alias("snippet")
    nested = table(spark, sf, "events").select("event_id", snippet)
    return reshape.project_fields(
        nested, {"id": "event_id", "kind": "snippet.event_type", "author": "snippet.channel.user_id"}
    )


ORDER_TEXT = "CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END"


@query("p3_parse_timestamps", f"""
SELECT o_orderkey, try_strptime({ORDER_TEXT}, '%Y-%m-%dT%H:%M:%SZ') AS ordered,
       try_strptime(strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') AS next_day
FROM orders
""")
def p3(spark, sf):
    iso = reshape.ISO_FORMAT
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 10 == 0, "soon").otherwise(F.date_format("o_orderdate", iso)).alias("ordered"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), iso).alias("next_day"),
    )
    parsed = reshape.parse_timestamps(text, ["ordered", "next_day"])
    return parsed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("ordered", "next_day")})


@query("p4_cast_columns", """
SELECT event_id, try_cast(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts,
       try_cast(event_type AS INTEGER) AS event_type, try_cast(props->>'$.k' AS INTEGER) AS k FROM events
""")
def p4(spark, sf):
    text = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type",
        F.get_json_object("props", "$.k").alias("k"),
    )
    return reshape.cast_columns(text, {"ts": "timestamp_ntz", "event_type": "int", "k": "int"})


@query("p5_parse_score", f"""
SELECT market, item, review_title, try_cast(trim(replace(scoring, '점', '')) AS DOUBLE) AS scoring FROM ({REVIEWS_RAW})
""")
def p5(spark, sf):
    return reshape.parse_score(reviews_raw(spark, sf).select("market", "item", "review_title", "scoring"), "scoring")


@query("p6_reorder", "SELECT c_name AS customer, c_custkey, c_mktsegment AS segment FROM customer")
def p6(spark, sf):
    return reshape.reorder(
        table(spark, sf, "customer"), ["c_name", "c_custkey", "c_mktsegment"],
        {"c_name": "customer", "c_mktsegment": "segment"},
    )


@query("p7_with_constant", "SELECT s_suppkey, 'review' AS kind, 3 AS load_no FROM supplier")
def p7(spark, sf):
    base = table(spark, sf, "supplier").select("s_suppkey")
    return reshape.with_constant(reshape.with_constant(base, "kind", "review"), "load_no", 3)


RULES = {"href": r'<a\s[^>]*?href="([^"]*)"', "label": r"<a\s[^>]*>([^<]*)</a>", "paragraph": r"<p>([^<]*)</p>"}
P8_LISTS = ", ".join(f"regexp_extract_all(html, '{r}', 1) AS {n}" for n, r in RULES.items())


@query("p8_zip_fields", f"""
WITH lists AS (SELECT page_id, {P8_LISTS} FROM pages),
spots AS (SELECT *, unnest(range(1, 1 + least(len(href), len(label), len(paragraph)))) AS i FROM lists)
SELECT page_id, {unescape('href[i]')} AS href, {unescape('label[i]')} AS label, {unescape('paragraph[i]')} AS paragraph
FROM spots
""")
def p8(spark, sf):
    lists = pages.extract_page_fields(table(spark, sf, "pages"), RULES, keep=["page_id"])
    return reshape.zip_fields(lists, list(RULES), keep=["page_id"])


@query("p9_tag_item", """
SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'ring' WHEN contains(p_name, 'widget') THEN 'widget'
                       WHEN contains(p_name, 'blue') THEN 'blue' END AS item FROM part
""")
def p9(spark, sf):
    return reshape.tag_item(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", ["ring", "widget", "blue"]).drop("p_name")


@query("p10_extract_page_fields", f"""
SELECT page_id, {unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
       {unescape("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS heading FROM pages
""")
def p10(spark, sf):
    fields = pages.extract_page_fields(
        table(spark, sf, "pages"), {"title": "<title>([^<]*)</title>", "heading": "<h1>([^<]*)</h1>"}, keep=["page_id"]
    )
    return fields.select("page_id", F.get("title", F.lit(0)).alias("title"), F.get("heading", F.lit(0)).alias("heading"))


@query("p10_extract_links", rf"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS a FROM pages),
i AS (SELECT page_id, a, unnest(range(1, 1 + len(a))) AS i FROM l)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {unescape('a[i]')} AS href FROM i
""")
def p10_links(spark, sf):
    return pages.extract_links(table(spark, sf, "pages"), keep=["page_id"])


@query("p10_extract_nested_fields", f"""
WITH n AS (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS nav FROM pages)
SELECT page_id, {unescape("""array_to_string(regexp_extract_all(nav, '<a [^>]*>([^<]*)</a>', 1), '|')""")} AS links FROM n
""")
def p10_nested(spark, sf):
    fields = pages.extract_nested_fields(table(spark, sf, "pages"), {"links": ("nav ul > li a", None)}, keep=["page_id"])
    return fields.select("page_id", F.array_join("links", "|").alias("links"))


@query("p11_page_window", """
SELECT page_id, CAST(1 + page_id % 7 * 10 AS INTEGER) AS "current",
       CAST(1 + page_id % 7 * 10 + page_id % 10 AS INTEGER) AS "last",
       CAST(1 + page_id % 10 AS INTEGER) AS n_listed, page_id % 10 = 9 AS has_next FROM pages
""")
def p11(spark, sf):
    """The given pages, with a counter and a page list put behind them."""
    first = 1 + F.col("page_id") % 7 * 10
    further = F.when(
        F.col("page_id") % 10 > 0, F.sequence(first + 1, first + F.col("page_id") % 10)
    ).otherwise(F.array().cast("array<bigint>"))
    links = F.transform(further, lambda n: F.concat(F.lit('<a data-pagenumber="'), n.cast("string"), F.lit('">next</a>')))
    html = F.concat(
        F.coalesce("html", F.lit("")), F.lit(f'<div><span>3</span></div><div id="{pages.LIST[1:]}"><div><div><div><span>'),
        first.cast("string"), F.lit("</span>"), F.array_join(links, ""), F.lit("</div></div></div></div>"),
    )
    return pages.page_window(table(spark, sf, "pages").select("page_id", html.alias("html")), keep=["page_id"])


GAPS = "SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE event_type END AS kind, props FROM events"


def gaps(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("kind"), "props"
    )


@query("p12_fill_blank", f"SELECT event_id, coalesce(kind, '') AS kind FROM ({GAPS})")
def p12(spark, sf):
    return reshape.fill_blank(gaps(spark, sf).select("event_id", "kind"), ["kind"])


@query("p13_stamp", "SELECT s_suppkey, TIMESTAMP '2025-02-11 09:00:00' AS load_date FROM supplier")
def p13(spark, sf):
    stamped = reshape.stamp(table(spark, sf, "supplier").select("s_suppkey"), "load_date", "2025-02-11 09:00:00")
    return stamped.withColumn("load_date", F.col("load_date").cast("timestamp_ntz"))


@query("f1_exclude_values", f"SELECT * FROM ({GAPS}) WHERE kind IS NULL OR kind NOT IN ('error', 'click')")
def f1(spark, sf):
    return filters.exclude_values(gaps(spark, sf), "kind", ["error", "click"])


@query("f2_published_after", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16 12:00:00'")
def f2(spark, sf):
    start = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    return filters.published_after(table(spark, sf, "events").select("event_id", "ts"), "ts", start)


@query("f3_drop_incomplete", f"SELECT * FROM ({GAPS}) WHERE kind IS NOT NULL AND event_id IS NOT NULL AND props IS NOT NULL")
def f3(spark, sf):
    return filters.drop_incomplete(gaps(spark, sf))


@query("f4_keep_values", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def f4(spark, sf):
    return filters.keep_values(
        table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH"]
    )


@query("f5_contains", "SELECT doc_id, lang FROM documents WHERE contains(text, 'the')")
def f5(spark, sf):
    return filters.contains(table(spark, sf, "documents"), "text", "the").select("doc_id", "lang")


@query("f6_contains_any", "SELECT doc_id, lang FROM documents WHERE contains(text, 'ption') OR contains(text, '@') OR contains(text, 'ß.')")
def f6(spark, sf):
    return filters.contains_any(table(spark, sf, "documents"), "text", ["ption", "@", "ß."]).select("doc_id", "lang")


@query("f7_keep_text", f"SELECT event_id, kind FROM ({GAPS}) WHERE kind IS NOT NULL")
def f7(spark, sf):
    return filters.keep_text(gaps(spark, sf).select("event_id", "kind"), "kind")


@query("f8_coalesce_tokens", f"""
SELECT doc_id, CAST(CASE WHEN lang = 'en' THEN 0 ELSE len({tokens('text')}) END AS INTEGER) AS n_tokens FROM documents
""")
def f8(spark, sf):
    listed = table(spark, sf, "documents").select("doc_id", F.when(F.col("lang") != "en", word_tokens("text")).alias("t"))
    return filters.coalesce_tokens(listed, "t").select("doc_id", F.size("t").alias("n_tokens"))


@query("f9_valid_links", "SELECT page_id, url FROM pages WHERE url <> '#' AND url <> '' AND contains(url, 'page=')")
def f9(spark, sf):
    return filters.valid_links(table(spark, sf, "pages").select("page_id", "url"), "url", "page=")


@query("u1_union_all", """
SELECT doc_id AS id, text, lang FROM documents UNION ALL SELECT item_id, text, NULL FROM benchmark
""")
def u1(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    return lookup.union_all([docs, table(spark, sf, "benchmark").select("text", F.col("item_id").alias("id"))])


@query("u2_dedup", "SELECT DISTINCT text, lang FROM documents")
def u2(spark, sf):
    return lookup.dedup(table(spark, sf, "documents").select("text", "lang"))


@query("u3_merge_cache", """
SELECT user_id, event_type FROM (
  SELECT user_id, min(event_type) AS event_type FROM events WHERE value < 10 GROUP BY user_id
  UNION ALL
  SELECT user_id, min(event_type) FROM events WHERE value >= 10 AND user_id NOT IN
    (SELECT user_id FROM events WHERE value < 10) GROUP BY user_id)
""")
def u3(spark, sf):
    events = table(spark, sf, "events")
    old = events.where("value < 10").groupBy("user_id").agg(F.min("event_type").alias("event_type"))
    return lookup.merge_cache(old, events.where("value >= 10").select("user_id", "event_type"), "user_id")


@query("u4_merge_words", """
SELECT lower(o_orderpriority) AS word FROM orders UNION SELECT event_type FROM events UNION SELECT 'error'
""")
def u4(spark, sf):
    return lookup.merge_words(
        table(spark, sf, "orders").select(F.lower("o_orderpriority").alias("w")),
        table(spark, sf, "events").select("event_type"),
        lookup.word_table(spark, ["error"]),
    )
