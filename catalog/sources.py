"""S: sources and sinks. Sinks write to a fresh place in the shared folder and are read back.

S4, S9 and S10 need a database and have no query; their functions are in
``voxlens.sources.database`` with tests of what they send.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.derived import comments_raw
from catalog.registry import query, table
from catalog.sqltext import COMMENTS_RAW
from voxlens.operators.reshape import flatten_threads
from voxlens.session import fresh_path
from voxlens.sources import files

PART = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType()),
])
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
])


@query("s1_read_parquet", "SELECT * FROM part")
def s1(spark, sf):
    return files.read_parquet(spark, f"{sf}/part.parquet", PART)


@query("s2_read_csv", "SELECT doc_id, text, lang FROM documents")
def s2(spark, sf):
    path = fresh_path(spark, "documents_csv")
    files.write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return files.read_csv(spark, path, DOCS, multiline=True)


@query("s3_read_threads", COMMENTS_RAW)
def s3(spark, sf):
    path = fresh_path(spark, "threads")
    files.write_threads(comments_raw(spark, sf), path)
    return flatten_threads(files.read_threads(spark, path))


@query("s5_catalog_preview", """
SELECT 'customer' AS "table", count(*) AS n_rows, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS columns FROM customer
UNION ALL SELECT 'labels', count(*), 'doc_id,quality,toxic' FROM labels
UNION ALL SELECT 'part', count(*), 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' FROM part
""")
def s5(spark, sf):
    return files.preview_counts(spark, {n: table(spark, sf, n) for n in ("customer", "labels", "part")})


@query("s5_preview_rows", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def s5_rows(spark, sf):
    return files.catalog_preview(table(spark, sf, "customer"), 5, "c_custkey")


@query("s6_write_parquet", "SELECT doc_id, text, source, lang FROM documents")
def s6(spark, sf):
    path = fresh_path(spark, "by_lang")
    files.write_parquet(table(spark, sf, "documents").select("doc_id", "text", "source", "lang"), path, ["lang"])
    return files.read_parquet(spark, path)


@query("s7_write_csv", "SELECT * FROM events")
def s7(spark, sf):
    path = fresh_path(spark, "events_csv")
    events = table(spark, sf, "events")
    files.write_csv(events, path, [F.desc("event_id")])
    return files.read_csv(spark, path, events.schema)


def written_in_parts(spark, sf):
    path = fresh_path(spark, "threads")
    # A small bound, so that the longer threads are written in several parts.
    files.write_threads(comments_raw(spark, sf), path, max_comments=4)
    return files.read_threads(spark, path)


@query("s8_write_threads", COMMENTS_RAW)
def s8(spark, sf):
    return flatten_threads(written_in_parts(spark, sf))


@query("s8_thread_totals", f"""
SELECT video_id, count(*) AS n_comments, count(*) AS total FROM ({COMMENTS_RAW}) GROUP BY video_id
""")
def s8_totals(spark, sf):
    return files.thread_totals(written_in_parts(spark, sf))


@query("s11_refresh_landing", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def s11(spark, sf):
    path = fresh_path(spark, "landing")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    files.refresh_landing(orders, path, must_be_new=True)
    # The second refresh reads the folder that it replaces.
    files.refresh_landing(files.read_parquet(spark, path).where("o_orderstatus <> 'F'"), path)
    return files.read_parquet(spark, path)


@query("s11_append_landing", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def s11_append(spark, sf):
    path = fresh_path(spark, "landing")
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    files.refresh_landing(supplier, path)
    files.append_landing(supplier, path)
    return files.read_parquet(spark, path)


RUN_SQL = """
SELECT n_name, count(*) AS n_customers, round(avg(c_acctbal), 4) AS mean_balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
"""


@query("s12_run_sql", RUN_SQL)
def s12(spark, sf):
    return files.run_sql(spark, {n: table(spark, sf, n) for n in ("customer", "nation")}, RUN_SQL)
