"""Files, landing folders, and what is sent to a database."""

import json

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from voxlens import schemas
from voxlens.operators.reshape import flatten_threads
from voxlens.plans import jobs
from voxlens.session import fresh_path, shared_root
from voxlens.sources import database, files

COMMENT = {"comment": "좋다 \"폰\"", "like_count": 2, "published_at": "2024-10-01T00:00:00Z"}
THREADS = {
    "v1": {"title": "제목", "published_at": "2024-09-10T00:00:00Z", "channel_title": "채널", "comments": [COMMENT, COMMENT]},
    "v2": {"title": "t", "published_at": "2024-01-01T00:00:00Z", "channel_title": "c", "comments": [COMMENT]},
    "v3": {"title": "t", "published_at": "2024-12-01T00:00:00Z", "channel_title": "보겸TV", "comments": [COMMENT]},
    "v4": {"title": "t", "published_at": "2024-12-01T00:00:00Z", "channel_title": "c", "comments": []},
}


def printed(tmp_path):
    path = tmp_path / "threads.json"
    path.write_text(json.dumps(THREADS, ensure_ascii=False, indent=4), encoding="utf-8")
    return str(path)


def test_printed_thread_file(spark, tmp_path):
    flat = flatten_threads(files.read_threads(spark, printed(tmp_path), multiline=True))
    assert flat.schema.fieldNames() == schemas.COMMENTS_RAW.fieldNames()
    assert sorted(r["video_id"] for r in flat.collect()) == ["v1", "v1", "v2", "v3"]


def test_broken_thread_line_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"v1": {"title": "t"\n')
    with pytest.raises(Exception):
        files.read_threads(spark, str(tmp_path / "x.json")).collect()


def test_threads_keep_non_ascii_text(spark, tmp_path):
    flat = flatten_threads(files.read_threads(spark, printed(tmp_path), multiline=True))
    out = fresh_path(spark, "threads")
    files.write_threads(flat, out)
    assert any("제목" in r["value"] for r in spark.read.text(out).collect())
    back = flatten_threads(files.read_threads(spark, out))
    assert back.exceptAll(flat).count() == 0 and flat.exceptAll(back).count() == 0


def test_ingest(spark, tmp_path):
    landing = fresh_path(spark, "landing")
    n = jobs.ingest_threads(spark, printed(tmp_path), jobs.landing_sink(landing), "2024-02-01T00:00:00Z", multiline=True)
    assert n == 2 and [r["video_id"] for r in files.read_parquet(spark, landing).collect()] == ["v1", "v1"]


def test_text_file_named_parquet_fails(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("not a table")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        files.read_parquet(spark, str(tmp_path / "bad.parquet")).collect()


def test_failed_refresh_keeps_the_old_content(spark):
    path = fresh_path(spark, "landing")
    assert files.refresh_landing(spark.range(5), path) == 5
    with pytest.raises(Exception):
        files.refresh_landing(spark.range(5).select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert files.read_parquet(spark, path).count() == 5
    with pytest.raises(FileExistsError):
        files.refresh_landing(spark.range(1), path, must_be_new=True)


def test_refresh_that_ends_before_the_pointer_keeps_the_old_rows(spark, monkeypatch):
    path = fresh_path(spark, "landing")
    files.refresh_landing(spark.range(5), path)
    old = files.read_parquet(spark, path)
    with monkeypatch.context() as m:
        m.setattr(files, "_point_to", lambda *a: (_ for _ in ()).throw(IOError("lost")))
        with pytest.raises(IOError):
            files.refresh_landing(spark.range(9), path)
    assert files.read_parquet(spark, path).count() == 5
    assert files.refresh_landing(spark.range(7), path) == 7
    # A job that began on the version before can end on it.
    assert files.read_parquet(spark, path).count() == 7 and old.count() == 5
    files.refresh_landing(files.read_parquet(spark, path).where("id < 3"), path)
    files.append_landing(spark.range(1), path)
    assert sorted(r["id"] for r in files.read_parquet(spark, path).collect()) == [0, 0, 1, 2]


def test_lost_parts_of_a_thread_are_noticed(spark):
    rows = spark.range(30).select(
        F.lit("v").alias("video_id"), F.lit("t").alias("title"), F.lit("2024").alias("publish_date"), F.lit("c").alias("channel_name"),
        F.col("id").cast("string").alias("comment"), F.col("id").alias("like_count"), F.lit(None).cast("string").alias("comment_publish_date"))
    docs = files.nest_threads(rows, max_comments=6)
    assert [tuple(r) for r in files.thread_totals(docs).collect()] == [("v", 30, 30)]
    some = docs.where(F.element_at("threads", "v")["part"] > 0)
    (found,) = files.thread_totals(some).collect()
    assert found["n_comments"] < found["total"] == 30


def test_csv_keeps_quotes_and_lines(spark):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, " x "), (3, "\\")], "id int, t string")
    path = fresh_path(spark, "csv")
    files.write_csv(df, path, [F.desc("id")])
    assert files.read_csv(spark, path, df.schema, multiline=True).exceptAll(df).count() == 0


def test_rows_are_dealt_out_on_demand_only(spark, sf):
    path = f"{sf}/documents.parquet"
    assert "RoundRobin" in files.read_parquet(spark, path, partitions=3)._jdf.queryExecution().toString()
    assert "RoundRobin" not in files.read_parquet(spark, path)._jdf.queryExecution().toString()


def test_shared_folder_comes_from_the_session(spark):
    assert fresh_path(spark, "x").startswith(shared_root(spark))


def test_list_tables(spark):
    files.run_sql(spark, {"b_view": spark.range(1), "a_view": spark.range(1)}, "SELECT 1")
    assert [t for t in files.list_tables(spark) if t in ("a_view", "b_view")] == ["a_view", "b_view"]


class Wire:
    """Takes the place of the database: records writer and reader options."""

    def __init__(self, monkeypatch, spark, stored=None):
        self.writes, self.reads = [], []
        wire = self

        def note(kind):
            state = {}

            def fmt(this, name):
                state.clear()
                state["format"] = name
                return this

            def option(this, k, v):
                state[k] = v
                return this

            def options(this, **kw):
                state.update(kw)
                return this

            def mode(this, m):
                state["mode"] = m
                return this

            def save(this, *a):
                this._df.count()
                wire.writes.append(dict(state))

            def load(this, *a):
                wire.reads.append(dict(state))
                return spark.createDataFrame([(stored,)], "n bigint")

            return {"format": fmt, "option": option, "options": options, "mode": mode, "save": save, "load": load}

        for cls, names in ((DataFrameWriter, ("format", "option", "options", "mode", "save")),
                           (DataFrameReader, ("format", "option", "options", "load"))):
            made = note(cls)
            for n in names:
                monkeypatch.setattr(cls, n, made[n])


OPTS = {"url": "jdbc:example://host/db", "user": "u", "password": "p"}


def test_append_and_refresh(spark, monkeypatch):
    wire = Wire(monkeypatch, spark)
    assert database.write_jdbc(spark.range(3), OPTS, "t") == 3
    assert database.write_jdbc(spark.range(4), OPTS, "t", "refresh", connections=8) == 4
    append, refresh = wire.writes
    assert append["mode"] == "append" and append["dbtable"] == "t" and "truncate" not in append
    assert refresh["mode"] == "overwrite" and refresh["truncate"] is True and refresh["numPartitions"] == 8
    with pytest.raises(ValueError):
        database.write_jdbc(spark.range(1), OPTS, "t", "replace")


def test_parallel_read(spark, monkeypatch):
    wire = Wire(monkeypatch, spark, stored=1)
    database.read_jdbc(spark, OPTS, "reviews", database.partition_options("id", 1, 1000, 16))
    assert wire.reads[0]["partitionColumn"] == "id" and wire.reads[0]["numPartitions"] == "16"
    assert wire.reads[0]["dbtable"] == "reviews" and wire.reads[0]["url"] == OPTS["url"]
    with pytest.raises(ValueError):
        database.partition_options("id", 1, 10, 0)


def test_publication_is_one_transaction(spark, monkeypatch):
    Wire(monkeypatch, spark, stored=3)
    ran = []
    assert database.publish_jdbc(spark.range(3), OPTS, "t", "t_staging", ran.append, mode="refresh") == 3
    assert ran == [["DELETE FROM t", "INSERT INTO t (id) SELECT id FROM t_staging"]]


def test_doubled_rows_stop_the_publication(spark, monkeypatch):
    Wire(monkeypatch, spark, stored=5)
    ran = []
    with pytest.raises(RuntimeError, match="5 rows, 3 were sent"):
        database.publish_jdbc(spark.range(3), OPTS, "t", "t_staging", ran.append)
    assert ran == []


def test_connection_from_the_environment(monkeypatch):
    monkeypatch.setenv("VOXLENS_JDBC_URL", "jdbc:example://env")
    monkeypatch.setenv("VOXLENS_JDBC_USER", "someone")
    assert database.jdbc_options(fetchsize=5) == {"url": "jdbc:example://env", "user": "someone", "fetchsize": "5"}
    monkeypatch.delenv("VOXLENS_JDBC_URL")
    with pytest.raises(ValueError):
        database.jdbc_options()
