"""Files: Parquet, CSV, thread JSON, landing folders, views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlens.operators.ranking import sort
from voxlens.schemas import THREADS, conform
from voxlens.session import fresh_path

def read_parquet(spark: SparkSession, path, schema: T.StructType | None = None, partitions: int | None = None,
                 extra: str = "error") -> DataFrame:
    """A directory, glob, file or landing folder. With a schema the footer types must agree with it, and
    columns beyond it are an error or, with ``extra="drop"``, left out.

    ``partitions`` deals the rows out anew, for work that is heavy per row on files that do
    not split; without it the table is read as it lies.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*[landing_version(spark, p) for p in paths])
    if partitions:
        df = df.repartition(partitions)
    return df if schema is None else conform(df, schema, extra)


# Microseconds survive; files with fewer digits or without a zone are read as well.
CSV_TIMES = {
    "write": {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    "read": {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
             "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]"},
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with header and doubled quotes. Files split at line ends; with ``multiline`` quoted
    fields may hold line breaks, and a file is one task."""
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", multiline).options(**CSV_TIMES["read"])
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )


def read_threads(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Thread documents as a ``threads`` map column. One document per line by default,
    which splits; ``multiline`` reads each file as one printed document."""
    text = spark.read.text(path, wholetext=multiline)
    text = text.where(F.length(F.trim("value")) > 0)
    parsed = F.from_json("value", THREADS["threads"].dataType, {"mode": "FAILFAST"})
    return text.select(parsed.alias("threads"))


def preview_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and column list of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(",".join(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def catalog_preview(df: DataFrame, n: int, *order) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(n)


def write_parquet(df: DataFrame, path: str, by: list[str] = (), mode: str = "errorifexists") -> None:
    """One folder per value of ``by``. Every task writes its own rows, so a large item
    becomes several files instead of one overloaded task."""
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, order=(), mode: str = "errorifexists") -> None:
    """UTF-8 CSV with header; sorted over all files when an order is given."""
    df = sort(df, *order) if order else df
    df.write.mode(mode).options(**CSV_TIMES["write"]).option("header", True).option("encoding", "UTF-8").option(
        "escape", '"'
    ).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def nest_threads(rows: DataFrame, max_comments: int = 10_000) -> DataFrame:
    """Flat comments to thread documents, the inverse of ``flatten_threads``.

    Every video is one thread in parts of about ``max_comments`` comments, as one row must not
    hold an unbounded list; a short one has one part. Each part has its number and the number of
    comments of the whole thread, so a reader can tell whether all of it is there
    (``thread_totals``). Exact copies are counted first and dealt out in runs, so that copies
    cannot pile up in one part. Which part a comment goes to depends on its content only.
    """
    head = ["video_id", "title", "publish_date", "channel_name"]
    body = ["comment", "like_count", "comment_publish_date"]
    counted = rows.groupBy(*head, *body).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.groupBy("video_id").agg(F.sum("n").alias("total"))
    runs = counted.withColumn(
        "run", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("n") - 1) / max_comments).cast("long")))
    ).withColumn("copies", F.least(F.lit(max_comments), F.col("n") - F.col("run") * max_comments).cast("int"))
    part = F.pmod(F.xxhash64(*head, *body, "run"), F.ceil(F.col("total") / max_comments))
    dealt = runs.join(sizes, "video_id").withColumn("part", part).repartition("video_id", "part")
    comment = F.struct("comment", "like_count", F.col("comment_publish_date").alias("published_at"))
    docs = dealt.groupBy(*head, "part", "total").agg(
        F.sort_array(F.flatten(F.collect_list(F.array_repeat(comment, F.col("copies"))))).alias("comments")
    )
    thread = F.struct(
        "title", F.col("publish_date").alias("published_at"),
        F.col("channel_name").alias("channel_title"), "comments", "part", "total",
    )
    return docs.select(F.create_map("video_id", thread).alias("threads"))


def thread_totals(threads: DataFrame) -> DataFrame:
    """Whether the parts of every thread are there: (video_id, n_comments, total), ``total`` as
    written, null for documents that were not written in parts."""
    parts = threads.select(F.explode("threads").alias("video_id", "t"))
    return parts.groupBy("video_id").agg(F.sum(F.size("t.comments")).alias("n_comments"), F.max("t.total").alias("total"))


def write_threads(rows: DataFrame, path: str, max_comments: int = 10_000, mode: str = "errorifexists") -> None:
    """Thread JSON, one document per line, non-ASCII text kept as it is."""
    docs = nest_threads(rows, max_comments)
    docs.select(F.to_json("threads", {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


POINTER = "_current"


def landing_version(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of a landing folder: the version its pointer file names, or
    the path itself where there is no pointer."""
    if any(c in path for c in "*?[{"):
        return path
    jvm, fs = _file_system(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        name = bytes(stream.readNBytes(1024)).decode()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def _point_to(spark: SparkSession, base: str, version: str) -> None:
    """Name the version in the pointer file, which is replaced in one step."""
    jvm, fs = _file_system(spark, base)
    at = jvm.org.apache.hadoop.fs.Path
    new, pointer = at(f"{base}/{POINTER}.{version}"), at(f"{base}/{POINTER}")
    stream = fs.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(new, pointer, rename)


def refresh_landing(df: DataFrame, path: str, fmt: str = "parquet", must_be_new: bool = False) -> int:
    """Replace the rows of a landing folder and return the number of rows put there.

    Each refresh is a folder of its own below the path. When it is written and counted, the
    pointer file is replaced in one step, so readers (``read_parquet``, ``landing_version``) see
    either all old or all new rows, a failed write changes nothing, and a job may read the folder
    it refreshes. The version before is kept for jobs that still read it, older ones are removed.
    The rows are counted from what was written (Parquet footers), the job that makes them runs once.
    """
    spark = df.sparkSession
    base = path.rstrip("/")
    jvm, fs = _file_system(spark, base)
    at = jvm.org.apache.hadoop.fs.Path
    if must_be_new and fs.exists(at(base)):
        raise FileExistsError(base)
    before = landing_version(spark, base).removeprefix(f"{base}/")
    version = f"v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{base}/{version}")
    n = spark.read.format(fmt).schema(df.schema).load(f"{base}/{version}").count()
    _point_to(spark, base, version)
    for found in fs.listStatus(at(base)):
        name = found.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            fs.delete(found.getPath(), True)
    return n


def append_landing(df: DataFrame, path: str) -> None:
    """Add rows to a landing folder; the job commit makes them visible at once."""
    df.write.mode("append").parquet(landing_version(df.sparkSession, path))


def run_sql(spark: SparkSession, views: dict[str, DataFrame], text: str) -> DataFrame:
    """Register the views and run the query over them."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def round_trip(df: DataFrame, name: str) -> str:
    """Write to a new place in the shared folder and return the place."""
    path = fresh_path(df.sparkSession, name)
    write_parquet(df, path)
    return path
