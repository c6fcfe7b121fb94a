"""Session set-up and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "voxlens", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every operator assumes (UTC, adaptive execution)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see. Taken from ``spark.checkpoint.dir``; with a local master
    and that setting unset it lies below the warehouse."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    context.setCheckpointDir(root)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once however often
    it is used, pruned by column on every read, and with a known size for join planning.
    ``options`` are those of the Parquet writer."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {jvm.org.apache.hadoop.fs.Path(f).getParent().toString() for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows and their order are fixed from here on, also when
    executors are lost."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
