"""Session helpers: test sessions, table loading and stage tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("siftlake")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where that setting is absent and the master is local (tests, bench), a temporary folder of this
    machine takes its place; on a cluster its absence is an error.
    """
    conf = spark.sparkContext.getConf()
    if folder := conf.get("spark.checkpoint.dir"):
        return folder.rstrip("/")
    if not conf.get("spark.master", "").startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    holder = spark.sparkContext
    if not getattr(holder, "_siftlake_dir", None):
        holder._siftlake_dir = "file://" + tempfile.mkdtemp(prefix="siftlake-")
    return holder._siftlake_dir


def stage(df: DataFrame, name: str = "stage", by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; ``by`` names a column of few values whose rows are read apart from others.

    It cuts the lineage, survives the loss of executors and makes ids drawn during the write
    (``monotonically_increasing_id``) final.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a table that ``stage`` wrote once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    parents = {re.sub(r"/[^/]+=[^/]*$", "", file.rsplit("/", 1)[0]) for file in df.inputFiles()}
    for parent in parents:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded(df: DataFrame, most: int) -> list:
    """The rows of a table that is small by its meaning (configuration, sources); more than ``most`` are an error, never cut off."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows where a small table is needed")
    return rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the project's Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
