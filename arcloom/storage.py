"""Tables that cut lineage, kept in the folder that the whole cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode without the setting (tests)."""
    name = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not name:
        if not spark.sparkContext.master.startswith("local"):  # executors do not see the driver's own folders
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        name = getattr(shared_dir, "own", None) or "file://" + tempfile.mkdtemp(prefix="arcloom-")
        shared_dir.own = name
    return name.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; it is deleted when the application's file system closes."""
    base = f"{shared_dir(spark)}/arcloom-{spark.sparkContext.applicationId}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Later stages then start from files that every executor can reach, so a lost executor costs its own tasks
    only. The shuffle files of what led here are no longer needed; collecting the driver's garbage lets Spark
    remove them.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    schema = df.schema
    del df
    release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files and broadcasts that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows of narrow keys (about 40 bytes each once hashed) up to which a written table may be broadcast.
MAX_BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table of narrow keys, marked for broadcast only if it is counted and small enough."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
