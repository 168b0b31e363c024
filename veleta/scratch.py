"""Tables that a job writes and reads again go to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of a path, as Spark itself sees it, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, deleted when the application ends.

    Where that is unset, a folder of this machine serves a local session only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            root = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        else:
            raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, at = file_system(spark, path)
    fs.deleteOnExit(at)
    return path


def keep(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: a cut of its lineage that survives lost executors."""
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are removed when it ends, not when its plan is collected (Spark 4.1 on; before, nothing changes)."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def keep_parts(spark: SparkSession, parts: Iterable[DataFrame], name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """`keep` for a large table that is made in parts of the same columns, one after the other: the disk holds the shuffles of one part at a time."""
    path, schema = shared_folder(spark, name), None
    with shuffles_removed(spark):
        for df in parts:
            schema = schema or df.schema
            df.write.mode("append").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def forget(spark: SparkSession, *kept: DataFrame) -> None:
    """Delete tables of `keep` that nothing reads any more."""
    for df in kept:
        files = df.inputFiles()
        if files:
            fs, at = file_system(spark, files[0])
            fs.delete(at.getParent(), True)


def forget_all(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete every table under frames that read tables of `keep` alone, once nothing reads them any more."""
    for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        fs, at = file_system(spark, folder)
        fs.delete(at, True)
