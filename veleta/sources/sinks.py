"""Writers that publish a result only when it is whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.scratch import file_system


def write_catalog(spark: SparkSession, rows: DataFrame, path: str, expected: int | None = None, metadata: DataFrame | None = None) -> int:
    """JSON records under `path`; the count is checked before the folder gets its name.

    `metadata`, one row about inputs, window, grain and statistics, goes into a
    file of its own beside the records.
    """
    hidden = f"{path.rstrip('/')}.part"
    rows.write.mode("overwrite").json(hidden)
    written = spark.read.text(hidden).count()
    if expected is not None and written != expected:
        raise ValueError(f"{written} records written, {expected} expected")
    if metadata is not None:
        metadata.withColumn("records", F.lit(written)).coalesce(1).write.mode("overwrite").json(f"{hidden}/_metadata")
    _rename(spark, hidden, path)
    return written


def read_written(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Records under `path` with `at_`, their place in the order of writing: part, block of its file, row of the block.

    A scan deals files by size, so that the number of a row in it does not follow that order.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    file, part = F.col("_metadata.file_name"), F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    at = F.struct(part.try_cast("long").alias("part"), file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return reader.json(path).select("*", at.alias("at_"))


def write_parquet(rows: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    """A table (staging, run inventory) as CSV with a header."""
    rows.write.mode("overwrite").option("header", "true").csv(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str, status: str) -> None:
    """Tables as CSV under runs/<run_id>, a marker last.

    `latest` changes only after success or partial success: a whole copy is
    written beside it and takes its name in one step.
    """
    safe = "".join(c if c.isalnum() or c in "_.-" else "_" for c in run_id)
    for name, rows in tables.items():
        export_csv(rows, f"{root}/runs/{safe}/{name}")
    marker = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(status).alias("status"))
    marker.write.mode("overwrite").json(f"{root}/runs/{safe}/_published")
    if status in ("success", "partial_success"):
        for name in tables:
            export_csv(spark.read.option("header", "true").csv(f"{root}/runs/{safe}/{name}"), f"{root}/latest.part/{name}")
        _rename(spark, f"{root}/latest.part", f"{root}/latest")


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Within one file system, by the file system that Spark itself uses; what had the name goes only when the new one is there."""
    fs, a = file_system(spark, old)
    b, aside = file_system(spark, new)[1], file_system(spark, f"{new.rstrip('/')}.old")[1]
    fs.delete(aside, True)
    if fs.exists(b) and not fs.rename(b, aside):
        raise OSError(f"cannot move {new} away")
    if not fs.rename(a, b):
        fs.rename(aside, b)
        raise OSError(f"cannot rename {old}")
    fs.delete(aside, True)
