"""Where the corpus operators keep what they write and read again, and how many rows they hand to Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

from veleta.scratch import forget, keep, shared_folder

__all__ = ["forget", "keep", "shared_folder", "small_batches"]

#: Rows that are handed to Python at a time; texts are long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hand at most `BATCH_ROWS` rows to Python at a time, unless the session has a setting of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
