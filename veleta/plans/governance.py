"""Runs: evidence, close-out, reads by run or by latest key, and retirement of a source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.operators.keys import latest_per_key


def evidence_summary(events: DataFrame, run: str = "run_id") -> DataFrame:
    """By run: events, and records from the summary rows where there are any, else from the query rows."""
    is_query = F.col("query").isNotNull()
    by = events.groupBy(run).agg(
        F.count(F.lit(1)).alias("eventos"), F.sum(F.when(~is_query, F.col("records_extracted"))).alias("s_"), F.sum(F.when(is_query, F.col("records_extracted"))).alias("q_")
    )
    return by.select(run, "eventos", F.coalesce("s_", "q_", F.lit(0)).cast("long").alias("registros"))


def close_run(runs: DataFrame, summary: DataFrame, live: DataFrame, run: str = "run_id") -> DataFrame:
    """Runs with counts of their quality summary, of the live tables where there is none."""
    s = summary.select(run, F.col("raw").alias("s_raw"), F.col("staging").alias("s_staging"))
    n = live.select(run, F.col("raw").alias("n_raw"), F.col("staging").alias("n_staging"))
    out = runs.join(s, run, "left").join(n, run, "left")
    raw, done = F.coalesce("s_raw", "n_raw", F.lit(0)), F.coalesce("s_staging", "n_staging", F.lit(0))
    rate = F.when(raw > 0, F.round(done * 100.0 / raw, 2)).otherwise(0.0)
    return out.select(*runs.columns, raw.cast("long").alias("total_raw"), done.cast("long").alias("total_staging"), rate.alias("tasa_completitud"))


def read_rows(table: DataFrame, keys: Sequence[str], order: str, run_id: str | None = None, run: str = "run_id") -> DataFrame:
    """Rows of one run, or the latest row of each key over all runs."""
    if run_id is not None:
        return table.filter(F.col(run) == run_id)
    return latest_per_key(table, list(keys), [F.desc_nulls_last(order)])


def homologation(existing: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The map with entries that it does not have yet; those it has stay as they are."""
    return existing.unionByName(found.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti").select(*existing.columns))


def backfilled(rows: DataFrame, run: str = "run_id", legacy: str = "legacy") -> DataFrame:
    """Rows without a run under one synthetic run."""
    return rows.withColumn(run, F.coalesce(F.col(run).cast("string"), F.lit(legacy)))


def dependent_runs(files: DataFrame, audits: DataFrame, source: str) -> DataFrame:
    """Runs that hold files of a source, and runs whose audit rows rest on one of those."""
    direct = files.filter(F.col("fuente") == source).select("run_id")
    return direct.union(audits.join(direct.distinct().withColumnRenamed("run_id", "data_run_id"), "data_run_id", "left_semi").select("run_id")).distinct()


def after_retirement(runs: DataFrame, affected: DataFrame, totals: Sequence[str]) -> DataFrame:
    """Runs with the totals of affected ones emptied."""
    marked = runs.join(affected.select("run_id", F.lit(True).alias("hit_")), "run_id", "left")
    return marked.select(*[F.when(F.col("hit_"), None).otherwise(F.col(c)).alias(c) if c in totals else F.col(c) for c in runs.columns])
