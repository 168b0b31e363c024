"""Data quality and governance over observations, runs and outcome events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.operators.keys import SNAPSHOT_KEY, identity, latest_per_key, snapshot_removed
from veleta.operators.measures import first_per_stratum, with_distinct_counts
from veleta.operators.rules import OTHER_AGENT

#: Texts that count as not covered.
BLANKS = ("", "n/a", "na", "none", "unknown", "otro", "sin clasificar")
SUCCESSFUL = ("success", "empty")


def reconcile(counts: DataFrame) -> DataFrame:
    """Reconciliation of rows (raw, eligible, duplicates, materialized): clamped counts and rates.

    Nothing expected is complete where there is raw input, and not otherwise.
    """
    zero = F.lit(0).cast("long")
    n = lambda c: F.greatest(F.coalesce(F.col(c).cast("long"), zero), zero)
    rows = counts.withColumn("raw_", n("raw")).withColumn("eligible_", F.least(n("eligible"), F.col("raw_")))
    rows = rows.withColumn("dup_", F.least(n("duplicates"), F.col("eligible_"))).withColumn("done_", n("materialized"))
    rows = rows.withColumn("expected_", F.col("eligible_") - F.col("dup_")).withColumn("errors_", F.greatest(F.col("expected_") - F.col("done_"), zero))
    pct = lambda a, b: F.bround(a * 100.0 / b, 2)
    nothing = F.col("expected_") == 0
    completion = F.when(nothing, F.when(F.col("raw_") > 0, 100.0).otherwise(0.0)).otherwise(
        F.least(pct(F.col("done_"), F.nullif("expected_", F.lit(0))), F.lit(100.0))
    )
    names = {"raw", "eligible", "duplicates", "materialized"}
    return rows.select(
        *[c for c in counts.columns if c not in names],
        F.col("raw_").alias("total_raw_records"),
        F.col("eligible_").alias("eligible_records"),
        F.col("dup_").alias("total_duplicates_removed"),
        F.col("expected_").alias("expected_staging_records"),
        F.col("done_").alias("total_staging_records"),
        F.col("errors_").alias("load_error_records"),
        completion.alias("completion_rate"),
        F.when(nothing, 0.0).otherwise(pct(F.col("errors_"), F.nullif("expected_", F.lit(0)))).alias("overall_error_rate"),
        F.when(F.col("eligible_") == 0, 0.0).otherwise(pct(F.col("dup_"), F.nullif("eligible_", F.lit(0)))).alias("deduplication_rate"),
    )


def freshness(outcomes: DataFrame, now: Column, previous: DataFrame | None = None, stale_after_hours: float = 24.0) -> DataFrame:
    """State of each source from outcome events (source, query, status, records_extracted, execution_timestamp).

    A summary event has no query. An empty attempt is a success; a failed one
    keeps the earlier success of `previous` (source, last_success_at).
    """
    ok, is_query = F.col("status").isin(*SUCCESSFUL), F.col("query").isNotNull()
    at = F.coalesce("execution_timestamp", now)
    order = F.struct((~is_query).alias("s"), at.alias("t"), F.col("status").alias("x"))
    summary_records = F.sum(F.when(~is_query, F.col("records_extracted")))
    by = outcomes.groupBy("source").agg(
        F.max_by("status", order).alias("latest_status"),
        F.coalesce(summary_records, F.sum("records_extracted")).cast("long").alias("records_extracted"),
        F.max(at).alias("last_attempt_at"),
        F.max(F.when(ok, at)).alias("own_"),
        F.nullif(F.count_if(is_query), F.lit(0)).alias("expected_queries"),
        F.when(F.count_if(is_query) > 0, F.count_if(is_query & ok)).alias("completed_queries"),
    )
    if previous is None:
        by = by.withColumn("prior_", F.lit(None).cast("timestamp"))
    else:
        by = by.join(previous.select("source", F.col("last_success_at").alias("prior_")), "source", "left")
    by = by.withColumn("last_success_at", F.coalesce("own_", "prior_"))
    seconds = F.unix_timestamp(now) - F.unix_timestamp("last_success_at")
    by = by.withColumn("age_hours", F.when(seconds.isNotNull(), F.bround(F.greatest(seconds, F.lit(0)) / 3600.0, 2)))
    return by.withColumn("is_stale", F.col("age_hours").isNull() | (F.col("age_hours") > stale_after_hours)).drop("own_", "prior_")


def carry_forward(current: DataFrame, earlier: DataFrame, order: str = "last_attempt_at") -> DataFrame:
    """Freshness of this run, and the latest earlier row of every source that it lacks."""
    rest = earlier.join(current.select("source"), "source", "left_anti")
    return current.unionByName(latest_per_key(rest, ["source"], [F.desc_nulls_last(order)]), allowMissingColumns=True)


def covered(column: Column) -> Column:
    return ~F.lower(F.trim(F.coalesce(column.cast("string"), F.lit("")))).isin(*BLANKS)


def coverage(frame: DataFrame, source: str, dimensions: Mapping[str, str], confidence: str | None, thresholds: Mapping[str, float]) -> DataFrame:
    """Coverage of each dimension by source against its threshold; the confidence dimension "llm" is covered above 0."""
    counts = [F.count_if(covered(F.col(c))).alias(d) for d, c in dimensions.items()]
    if confidence is not None:
        counts.append(F.count_if(F.coalesce(F.col(confidence).cast("double"), F.lit(0.0)) > 0).alias("llm"))
    names = [*dimensions, *(["llm"] if confidence is not None else [])]
    by = frame.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("total_count"), *counts)
    rows = by.unpivot(["source", "total_count"], names, "dimension", "covered_count")
    limit = F.lit(0.0)
    for d, t in thresholds.items():
        limit = F.when(F.col("dimension") == d, F.lit(float(t))).otherwise(limit)
    rows = rows.withColumn("coverage_pct", F.bround(F.col("covered_count") * 100.0 / F.col("total_count"), 2)).withColumn("threshold_pct", limit)
    return rows.withColumn("warning", F.col("coverage_pct") < F.col("threshold_pct"))


def warnings_text(rows: DataFrame) -> DataFrame:
    text = F.format_string("%s/%s: %.2f%% < %.2f%%", "source", "dimension", "coverage_pct", "threshold_pct")
    return rows.filter("warning").select(text.alias("aviso"))


def comparable(frame: DataFrame, source: str, agent: str, metrics: Sequence[str]) -> DataFrame:
    """Mean of each metric by source and agent, scaled to 0..1 within source and metric; 0 where it is flat."""
    rows = frame.select(F.col(source).alias("source"), F.col(agent).alias("agent"), *[F.col(m).cast("double").alias(m) for m in metrics])
    means = rows.groupBy("source", "agent").agg(*[F.avg(m).alias(m) for m in metrics])
    long = means.unpivot(["source", "agent"], list(metrics), "metric_name", "raw_value").filter("raw_value is not null")
    w = W.partitionBy("source", "metric_name")
    low, high = F.min("raw_value").over(w), F.max("raw_value").over(w)
    scaled = F.when(high == low, 0.0).otherwise((F.col("raw_value") - low) / F.nullif(high - low, F.lit(0.0)))
    return long.withColumn("normalized_value", F.bround(scaled, 6))


def stratified_sample(frame: DataFrame, source: str, agent: str, lineage: Column, seed: str, per_stratum: int) -> DataFrame:
    """The first rows of each (source, agent) in the order of a seeded hash of their lineage."""
    keyed = frame.withColumn("sample_key", F.sha2(F.concat_ws("|", F.lit(seed), lineage.cast("string")), 256))
    return first_per_stratum(keyed, [source, agent], [F.asc("sample_key")], max(per_stratum, 0))


def nulls(frame: DataFrame, source: str, columns: Mapping[str, str]) -> DataFrame:
    """Nulls by source and column with percentage and the strategy of the column."""
    by = frame.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = by.unpivot(["source", "total"], list(columns), "columna", "nulos")
    strategy = F.coalesce(*[F.when(F.col("columna") == c, F.lit(s)) for c, s in columns.items()])
    return rows.withColumn("porcentaje", F.round(F.col("nulos") * 100.0 / F.col("total"), 2)).withColumn("estrategia", strategy)


def critical_nulls(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return frame.agg(F.count_if(bad).alias("filas_con_nulo_critico"))


def dedup_report(frame: DataFrame, source: str, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """By source: rows of groups with several rows, rows to be removed, rows kept."""
    groups = frame.groupBy(F.col(source).alias("source"), *identity(frame, keys)).agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy("source").agg(
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("detectados"),
        F.sum(F.col("n") - 1).alias("eliminados"),
        F.count(F.lit(1)).alias("conservados"),
    )


def purge_rate(report: DataFrame) -> DataFrame:
    n = F.col("eliminados") + F.col("conservados")
    return report.withColumn("tasa_depuracion", F.when(n > 0, F.round(F.col("eliminados") * 100.0 / n, 2)).otherwise(0.0))


def casts(frame: DataFrame, source: str, columns: Mapping[str, str]) -> DataFrame:
    """By source and column (name -> type): failed casts and the smallest failing example."""
    long = frame.select(F.col(source).alias("source"), *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(["source"], list(columns), "columna", "valor")
    failed = F.lit(False)
    for c, t in columns.items():
        failed = failed | ((F.col("columna") == c) & F.col("valor").isNotNull() & F.expr(f"try_cast(valor as {t})").isNull())
    return long.groupBy("source", "columna").agg(F.count_if(failed).alias("fallos"), F.min(F.when(failed, F.col("valor"))).alias("ejemplo"))


def issues(frame: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """One row for each named count, in one pass over the rows."""
    wide = frame.agg(*[F.count_if(c).alias(n) for n, c in metrics.items()])
    return wide.unpivot([], list(metrics), "metrica", "valor")


def unmapped(frame: DataFrame, agent: str = "nombre_agente") -> DataFrame:
    """One row: rows whose agent no alias knows."""
    return frame.agg(F.count_if(F.col(agent) == OTHER_AGENT).alias("sin_homologar"))


def run_of(rows: DataFrame, files: DataFrame, run_id: str | None, own: str | None = None) -> DataFrame:
    """Rows of a run: by their own run where they have one, else by that of their file; all rows without a run to look for."""
    if run_id is None:
        return rows
    f = files.select(F.col("id").alias("file_"), F.col("run_id").alias("file_run_"))
    run = F.col("file_run_") if own is None else F.coalesce(own, "file_run_")
    return rows.join(f, rows["raw_file_id"] == F.col("file_"), "left").filter(run == run_id).drop("file_", "file_run_")


def overall_metrics(records: DataFrame, files: DataFrame, candidates: DataFrame, staging: DataFrame, critical: Sequence[str], run_id: str | None = None, keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """One row for a run (or all): its raw, eligible, duplicate and staged rows reconciled, and critical nulls."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    eligible = run_of(candidates, files, run_id).filter(F.col("nombre_agente") != OTHER_AGENT)
    staged = run_of(staging, files, run_id)
    one = (
        count(run_of(records, files, run_id, "run_id"), "raw")
        .join(count(eligible, "eligible"))
        .join(snapshot_removed(eligible, keys).withColumnRenamed("eliminados", "duplicates"))
        .join(count(staged, "materialized"))
        .join(critical_nulls(staged, critical).withColumnRenamed("filas_con_nulo_critico", "total_nulls_removed"))
    )
    return reconcile(one)


def issue_breakdown(records: DataFrame, candidates: DataFrame, staging: DataFrame, errors: DataFrame, critical: Sequence[str], numeric: Mapping[str, str], keys: Sequence[str] = SNAPSHOT_KEY) -> DataFrame:
    """Eight counts over all runs: what came in, what stayed, and what accounts for the difference."""
    http = F.col("error_type").ilike("%HTTP%") | F.col("description").ilike("%429%") | F.col("description").ilike("%403%")
    failed = casts(candidates, "fuente", numeric).agg(F.coalesce(F.sum("fallos"), F.lit(0)).alias("casting_or_transformation_errors"))
    one = (
        records.agg(F.count(F.lit(1)).alias("raw_records"))
        .join(staging.agg(F.count(F.lit(1)).alias("staging_records")))
        .join(snapshot_removed(candidates, keys).withColumnRenamed("eliminados", "real_duplicate_records_removed"))
        .join(errors.agg(F.count_if(F.coalesce(http, F.lit(False))).alias("http_errors_logged")))
        .join(unmapped(staging).withColumnRenamed("sin_homologar", "unmapped_agent_records"))
        .join(critical_nulls(staging, critical).withColumnRenamed("filas_con_nulo_critico", "critical_null_records"))
        .join(failed)
    )
    zero = F.lit(0).cast("long")
    lost = F.greatest(F.col("raw_records") - F.col("staging_records"), zero)
    rest = F.greatest(lost - F.col("real_duplicate_records_removed") - F.col("critical_null_records"), zero)
    one = one.withColumn("key_conflicts_or_preexisting_records", rest)
    names = ["raw_records", "staging_records", "real_duplicate_records_removed", "key_conflicts_or_preexisting_records", "http_errors_logged", "unmapped_agent_records", "critical_null_records", "casting_or_transformation_errors"]
    return one.select(*[F.col(n).cast("long").alias(n) for n in names]).unpivot([], names, "metric_name", "metric_value")


def run_issues(summary: DataFrame, candidates: DataFrame) -> DataFrame:
    """The seven counts of one run, of its reconciled summary (one row) and its candidates, noise among them."""
    names = {
        "raw_records": "total_raw_records",
        "eligible_records": "eligible_records",
        "historical_duplicates_removed": "total_duplicates_removed",
        "expected_staging_records": "expected_staging_records",
        "materialized_staging_records": "total_staging_records",
        "load_error_records": "load_error_records",
        "unmapped_agent_records": "sin_homologar",
    }
    one = summary.join(unmapped(candidates)).select(*[F.col(c).cast("long").alias(n) for n, c in names.items()])
    return one.unpivot([], list(names), "metric_name", "metric_value")


def contract(frame: DataFrame, technical: Mapping[str, str] | None = None) -> DataFrame:
    """Position, name, type, nullability and role of each column; all but the technical ones are analytical."""
    roles = technical or {"id": "technical_surrogate_key", "fecha_carga": "technical_audit_column"}
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable, roles.get(f.name, "analytical_contract_column")) for i, f in enumerate(frame.schema.fields, 1)]
    return frame.sparkSession.createDataFrame(rows, "ordinal_position int, column_name string, data_type string, is_nullable boolean, contract_role string")


def null_or_blank(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each column that are null or, as texts, blank."""
    return issues(frame, {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "" for c in columns}).withColumnsRenamed({"metrica": "columna", "valor": "registros_nulos_o_vacios"})


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    counts = [rows.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("total_registros")) for name, rows in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def load_loss(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: staged rows, facts, their difference, and the percentage lost; null where nothing is staged."""
    both = staging.agg(F.count(F.lit(1)).alias("total_staging")).join(fact.agg(F.count(F.lit(1)).alias("total_fact")))
    apart = F.abs(F.col("total_staging") - F.col("total_fact"))
    return both.select("*", apart.alias("diferencia"), F.round(apart * 100.0 / F.nullif("total_staging", F.lit(0)), 4).cast("double").alias("porcentaje_merma"))


def period(frame: DataFrame, date: str, first: str, last: str) -> DataFrame:
    """One row: oldest and newest date, rows, rows outside the expected period, and whether there is none."""
    outside = (F.col(date) < F.lit(first).cast("date")) | (F.col(date) > F.lit(last).cast("date"))
    by = frame.agg(F.min(date).alias("desde"), F.max(date).alias("hasta"), F.count(F.lit(1)).alias("total"), F.count_if(outside).alias("fuera"))
    return by.withColumn("valido", F.col("fuera") == 0)


def broken_checks(checks: DataFrame) -> DataFrame:
    """Assertions of `gold_checks` that do not hold."""
    return checks.filter(~F.col("ok"))


def run_status(outcomes: DataFrame, critical: bool = False) -> DataFrame:
    """Roll-up of outcome statuses to one: failed, partial_success, success or empty."""
    has = lambda *s: F.coalesce(F.bool_or(F.col("status").isin(*s)), F.lit(False))
    records = F.coalesce(F.sum("records_extracted"), F.lit(0)) > 0
    bad, good = has("failed"), has("success")
    status = (
        F.when(F.lit(critical), "failed")
        .when(has("partial_success") | (bad & (good | records)), "partial_success")
        .when(bad, "failed")
        .when(good, "success")
        .otherwise("empty")
    )
    return outcomes.agg(status.alias("status"))


def publication_status(summary: DataFrame) -> DataFrame:
    """failed before empty before the requested status; summary: raw, load_errors, requested."""
    status = (
        F.when((F.col("requested") == "failed") | (F.col("load_errors") > 0), "failed").when(F.col("raw") == 0, "empty").otherwise(F.col("requested"))
    )
    return summary.withColumn("status", status)


def resolve_run(files: DataFrame, sources: Sequence[str], run_id: str | None = None, mixed: bool = False) -> str:
    """The run to report on: the given one or the newest with a file in scope; runs of other sources are refused."""
    if run_id is None:
        row = files.filter(F.col("fuente").isin(*sources)).agg(F.max_by("run_id", "fecha_carga").alias("r")).first()
        if row.r is None:
            raise ValueError("no run in scope")
        run_id = row.r
    seen = files.filter(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("fuente").isin(*sources)).alias("foreign")).first()
    if not seen.n:
        raise ValueError(f"unknown run {run_id}")
    if seen.foreign and not mixed:
        raise ValueError(f"run {run_id} holds other sources")
    return run_id


def distribution(frame: DataFrame, column: str) -> DataFrame:
    """Rows and share by value."""
    by = frame.groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("n"))
    return by.withColumn("porcentaje", F.round(F.col("n") * 100.0 / F.sum("n").over(W.partitionBy()), 2))


def staging_summary(frame: DataFrame, date: str, source: str, agent: str, first: str, last: str) -> DataFrame:
    """One row: totals, distinct members, date span in days, and whether the period is inside the expected one."""
    sums = [("total", F.count(F.lit(1)), "sum"), ("desde", F.min(date), "min"), ("hasta", F.max(date), "max")]
    by = with_distinct_counts(frame, [], {"fuentes": source, "agentes": agent}, sums).withColumn("total", F.coalesce("total", F.lit(0)))
    inside = (F.col("desde") >= F.lit(first).cast("date")) & (F.col("hasta") <= F.lit(last).cast("date"))
    return by.withColumn("dias", F.datediff("hasta", "desde")).withColumn("periodo", F.when(inside, "VALIDO").otherwise("FUERA DE RANGO"))


def duplicate_groups(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def gold_checks(staging: DataFrame, fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], grain: Sequence[str], measures: Sequence[str], date: str) -> DataFrame:
    """One row for each assertion: name, value and whether it holds."""
    negative = F.lit(False)
    for m in measures:
        negative = negative | (F.col(m) < 0)
    one = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col(date).isNull()).alias("null_dates"), F.count_if(negative).alias("negative_measures")
    )
    wide = one.join(staging.agg(F.count(F.lit(1)).alias("staging_rows")))
    names = ["fact_rows", "staging_rows", "null_dates", "negative_measures"]
    for name, (dim, key) in dims.items():
        lost = fact.join(dim.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias(f"orphans_{name}"))
        wide, names = wide.join(lost), [*names, f"orphans_{name}"]
    wide = wide.join(duplicate_groups(fact, grain).agg(F.count(F.lit(1)).alias("duplicate_grains")))
    rows = wide.unpivot([], [*names, "duplicate_grains"], "check_name", "value")
    must_be_zero = ~F.col("check_name").isin("fact_rows", "staging_rows")
    return rows.withColumn("ok", ~must_be_zero | (F.col("value") == 0))
