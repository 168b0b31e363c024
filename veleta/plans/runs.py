"""One run from files to the star schema and its quality tables, and the rebuilds of both layers.

Raw rows are kept by run and only added to. Staging and the ledger of processed
files change together, as one snapshot; so do the dimensions and the fact. A
run that breaks leaves the snapshots of the last one, and what it had landed is
processed by the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta import contracts
from veleta.operators import keys, staging
from veleta.operators.rules import OTHER_AGENT
from veleta.plans import gold, quality, star
from veleta.scratch import keep
from veleta.sources import raw, sinks
from veleta.tables import RunTables, Snapshots

RAW = {
    "raw_files": contracts.RAW_FILES,
    "raw_records": contracts.RAW_RECORDS,
    "raw_rejected": "ruta string, fuente string, bytes long, hash_sha256 string, reason string, fecha timestamp, run_id string",
}
AUDIT = {
    "quality_summary": "run_id string, total_raw_records long, eligible_records long, total_duplicates_removed long, expected_staging_records long, total_staging_records long, load_error_records long, completion_rate double, overall_error_rate double, deduplication_rate double, total_nulls_removed long",
    "quality_issue_breakdown": "run_id string, metric_name string, metric_value long",
    "nulls_matrix": "run_id string, source string, total long, columna string, nulos long, porcentaje double, estrategia string",
    "dedup_report": "run_id string, source string, detectados long, eliminados long, conservados long",
    "semantic_coverage": "run_id string, source string, total_count long, dimension string, covered_count long, coverage_pct double, threshold_pct double, warning boolean",
    "quality_warnings": "run_id string, aviso string",
    "source_comparable_metrics": "run_id string, source string, agent string, metric_name string, raw_value double, normalized_value double",
}
#: Columns whose nulls are counted, with what is done about them.
NULLS = {"fecha_evento": "drop", "nombre_agente": "drop", "id_origen_registro": "drop", "titulo": "empty", "score_popularidad": "null"}
CRITICAL = ("fecha_evento", "nombre_agente", "id_origen_registro")
DIMENSIONS = {"platform": "dim_nombre_plataforma", "technology": "dim_nombre_tecnologia", "community": "dim_nombre_comunidad"}
#: Percentages that coverage should reach.
THRESHOLDS = {"platform": 80.0, "technology": 70.0, "community": 60.0}
STAGING_VERSION = ("fecha_evento", "raw_file_id", "raw_record_id")
LEDGER = "file_id long, transformation_version string, run_id string, records_processed long"


class Warehouse:
    """The layers under one folder."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str], version: str = "v1"):
        self.spark, self.root, self.schemas, self.version = spark, root.rstrip("/"), dict(schemas), version
        self.raw = RunTables(spark, f"{self.root}/raw", RAW)
        self.store = Snapshots(spark, f"{self.root}/store")
        self.audit = RunTables(spark, f"{self.root}/audit", AUDIT)

    def _stored(self, name: str, schema: str) -> DataFrame:
        return self.store.read(name) if self.store.has(name) else self.spark.createDataFrame([], schema)

    def land(self, raw_root: str, run_id: str, pattern: str = "*.json", sources: Sequence[str] | None = None) -> tuple[int, int]:
        """Land the new files of a folder under a run; how many landed and how many were rejected."""
        landed = self.raw.read("raw_files")
        if landed.filter(F.col("run_id") == run_id).limit(1).count():
            raise ValueError(f"run {run_id} has landed already")
        files, records, rejected = raw.land(raw.read_json(self.spark, raw_root, pattern, sources), landed, run_id)
        self.raw.persist(run_id, {"raw_files": files, "raw_records": records, "raw_rejected": rejected})
        return files.count(), rejected.count()

    def stage(self, run_id: str, rebuild: bool = False) -> None:
        """Stage the files that the ledger lacks, newest snapshots winning; a rebuild replaces all of Staging from Raw.

        Files of another transformation version are an error without a rebuild.
        """
        files, ledger = self.raw.read("raw_files"), self._stored("processed", LEDGER)
        todo = keys.pending(files.withColumn("file_id", F.col("id")), ledger, "file_id", "transformation_version", self.version, rebuild)
        todo = keep(self.spark, todo.drop("file_id"), "pending")
        records = raw.records_of(self.raw.read("raw_records"), files, todo)
        rows = keep(self.spark, staging.staged(records, self.schemas), "staged")
        done = keys.processed_counts(todo, rows, self.version, run_id)
        if not rebuild and self.store.has("staging"):
            rows = keys.upsert_newest(self.store.read("staging"), rows, keys.SNAPSHOT_KEY, STAGING_VERSION).select(*contracts.STAGING)
            done = keys.ledger_upsert(ledger, done)
        staging.semantic_gate(rows)
        self.store.publish({"staging": rows, "processed": done})

    def load(self, active: Sequence[str], profile: str = "all", rebuild: bool = False) -> None:
        """Load the star schema from Staging; a rebuild forgets keys and members of earlier loads."""
        rows = self.store.read("staging").filter(gold.in_profile(F.col("fuente"), active, profile))
        old = None if rebuild or not self.store.has("fact") else star.dimensions(self.store)
        dims, fact = gold.load(rows, old, None if old is None else star.fact(self.store))
        broken = quality.broken_checks(self.checks(rows, dims, fact)).collect()  # one row an assertion
        if broken:
            raise ValueError("; ".join(f"{r.check_name}: {r.value}" for r in broken))
        star.store(self.store, dims, fact)

    @staticmethod
    def checks(rows: DataFrame, dims: Mapping[str, DataFrame], fact: DataFrame) -> DataFrame:
        keyed = {n: (d, gold.DIMENSIONS[n][1]) for n, d in dims.items()}
        return quality.gold_checks(rows, fact, keyed, gold.GRAIN, ("cantidad_menciones", "score_actividad"), "id_tiempo")

    def report(self, run_id: str) -> None:
        """The quality tables of a run, in the place of those that it had."""
        files, staged = self.raw.read("raw_files"), self.store.read("staging")
        own = files.filter(F.col("run_id") == run_id)
        candidates = keep(self.spark, staging.replayed(raw.records_of(self.raw.read("raw_records"), files, own), self.schemas), "candidates")
        summary = keep(self.spark, quality.overall_metrics(self.raw.read("raw_records"), files, candidates, staged, CRITICAL, run_id), "summary")
        eligible, mine = candidates.filter(F.col("nombre_agente") != OTHER_AGENT), quality.run_of(staged, files, run_id)
        coverage = quality.coverage(mine, "fuente", DIMENSIONS, None, THRESHOLDS)
        tables = {
            "quality_summary": summary,
            "quality_issue_breakdown": quality.run_issues(summary, candidates),
            "nulls_matrix": quality.nulls(candidates, "fuente", NULLS),
            "dedup_report": quality.dedup_report(eligible, "fuente"),
            "semantic_coverage": coverage,
            "quality_warnings": quality.warnings_text(coverage),
            "source_comparable_metrics": quality.comparable(mine, "fuente", "nombre_agente", ("cantidad_menciones", "cantidad_interacciones", "score_popularidad")),
        }
        self.audit.persist(run_id, {n: rows.withColumn("run_id", F.lit(run_id)) for n, rows in tables.items()})

    def run(self, raw_root: str, run_id: str, active: Sequence[str], profile: str = "all", rebuild: bool = False, pattern: str = "*.json") -> str:
        """Land, stage, load, report and publish; the status of the run."""
        sources = [s for s in active if profile in ("all", s) or profile == "main" and s != "github"]
        _, rejected = self.land(raw_root, run_id, pattern, sources)
        self.stage(run_id, rebuild)
        self.load(active, profile, rebuild)
        self.report(run_id)
        summary = self.audit.read("quality_summary").filter(F.col("run_id") == run_id)
        asked = F.lit("partial_success" if rejected else "success")
        told = quality.publication_status(summary.select(F.col("total_raw_records").alias("raw"), F.col("load_error_records").alias("load_errors"), asked.alias("requested")))
        status = told.first().status
        tables = {n: self.audit.read(n).filter(F.col("run_id") == run_id) for n in AUDIT}
        sinks.publish(self.spark, {**tables, "inventory": self.raw.read("raw_files").filter(F.col("run_id") == run_id)}, f"{self.root}/published", run_id, status)
        return status
