"""Runs from files to quality tables, rebuilds, sinks and run-scoped tables over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta import tables
from veleta.plans import catalog, gold, kpi, quality, star
from veleta.plans.activity import SQL as ACT
from veleta.plans.activity import activity, read
from veleta.plans.runs import Warehouse
from veleta.registry import gold as gold_queries
from veleta.registry import quality as quality_queries
from veleta.scratch import forget_all, shared_folder
from veleta.sources import raw, sinks

QUERIES, ORACLES = {}, {}


def _add(name: str, query, sql: str) -> None:
    QUERIES[name], ORACLES[name] = query, sql


_FORUM = {"hackernews": "id string, title string, created_at string, points long"}
_ACTIVE = ("catalogo", "github", "hackernews")
#: Days of the first run; the second one finds the files of the others.
_FIRST = 10
_AGENT = "CASE event_type WHEN 'click' THEN 'Codex' WHEN 'view' THEN 'Cursor Agent' END"


def _forum_files(spark, sf_dir, root: str, days: str) -> None:
    """Events of the days as posts of a forum that name an agent or none: a JSON list a day and event type."""
    title = F.when(F.col("event_type") == "click", "codex tool").when(F.col("event_type") == "view", "a cursor kit").otherwise("noise")
    item = F.struct(F.col("event_id").cast("string").alias("id"), title.alias("title"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"), F.col("user_id").alias("points"))
    e = read(spark, sf_dir, "events").filter(f"dayofyear(ts) {days}")
    lists = e.groupBy(F.dayofyear("ts").alias("day"), "event_type").agg(F.to_json(F.collect_list(item)).alias("value"))
    lists.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(f"{root}/hackernews")


def _warehouse(spark, sf_dir, version: str = "v1") -> tuple[Warehouse, str]:
    return Warehouse(spark, shared_folder(spark, "warehouse"), _FORUM, version), shared_folder(spark, "raw")


def _two_runs(spark, sf_dir) -> Warehouse:
    house, files = _warehouse(spark, sf_dir)
    for run, days in (("r1", f"<= {_FIRST}"), ("r2", f"> {_FIRST}")):
        _forum_files(spark, sf_dir, files, days)
        house.run(files, run, _ACTIVE, pattern="*.txt")
    return house


_add(
    "run_pipeline",
    lambda spark, sf_dir: (lambda h: h.audit.read("quality_issue_breakdown").unionByName(h.store.read("fact").groupBy(F.lit("all").alias("run_id"), F.lit("facts").alias("metric_name")).agg(F.count(F.lit(1)).alias("metric_value"))))(_two_runs(spark, sf_dir)),
    f"""WITH e AS (SELECT CASE WHEN dayofyear(ts) <= {_FIRST} THEN 'r1' ELSE 'r2' END AS run_id, {_AGENT} AS a FROM events), c AS (SELECT run_id, count(*) AS n, count(a) AS k FROM e GROUP BY 1)
SELECT run_id, unnest(['raw_records', 'eligible_records', 'historical_duplicates_removed', 'expected_staging_records', 'materialized_staging_records', 'load_error_records', 'unmapped_agent_records']) AS metric_name, unnest([n, k, 0, k, k, 0, n - k])::BIGINT AS metric_value FROM c
UNION ALL SELECT 'all', 'facts', count(a) FROM e""",
)


def _staged_twice(spark, sf_dir) -> DataFrame:
    """Staged by one version, rebuilt by the next one after further files: rows of Staging and of the ledger."""
    house, files = _warehouse(spark, sf_dir)
    _forum_files(spark, sf_dir, files, f"<= {_FIRST}")
    house.land(files, "r1", "*.txt")
    house.stage("r1")
    _forum_files(spark, sf_dir, files, f"> {_FIRST}")
    house.version = "v2"
    house.land(files, "r2", "*.txt")
    house.stage("r2", rebuild=True)
    ledger = house.store.read("processed").groupBy(F.concat_ws(" ", F.lit("ledger"), "transformation_version").alias("que")).agg(F.sum("records_processed").alias("n"))
    return ledger.unionByName(house.store.read("staging").groupBy(F.col("nombre_agente").alias("que")).agg(F.count(F.lit(1)).alias("n")))


_add(
    "staging_rebuild",
    _staged_twice,
    f"WITH e AS (SELECT {_AGENT} AS a FROM events) SELECT 'ledger v2' AS que, count(a)::BIGINT AS n FROM e UNION ALL SELECT a, count(*) FROM e WHERE a IS NOT NULL GROUP BY 1",
)


def _rebuilt(spark, sf_dir) -> DataFrame:
    """Facts of the later days are loaded first, so that a load keeps their keys and a rebuild numbers all anew."""
    house, files = _warehouse(spark, sf_dir)
    for run, days in (("r1", f"> {_FIRST}"), ("r2", f"<= {_FIRST}")):
        _forum_files(spark, sf_dir, files, days)
        house.land(files, run, "*.txt")
        house.stage(run)
        house.load(_ACTIVE, rebuild=run == "r2")
    return house.store.read("fact").join(house.store.read("dim_agente").select("id_agente", "nombre_agente"), "id_agente").select("id_hecho", "nombre_agente", "id_origen_registro")


_add("gold_rebuild", _rebuilt, f"SELECT row_number() OVER (ORDER BY a, event_id::VARCHAR)::BIGINT AS id_hecho, a AS nombre_agente, event_id::VARCHAR AS id_origen_registro FROM (SELECT {_AGENT} AS a, event_id FROM events) WHERE a IS NOT NULL")


def _persisted(spark, sf_dir) -> DataFrame:
    """Event types as tables and weekdays as runs; one run comes again, without any row in one of its tables."""
    e = read(spark, sf_dir, "events").select(F.concat(F.lit("day/"), F.dayofweek("ts").cast("string")).alias("run_id"), "event_id", "event_type", "value")
    names = ("click", "view", "purchase")
    store = tables.RunTables(spark, shared_folder(spark, "runs"), {n: "run_id string, event_id long, value double" for n in names})
    for run in ("day/1", "day/2", "day/3"):
        store.persist(run, {n: e.filter((F.col("event_type") == n) & (F.col("run_id") == run)) for n in names})
    store.persist("day/2", {n: e.filter((F.col("event_type") == n) & (F.col("run_id") == "day/2") & (F.col("value") > (1e9 if n == "view" else 20))) for n in names})
    every = reduce(DataFrame.unionByName, [store.read(n).withColumn("tabla", F.lit(n)) for n in names])
    return every.groupBy("tabla", "run_id").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("suma"))


_add(
    "persist_run",
    _persisted,
    """SELECT event_type AS tabla, 'day/' || (dayofweek(ts) + 1) AS run_id, count(*)::BIGINT AS n, sum(event_id)::BIGINT AS suma FROM events
WHERE event_type IN ('click', 'view', 'purchase') AND dayofweek(ts) < 3 AND (dayofweek(ts) <> 1 OR event_type <> 'view' AND value > 20) GROUP BY 1, 2""",
)


def _widened(spark, sf_dir) -> DataFrame:
    """Orders written as two versions of a table, of which the first lacks three columns."""
    o, root = read(spark, sf_dir, "orders"), shared_folder(spark, "versions")
    o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus").write.parquet(f"{root}/v1")
    later = o.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("metodo"), "o_totalprice", "o_orderdate")
    later.write.parquet(f"{root}/v2")
    wide = {"o_orderkey": "long", "o_orderstatus": "string", "metodo": "string", "o_totalprice": "double", "o_orderdate": "date"}
    return tables.read_widened(spark, [f"{root}/v1", f"{root}/v2"], wide, {"metodo": "sin_evidencia", "o_totalprice": 0})


_add(
    "schema_widened",
    _widened,
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'sin_evidencia' ELSE nullif(o_orderpriority, '5-LOW') END AS metodo, CASE WHEN o_orderkey % 2 = 0 THEN 0.0 ELSE o_totalprice END::DOUBLE AS o_totalprice,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate::DATE END AS o_orderdate FROM orders""",
)

# Files and sinks.


def _csv(spark, sf_dir) -> DataFrame:
    root = shared_folder(spark, "csv")
    s = read(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_totalprice")
    sinks.export_csv(s, root)
    text = raw.csv_records(spark, root)
    return text.select(*[F.get_json_object("raw_data", f"$.{c}").alias(c) for c in s.columns], F.size(F.json_object_keys("raw_data")).alias("columnas")).withColumn("o_totalprice", F.round(F.col("o_totalprice").cast("double"), 4)).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


_add("csv_records", _csv, "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, round(o_totalprice, 4) AS o_totalprice, 3 AS columnas FROM orders")
_add(
    "projected_table",
    lambda spark, sf_dir: raw.projected(spark, {"cliente": f"{sf_dir}/customer.parquet"}, {"c_custkey": "string", "c_acctbal": "decimal(12,2)"}, "cliente").withColumn("origen", F.lit("cliente")).unionByName(raw.projected(spark, {}, {"c_custkey": "string", "c_acctbal": "decimal(12,2)"}, "reviews").withColumn("origen", F.lit("reviews"))),
    "SELECT c_custkey::VARCHAR AS c_custkey, c_acctbal::DECIMAL(12,2) AS c_acctbal, 'cliente' AS origen FROM customer",
)


def _catalog_written(spark, sf_dir) -> DataFrame:
    """The catalog as JSON records, most pull requests first, with a file about them; read back, once over."""
    kept, rows = gold_queries._catalog(spark, sf_dir)
    root = shared_folder(spark, "catalog")
    for _ in range(2):
        sinks.write_catalog(spark, catalog.in_order(rows), f"{root}/out", None, catalog.agent_counts(kept).agg(F.count(F.lit(1)).alias("agentes")))
    back = sinks.read_written(spark, f"{root}/out")
    first = back.agg(F.min_by("pull_requests_count", "at_").alias("primero"), F.max("pull_requests_count").alias("mayor"), F.count(F.lit(1)).alias("filas"))
    return first.join(spark.read.json(f"{root}/out/_metadata")).select((F.col("primero") == F.col("mayor")).alias("en_orden"), "filas", "records", "agentes")


_add("cat_written", _catalog_written, f"WITH {gold_queries._PRS.format(suffix='')}, {gold_queries._GROUPED} SELECT true AS en_orden, count(*)::BIGINT AS filas, count(*)::BIGINT AS records, count(DISTINCT agent)::BIGINT AS agentes FROM g")


def _published(spark, sf_dir) -> DataFrame:
    """Two runs are published, the second one failed: the latest tables are those of the first."""
    root, e = shared_folder(spark, "published"), read(spark, sf_dir, "events").select("event_id", "event_type")
    sinks.publish(spark, {"ok": e.filter("event_type = 'click'"), "more": e.filter("event_type = 'view'")}, root, "run 1/a", "success")
    sinks.publish(spark, {"ok": e, "more": e}, root, "run 2", "failed")
    at = {"latest": "latest", "run_1_a": "runs/run_1_a", "run_2": "runs/run_2"}
    counts = [spark.read.option("header", "true").csv(f"{root}/{p}/{t}").agg(F.lit(n).alias("donde"), F.lit(t).alias("tabla"), F.count(F.lit(1)).alias("n")) for n, p in at.items() for t in ("ok", "more")]
    return reduce(DataFrame.unionByName, counts)


_add(
    "published_runs",
    _published,
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'click') AS k, count(*) FILTER (event_type = 'view') AS v FROM events)
SELECT unnest(['latest', 'latest', 'run_1_a', 'run_1_a', 'run_2', 'run_2']) AS donde, unnest(['ok', 'more', 'ok', 'more', 'ok', 'more']) AS tabla, unnest([k, v, k, v, n, n])::BIGINT AS n FROM c""",
)


def _partitioned(spark, sf_dir) -> DataFrame:
    root = shared_folder(spark, "parquet")
    e = read(spark, sf_dir, "events").select("event_id", "event_type")
    sinks.write_parquet(e.filter("event_id % 2 = 0"), root, ("event_type",))
    sinks.write_parquet(e.filter("event_id % 2 = 1"), root, ("event_type",), "append")
    return spark.read.parquet(root).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("primero"))


_add("parquet_sink", _partitioned, "SELECT event_type, count(*)::BIGINT AS n, min(event_id) AS primero FROM events GROUP BY 1")

# Quality of a run and of the layers.

_add(
    "q_run_issues",
    lambda spark, sf_dir: quality.run_issues(quality_queries._overall(spark, sf_dir), quality_queries._audit(spark, sf_dir)[2]),
    f"""WITH m AS ({quality_queries.ORACLES['q_overall_metrics']})
SELECT unnest(['raw_records', 'eligible_records', 'historical_duplicates_removed', 'expected_staging_records', 'materialized_staging_records', 'load_error_records', 'unmapped_agent_records']) AS metric_name,
  unnest([total_raw_records, eligible_records, total_duplicates_removed, expected_staging_records, total_staging_records, load_error_records, (SELECT count(*) FROM events WHERE event_type = 'view')])::BIGINT AS metric_value FROM m""",
)


def _carried(spark, sf_dir) -> DataFrame:
    """Outcomes since a day are this run's; sources without one have the state of the time before."""
    o, now = quality_queries._outcomes(spark, sf_dir), F.lit("2024-01-31").cast("timestamp")
    early, late = (quality.freshness(o.filter(f"execution_timestamp {c} timestamp'2024-01-29'"), now) for c in ("<", ">="))
    return quality.carry_forward(late, early).select("source", "last_attempt_at")


_add("q_carry_forward", _carried, "SELECT user_id::VARCHAR AS source, max(ts) AS last_attempt_at FROM events GROUP BY 1")
_add(
    "q_contract",
    lambda spark, sf_dir: quality.contract(read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", "value", F.col("ts").alias("fecha_carga"))).join(read(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("filas"))).drop("is_nullable"),
    """SELECT unnest([1, 2, 3, 4]) AS ordinal_position, unnest(['id', 'event_type', 'value', 'fecha_carga']) AS column_name, unnest(['bigint', 'string', 'double', 'timestamp_ntz']) AS data_type,
  unnest(['technical_surrogate_key', 'analytical_contract_column', 'analytical_contract_column', 'technical_audit_column']) AS contract_role, (SELECT count(*) FROM events)::BIGINT AS filas""",
)
_add(
    "audit_null_or_blank",
    lambda spark, sf_dir: quality.null_or_blank(quality_queries._docs(spark, sf_dir).withColumn("idioma", F.nullif("idioma", F.lit("en"))), ["fuente", "idioma", "comunidad"]),
    f"WITH d AS ({quality_queries._DOCS}) SELECT 'fuente' AS columna, count(*) FILTER (trim(fuente) = '')::BIGINT AS registros_nulos_o_vacios FROM d UNION ALL SELECT 'idioma', count(*) FILTER (idioma = 'en') FROM d UNION ALL SELECT 'comunidad', count(*) FILTER (comunidad = '') FROM d",
)
_TABLES = ("region", "customer", "orders", "lineitem")
_add(
    "audit_table_counts",
    lambda spark, sf_dir: quality.table_counts({t: read(spark, sf_dir, t) for t in _TABLES}),
    " UNION ALL ".join(f"SELECT '{t}' AS tabla, count(*)::BIGINT AS total_registros FROM {t}" for t in _TABLES),
)
_add(
    "audit_load_loss",
    lambda spark, sf_dir: quality.load_loss(read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "lineitem").filter("l_quantity > 3")),
    "WITH c AS (SELECT count(*)::BIGINT AS total_staging, (count(*) FILTER (l_quantity > 3))::BIGINT AS total_fact FROM lineitem) SELECT *, abs(total_staging - total_fact)::BIGINT AS diferencia, round(abs(total_staging - total_fact) * 100.0 / total_staging, 4)::DOUBLE AS porcentaje_merma FROM c",
)
_add(
    "audit_period",
    lambda spark, sf_dir: quality.period(activity(spark, sf_dir, ["fecha_evento"]), "fecha_evento", "1993-01-01", "1997-12-31"),
    f"WITH {ACT} SELECT min(fecha_evento) AS desde, max(fecha_evento) AS hasta, count(*)::BIGINT AS total, count(*) FILTER (fecha_evento NOT BETWEEN DATE '1993-01-01' AND DATE '1997-12-31')::BIGINT AS fuera, count(*) FILTER (fecha_evento NOT BETWEEN DATE '1993-01-01' AND DATE '1997-12-31') = 0 AS valido FROM act",
)


def _resolved(spark, sf_dir) -> DataFrame:
    """Orders as files, their customers as runs: the newest run of a source, and its files."""
    files = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("fuente"), F.concat_ws("-", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_custkey").alias("run_id"), F.struct("o_orderdate", "o_custkey").alias("fecha_carga"))
    run = quality.resolve_run(files, ["1-URGENT"], mixed=True)
    return files.filter(F.col("run_id") == run).groupBy("run_id").agg(F.count(F.lit(1)).alias("archivos"))


_add(
    "q_resolve_run",
    _resolved,
    """WITH f AS (SELECT strftime(o_orderdate, '%Y-%m-%d') || '-' || o_custkey AS run_id, o_orderpriority AS fuente, o_orderdate, o_custkey FROM orders)
SELECT run_id, count(*)::BIGINT AS archivos FROM f WHERE run_id = (SELECT run_id FROM f WHERE fuente = '1-URGENT' ORDER BY o_orderdate DESC, o_custkey DESC LIMIT 1) GROUP BY 1""",
)
_add(
    "q_publication_status",
    lambda spark, sf_dir: quality.publication_status(read(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("value") > 5).alias("raw"), F.count_if(F.col("event_type") == "error").alias("load_errors"), F.min(F.when(F.col("event_type") == "purchase", "success").otherwise("partial_success")).alias("requested"))),
    """WITH u AS (SELECT user_id, count(*) FILTER (value > 5)::BIGINT AS raw, count(*) FILTER (event_type = 'error')::BIGINT AS load_errors, min(CASE WHEN event_type = 'purchase' THEN 'success' ELSE 'partial_success' END) AS requested FROM events GROUP BY 1)
SELECT *, CASE WHEN load_errors > 0 THEN 'failed' WHEN raw = 0 THEN 'empty' ELSE requested END AS status FROM u""",
)

# Reports over the stored star schema.


def _star(spark, sf_dir) -> tables.Snapshots:
    snapshots = tables.Snapshots(spark, shared_folder(spark, "star"))
    dims, fact = gold.load(gold_queries._staging_parts(spark, sf_dir))
    star.store(snapshots, dims, fact)
    forget_all(spark, fact, *dims.values())  # reports read what is stored
    return snapshots


_FACTS = f"""{gold_queries._STAGING}, f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY agente, fuente, tipo, plat, id_origen_registro ORDER BY fecha DESC, file DESC, record DESC, l_returnflag DESC, l_linestatus DESC, i DESC, pop DESC) = 1)"""
_add(
    "star_source_share",
    lambda spark, sf_dir: kpi.source_share(star.activity(_star(spark, sf_dir), ["nombre_fuente", "tipo_fuente", "cantidad_menciones", "cantidad_interacciones"], "1995-03-10", "1996-11-20")),
    f"WITH {_FACTS} SELECT fuente AS nombre_fuente, tipo AS tipo_fuente, count(*)::BIGINT AS total_observaciones, sum(m)::BIGINT AS total_menciones, sum(i)::BIGINT AS total_interacciones, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS porcentaje_participacion FROM f WHERE fecha BETWEEN DATE '1995-03-10' AND DATE '1996-11-20' GROUP BY 1, 2",
)
_add(
    "star_monthly_trend",
    lambda spark, sf_dir: kpi.by_month(star.activity(_star(spark, sf_dir), ["fecha_evento", "cantidad_menciones", "cantidad_interacciones", "score_actividad", "score_popularidad", "score_adopcion"])).drop("promedio_adopcion"),
    f"WITH {_FACTS} SELECT year(fecha)::INTEGER AS anio, month(fecha)::INTEGER AS mes, count(*)::BIGINT AS total_observaciones, sum(m)::BIGINT AS total_menciones, sum(i)::BIGINT AS total_interacciones, round(sum(i + p_size)::DOUBLE, 4) AS score_actividad_total, round(sum(pop::DECIMAL(12,4))::DOUBLE / count(*), 4) AS promedio_popularidad FROM f GROUP BY 1, 2",
)
