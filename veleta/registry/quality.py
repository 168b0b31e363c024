"""Quality and governance queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.operators.measures import share, share_where
from veleta.operators.rules import OTHER_AGENT
from veleta.plans import governance
from veleta.plans import quality as q
from veleta.plans.activity import SQL as ACT
from veleta.plans.activity import activity, read

QUERIES, ORACLES = {}, {}


def _add(name: str, query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


_EVENT_KEY = ("event_type", "user_id")


def _reconcile(spark, sf_dir) -> DataFrame:
    """By event type: events are raw, those with a value eligible, older versions of a user duplicates."""
    e = read(spark, sf_dir, "events").filter("user_id is not null")
    by = e.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 10).alias("ok"))
    counts = by.groupBy("event_type").agg(
        F.sum("n").alias("raw"), F.sum("ok").alias("eligible"), F.sum(F.greatest(F.col("ok") - 1, F.lit(0))).alias("duplicates"), F.count_if(F.col("ok") > 2).alias("materialized")
    )
    return q.reconcile(counts)


_add(
    "q_reconcile",
    _reconcile,
    """WITH b AS (SELECT event_type, user_id, count(*) AS n, count(*) FILTER (value > 10) AS ok FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2),
c AS (SELECT event_type, sum(n)::BIGINT AS raw, sum(ok)::BIGINT AS el, sum(greatest(ok - 1, 0))::BIGINT AS dup, (count(*) FILTER (ok > 2))::BIGINT AS done FROM b GROUP BY 1),
d AS (SELECT *, el - dup AS ex, greatest(el - dup - done, 0) AS er FROM c)
SELECT event_type, raw AS total_raw_records, el AS eligible_records, dup AS total_duplicates_removed, ex AS expected_staging_records, done AS total_staging_records, er AS load_error_records,
  CASE WHEN ex = 0 THEN CASE WHEN raw > 0 THEN 100.0 ELSE 0.0 END ELSE least(round_even(done * 100.0 / ex, 2), 100.0) END::DOUBLE AS completion_rate,
  CASE WHEN ex = 0 THEN 0.0 ELSE round_even(er * 100.0 / ex, 2) END::DOUBLE AS overall_error_rate,
  CASE WHEN el = 0 THEN 0.0 ELSE round_even(dup * 100.0 / el, 2) END::DOUBLE AS deduplication_rate FROM d""",
)

_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'empty' ELSE 'success' END"


def _outcomes(spark, sf_dir) -> DataFrame:
    """Events as outcomes: users stand for sources, clicks are summaries."""
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "empty").otherwise("success")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("source"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("query"),
        status.alias("status"),
        F.floor("value").cast("long").alias("records_extracted"),
        F.col("ts").alias("execution_timestamp"),
    )


_add(
    "q_freshness",
    lambda spark, sf_dir: q.freshness(_outcomes(spark, sf_dir), F.lit("2024-01-31").cast("timestamp")),
    f"""WITH o AS (SELECT user_id::VARCHAR AS source, CASE WHEN event_type <> 'click' THEN event_type END AS query, {_STATUS} AS status, floor(value)::BIGINT AS n, ts FROM events)
SELECT source, (list(status ORDER BY (query IS NULL) DESC, ts DESC, status DESC))[1] AS latest_status,
  coalesce(sum(n) FILTER (query IS NULL), sum(n))::BIGINT AS records_extracted, max(ts) AS last_attempt_at,
  nullif(count(*) FILTER (query IS NOT NULL), 0)::BIGINT AS expected_queries,
  CASE WHEN count(*) FILTER (query IS NOT NULL) > 0 THEN count(*) FILTER (query IS NOT NULL AND status <> 'failed') END::BIGINT AS completed_queries,
  max(ts) FILTER (status <> 'failed') AS last_success_at,
  CASE WHEN max(ts) FILTER (status <> 'failed') IS NOT NULL THEN round_even(greatest(floor(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts) FILTER (status <> 'failed')))), 0) / 3600.0, 2)::DOUBLE END AS age_hours,
  coalesce(round_even(greatest(floor(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(ts) FILTER (status <> 'failed')))), 0) / 3600.0, 2) > 24.0, true) OR max(ts) FILTER (status <> 'failed') IS NULL AS is_stale
FROM o GROUP BY source""",
)

_DOCS = """SELECT source AS fuente, lang AS idioma, CASE WHEN n_chars % 3 = 0 THEN 'N/A' ELSE lang END AS plataforma, CASE WHEN n_chars % 2 = 0 THEN '' ELSE source END AS comunidad,
  CASE WHEN n_chars > 2000 THEN 0.9 ELSE 0.0 END AS confianza, doc_id, n_chars FROM documents"""


def _docs(spark, sf_dir) -> DataFrame:
    n = F.col("n_chars")
    return read(spark, sf_dir, "documents").select(
        F.col("source").alias("fuente"),
        F.col("lang").alias("idioma"),
        F.when(n % 3 == 0, "N/A").otherwise(F.col("lang")).alias("plataforma"),
        F.when(n % 2 == 0, "").otherwise(F.col("source")).alias("comunidad"),
        F.when(n > 2000, 0.9).otherwise(0.0).alias("confianza"),
        "doc_id",
        "n_chars",
    )


_THRESHOLDS = {"platform": 60, "community": 55, "llm": 40}


def _coverage(spark, sf_dir) -> DataFrame:
    return q.coverage(_docs(spark, sf_dir), "fuente", {"platform": "plataforma", "community": "comunidad"}, "confianza", _THRESHOLDS)


_COVERAGE = f"""WITH d AS ({_DOCS}), b AS (SELECT fuente, count(*)::BIGINT AS n, count(*) FILTER (lower(trim(plataforma)) NOT IN ('', 'n/a'))::BIGINT AS p, count(*) FILTER (comunidad <> '')::BIGINT AS c, count(*) FILTER (confianza > 0)::BIGINT AS l FROM d GROUP BY 1),
u AS (SELECT fuente, n, 'platform' AS dimension, p AS k, 60.0 AS t FROM b UNION ALL SELECT fuente, n, 'community', c, 55.0 FROM b UNION ALL SELECT fuente, n, 'llm', l, 40.0 FROM b),
w AS (SELECT fuente AS source, n AS total_count, dimension, k AS covered_count, round_even(k * 100.0 / n, 2)::DOUBLE AS coverage_pct, t::DOUBLE AS threshold_pct FROM u)"""
_add("q_coverage", _coverage, f"{_COVERAGE} SELECT *, coverage_pct < threshold_pct AS warning FROM w")
_add(
    "q_coverage_warnings",
    lambda spark, sf_dir: q.warnings_text(_coverage(spark, sf_dir)),
    f"{_COVERAGE} SELECT printf('%s/%s: %.2f%% < %.2f%%', source, dimension, coverage_pct, threshold_pct) AS aviso FROM w WHERE coverage_pct < threshold_pct",
)

_add(
    "q_comparable",
    lambda spark, sf_dir: q.comparable(activity(spark, sf_dir, ["nombre_fuente", "nombre_agente", "cantidad_menciones", "cantidad_interacciones"]), "nombre_fuente", "nombre_agente", ["cantidad_menciones", "cantidad_interacciones"]).withColumn("raw_value", F.round("raw_value", 6)),
    f"""WITH {ACT}, g AS (SELECT nombre_fuente AS source, nombre_agente AS agent, avg(cantidad_menciones) AS m, avg(cantidad_interacciones) AS i FROM act GROUP BY 1, 2),
u AS (SELECT source, agent, 'cantidad_menciones' AS metric_name, m AS v FROM g UNION ALL SELECT source, agent, 'cantidad_interacciones', i FROM g)
SELECT source, agent, metric_name, round(v, 6) AS raw_value, round_even(CASE WHEN max(v) OVER w = min(v) OVER w THEN 0.0 ELSE (v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w) END, 6) AS normalized_value
FROM u WINDOW w AS (PARTITION BY source, metric_name)""",
)
_add(
    "q_sample",
    lambda spark, sf_dir: q.stratified_sample(_docs(spark, sf_dir), "fuente", "idioma", F.col("doc_id"), "seed", 2).select("fuente", "idioma", "doc_id", "sample_key"),
    f"WITH d AS ({_DOCS}), k AS (SELECT fuente, idioma, doc_id, sha256('seed|' || doc_id) AS sample_key FROM d) SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY fuente, idioma ORDER BY sample_key) <= 2",
)


def _holes(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select("event_type", "user_id", F.when(F.col("value") > 20, F.col("value")).alias("value"), F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ts"), "props", "event_id")


_HOLES = "SELECT event_type, user_id, CASE WHEN value > 20 THEN value END AS value, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts, props, event_id FROM events"
_add(
    "q_nulls",
    lambda spark, sf_dir: q.nulls(_holes(spark, sf_dir), "event_type", {"value": "median", "ts": "drop", "props": "unknown"}),
    f"""WITH h AS ({_HOLES}), b AS (SELECT event_type AS source, count(*)::BIGINT AS total, count(*) FILTER (value IS NULL)::BIGINT AS v, count(*) FILTER (ts IS NULL)::BIGINT AS t, count(*) FILTER (props IS NULL)::BIGINT AS p FROM h GROUP BY 1),
u AS (SELECT source, total, 'value' AS columna, v AS nulos, 'median' AS estrategia FROM b UNION ALL SELECT source, total, 'ts', t, 'drop' FROM b UNION ALL SELECT source, total, 'props', p, 'unknown' FROM b)
SELECT source, total, columna, nulos, round(nulos * 100.0 / total, 2)::DOUBLE AS porcentaje, estrategia FROM u""",
)
_add("q_critical", lambda spark, sf_dir: q.critical_nulls(_holes(spark, sf_dir), ["value", "ts", "user_id"]), f"WITH h AS ({_HOLES}) SELECT count(*)::BIGINT AS filas_con_nulo_critico FROM h WHERE value IS NULL OR ts IS NULL OR user_id IS NULL")
_DEDUP = "WITH g AS (SELECT event_type AS source, user_id, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT source, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS detectados, sum(n - 1)::BIGINT AS eliminados, count(*)::BIGINT AS conservados FROM g GROUP BY 1)"
_dedup = lambda spark, sf_dir: q.dedup_report(read(spark, sf_dir, "events"), "event_type", ("user_id",))
_add("q_dedup_report", _dedup, f"{_DEDUP} SELECT * FROM r")
_add("q_purge_rate", lambda spark, sf_dir: q.purge_rate(_dedup(spark, sf_dir)), f"{_DEDUP} SELECT *, round(eliminados * 100.0 / (eliminados + conservados), 2)::DOUBLE AS tasa_depuracion FROM r")
_add(
    "q_issues",
    lambda spark, sf_dir: q.issues(_holes(spark, sf_dir), {"sin_valor": F.col("value").isNull(), "sin_fecha": F.col("ts").isNull(), "errores": F.col("event_type") == "error", "http": F.col("props").ilike('%"K": 4%')}),
    f"WITH h AS ({_HOLES}) SELECT 'sin_valor' AS metrica, (count(*) FILTER (value IS NULL))::BIGINT AS valor FROM h UNION ALL SELECT 'sin_fecha', count(*) FILTER (ts IS NULL) FROM h UNION ALL SELECT 'errores', count(*) FILTER (event_type = 'error') FROM h UNION ALL SELECT 'http', count(*) FILTER (props ILIKE '%\"K\": 4%') FROM h",
)
_add(
    "cast_report",
    lambda spark, sf_dir: q.casts(read(spark, sf_dir, "documents").select("source", F.col("text").alias("texto"), F.col("n_chars").cast("string").alias("largo")), "source", {"texto": "double", "largo": "bigint"}),
    "WITH u AS (SELECT source, 'texto' AS columna, text AS v, try_cast(trim(text) AS DOUBLE) IS NULL AS bad FROM documents UNION ALL SELECT source, 'largo', n_chars::VARCHAR, false FROM documents) SELECT source, columna, (count(*) FILTER (bad AND v IS NOT NULL))::BIGINT AS fallos, min(v) FILTER (bad) AS ejemplo FROM u GROUP BY 1, 2",
)
_add("q_run_status", lambda spark, sf_dir: q.run_status(_outcomes(spark, sf_dir)), f"SELECT CASE WHEN bool_or(s = 'failed') AND (bool_or(s = 'success') OR sum(n) > 0) THEN 'partial_success' WHEN bool_or(s = 'failed') THEN 'failed' WHEN bool_or(s = 'success') THEN 'success' ELSE 'empty' END AS status FROM (SELECT {_STATUS} AS s, floor(value) AS n FROM events)")
_add(
    "audit_staging_summary",
    lambda spark, sf_dir: q.staging_summary(activity(spark, sf_dir, ["fecha_evento", "nombre_fuente", "nombre_agente"]), "fecha_evento", "nombre_fuente", "nombre_agente", "1995-01-01", "2001-12-31"),
    f"WITH {ACT} SELECT count(*)::BIGINT AS total, count(DISTINCT nombre_fuente)::BIGINT AS fuentes, count(DISTINCT nombre_agente)::BIGINT AS agentes, min(fecha_evento) AS desde, max(fecha_evento) AS hasta, (max(fecha_evento) - min(fecha_evento))::INTEGER AS dias, CASE WHEN min(fecha_evento) >= DATE '1995-01-01' AND max(fecha_evento) <= DATE '2001-12-31' THEN 'VALIDO' ELSE 'FUERA DE RANGO' END AS periodo FROM act",
)
for _name, _column in (("source", "nombre_fuente"), ("agent", "nombre_agente"), ("technology", "nombre_tecnologia")):
    _add(
        f"audit_distribution_{_name}",
        lambda spark, sf_dir, c=_column: q.distribution(activity(spark, sf_dir, [c]), c),
        f"WITH {ACT} SELECT {_column} AS valor, count(*)::BIGINT AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS porcentaje FROM act GROUP BY 1",
    )
_add(
    "audit_duplicate_groups",
    lambda spark, sf_dir: q.duplicate_groups(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
_add(
    "audit_gold_checks",
    lambda spark, sf_dir: q.gold_checks(
        read(spark, sf_dir, "lineitem"),
        read(spark, sf_dir, "lineitem"),
        {"orders": (read(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey"), "part": (read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")},
        ["l_orderkey", "l_linenumber"],
        ["l_quantity", "l_discount"],
        "l_shipdate",
    ),
    """WITH v AS (SELECT 'fact_rows' AS check_name, count(*)::BIGINT AS value FROM lineitem UNION ALL SELECT 'staging_rows', count(*) FROM lineitem UNION ALL SELECT 'null_dates', count(*) FROM lineitem WHERE l_shipdate IS NULL
UNION ALL SELECT 'negative_measures', count(*) FROM lineitem WHERE l_quantity < 0 OR l_discount < 0 UNION ALL SELECT 'orphans_orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT 'orphans_part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'duplicate_grains', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
SELECT check_name, value, check_name IN ('fact_rows', 'staging_rows') OR value = 0 AS ok FROM v""",
)
_add(
    "imputed_share",
    lambda spark, sf_dir: share_where(_holes(spark, sf_dir), "event_type", F.col("ts").isNull(), "pct_imputado"),
    f"WITH h AS ({_HOLES}) SELECT event_type, round(avg(CASE WHEN ts IS NULL THEN 1.0 ELSE 0.0 END) * 100, 2)::DOUBLE AS pct_imputado FROM h GROUP BY 1",
)
_add(
    "provenance_counts",
    lambda spark, sf_dir: read(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).withColumn("pct", share("n")),
    "SELECT source, lang, count(*)::BIGINT AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS pct FROM documents GROUP BY 1, 2",
)


# Users stand for runs, event types for sources.
_RUN_EVENTS = "SELECT user_id AS run_id, CASE WHEN event_type <> 'click' THEN event_type END AS query, floor(value)::BIGINT AS records_extracted, event_type AS fuente, ts, event_id FROM events"


def _runs(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("query"),
        F.floor("value").cast("long").alias("records_extracted"),
        F.col("event_type").alias("fuente"),
        "ts",
        "event_id",
    )


_add(
    "gov_evidence_summary",
    lambda spark, sf_dir: governance.evidence_summary(_runs(spark, sf_dir)),
    f"WITH e AS ({_RUN_EVENTS}) SELECT run_id, count(*)::BIGINT AS eventos, coalesce(sum(records_extracted) FILTER (query IS NULL), sum(records_extracted) FILTER (query IS NOT NULL), 0)::BIGINT AS registros FROM e GROUP BY 1",
)
_add(
    "gov_latest_rows",
    lambda spark, sf_dir: governance.read_rows(_runs(spark, sf_dir), ["fuente", "run_id"], "event_id").select("fuente", "run_id", "event_id"),
    "SELECT event_type AS fuente, user_id AS run_id, max(event_id) AS event_id FROM events GROUP BY 1, 2",
)
_add(
    "gov_rows_of_run",
    lambda spark, sf_dir: governance.read_rows(_runs(spark, sf_dir), ["fuente"], "event_id", 7).select("fuente", "event_id"),
    "SELECT event_type AS fuente, event_id FROM events WHERE user_id = 7",
)
_add(
    "gov_close_run",
    lambda spark, sf_dir: governance.close_run(
        _runs(spark, sf_dir).select("run_id").distinct(),
        _runs(spark, sf_dir).filter("fuente = 'view'").groupBy("run_id").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("records_extracted") > 9).alias("staging")),
        _runs(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("raw"), F.count("query").alias("staging")),
    ),
    f"""WITH e AS ({_RUN_EVENTS}), s AS (SELECT run_id, count(*) AS r, count(*) FILTER (records_extracted > 9) AS d FROM e WHERE fuente = 'view' GROUP BY 1), n AS (SELECT run_id, count(*) AS r, count(query) AS d FROM e GROUP BY 1),
c AS (SELECT n.run_id, coalesce(s.r, n.r)::BIGINT AS total_raw, coalesce(s.d, n.d)::BIGINT AS total_staging FROM n LEFT JOIN s USING (run_id)) SELECT *, round(total_staging * 100.0 / total_raw, 2)::DOUBLE AS tasa_completitud FROM c""",
)
_add(
    "gov_homologation",
    lambda spark, sf_dir: governance.homologation(
        read(spark, sf_dir, "part").filter("p_size < 25").select("p_name", F.lit("antes").alias("origen")).distinct(),
        read(spark, sf_dir, "part").select("p_name", F.lit("ahora").alias("origen")),
        ["p_name"],
    ),
    "SELECT p_name, CASE WHEN bool_or(p_size < 25) THEN 'antes' ELSE 'ahora' END AS origen FROM part GROUP BY 1",
)
_add(
    "gov_dependent_runs",
    lambda spark, sf_dir: governance.dependent_runs(_runs(spark, sf_dir).filter("records_extracted > 60"), _runs(spark, sf_dir).filter("fuente = 'signup'").select("run_id", F.col("records_extracted").alias("data_run_id")), "click"),
    "WITH d AS (SELECT DISTINCT user_id AS run_id FROM events WHERE floor(value) > 60 AND event_type = 'click') SELECT run_id FROM d UNION SELECT user_id FROM events WHERE event_type = 'signup' AND floor(value)::BIGINT IN (SELECT run_id FROM d)",
)
_add(
    "gov_after_retirement",
    lambda spark, sf_dir: governance.after_retirement(
        _runs(spark, sf_dir).groupBy("run_id").agg(F.count(F.lit(1)).alias("total")), _runs(spark, sf_dir).filter("fuente = 'click' and records_extracted > 60").select("run_id").distinct(), ["total"]
    ),
    "SELECT user_id AS run_id, CASE WHEN bool_or(event_type = 'click' AND floor(value) > 60) THEN NULL ELSE count(*)::BIGINT END AS total FROM events GROUP BY 1",
)


# Events as raw records of runs (the users), their types as agents; later versions of a user's events are duplicates.

def _audit(spark, sf_dir) -> tuple[DataFrame, ...]:
    """Files (one a day), records, candidates, staged rows and errors."""
    e = read(spark, sf_dir, "events").withColumn("raw_file_id", F.dayofyear("ts").cast("long"))
    files = e.groupBy(F.col("raw_file_id").alias("id")).agg(F.when(F.col("raw_file_id") <= 10, "r1").otherwise("r2").alias("run_id"))
    records = e.select(F.col("event_id").alias("id"), "raw_file_id", F.when(F.col("event_type") == "signup", "r1").alias("run_id"))
    agent = F.when(F.col("event_type") == "view", OTHER_AGENT).otherwise(F.col("event_type"))
    candidates = e.select("raw_file_id", F.col("event_type").alias("fuente"), agent.alias("nombre_agente"), "user_id", "event_id", F.when(F.col("value") > 20, F.col("value")).alias("valor"), F.col("props").alias("texto"))
    staged = candidates.filter("texto not like '%5}'")
    errors = e.select(F.when(F.col("event_type") == "error", "HTTPError").otherwise("other").alias("error_type"), F.concat(F.lit("status 4"), F.floor("value")).alias("description"))
    return files, records, candidates, staged, errors


def _overall(spark, sf_dir) -> DataFrame:
    files, records, candidates, staged, _ = _audit(spark, sf_dir)
    return q.overall_metrics(records, files, candidates, staged, ["valor"], "r1", ["nombre_agente", "user_id"])


_add(
    "q_overall_metrics",
    _overall,
    """WITH e AS (SELECT *, CASE WHEN dayofyear(ts) <= 10 THEN 'r1' ELSE 'r2' END AS file_run FROM events), el AS (SELECT * FROM e WHERE file_run = 'r1' AND event_type <> 'view'), st AS (SELECT * FROM e WHERE file_run = 'r1' AND props NOT LIKE '%5}'),
c AS (SELECT (SELECT count(*) FROM e WHERE event_type = 'signup' OR file_run = 'r1')::BIGINT AS raw, (SELECT count(*) FROM el)::BIGINT AS el, (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM el GROUP BY event_type, user_id))::BIGINT AS dup, (SELECT count(*) FROM st)::BIGINT AS done, (SELECT count(*) FROM st WHERE value <= 20 OR value IS NULL)::BIGINT AS nulls),
d AS (SELECT *, el - dup AS ex, greatest(el - dup - done, 0) AS er FROM c)
SELECT nulls AS total_nulls_removed, raw AS total_raw_records, el AS eligible_records, dup AS total_duplicates_removed, ex AS expected_staging_records, done AS total_staging_records, er AS load_error_records,
  CASE WHEN ex = 0 THEN CASE WHEN raw > 0 THEN 100.0 ELSE 0.0 END ELSE least(round_even(done * 100.0 / ex, 2), 100.0) END::DOUBLE AS completion_rate, CASE WHEN ex = 0 THEN 0.0 ELSE round_even(er * 100.0 / ex, 2) END::DOUBLE AS overall_error_rate,
  CASE WHEN el = 0 THEN 0.0 ELSE round_even(dup * 100.0 / el, 2) END::DOUBLE AS deduplication_rate FROM d""",
)


def _breakdown(spark, sf_dir) -> DataFrame:
    _, records, candidates, staged, errors = _audit(spark, sf_dir)
    return q.issue_breakdown(records, candidates, staged, errors, ["valor"], {"texto": "double"}, ["nombre_agente", "user_id"])


_add(
    "q_issue_breakdown",
    _breakdown,
    """WITH st AS (SELECT * FROM events WHERE props NOT LIKE '%5}'), c AS (SELECT (SELECT count(*) FROM events)::BIGINT AS a, (SELECT count(*) FROM st)::BIGINT AS b, (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM events GROUP BY event_type, user_id))::BIGINT AS d,
  (SELECT count(*) FROM events WHERE event_type = 'error' OR ('4' || floor(value)::BIGINT) LIKE '%429%' OR ('4' || floor(value)::BIGINT) LIKE '%403%')::BIGINT AS h,
  (SELECT count(*) FROM st WHERE event_type = 'view')::BIGINT AS u, (SELECT count(*) FROM st WHERE value <= 20 OR value IS NULL)::BIGINT AS n, (SELECT count(*) FROM events WHERE props IS NOT NULL AND try_cast(props AS DOUBLE) IS NULL)::BIGINT AS f)
SELECT 'raw_records' AS metric_name, a AS metric_value FROM c UNION ALL SELECT 'staging_records', b FROM c UNION ALL SELECT 'real_duplicate_records_removed', d FROM c UNION ALL SELECT 'key_conflicts_or_preexisting_records', greatest(greatest(a - b, 0) - d - n, 0) FROM c
UNION ALL SELECT 'http_errors_logged', h FROM c UNION ALL SELECT 'unmapped_agent_records', u FROM c UNION ALL SELECT 'critical_null_records', n FROM c UNION ALL SELECT 'casting_or_transformation_errors', f FROM c""",
)
_add("q_unmapped", lambda spark, sf_dir: q.unmapped(_audit(spark, sf_dir)[3]), "SELECT (count(*) FILTER (event_type = 'view'))::BIGINT AS sin_homologar FROM events WHERE props NOT LIKE '%5}'")
