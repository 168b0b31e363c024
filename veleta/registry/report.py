"""KPI, report and derived queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from veleta.operators.measures import concentration
from veleta.plans import derived, kpi, reports
from veleta.plans.activity import SQL as ACT
from veleta.plans.activity import activity, read
from veleta.plans.reports import Filters

YEARS = Filters(start="1996-01-01", end="1999-12-31", exclude=("Brand#11",))
SCOPED = Filters(start="1996-06-15", agents=("Brand#12", "Brand#23", "Brand#34"), source="1-urgent", scope=("1-URGENT", "2-HIGH", "3-MEDIUM"))
OPEN_SOURCES, OPEN_PLATFORMS = ["1-URGENT", "2-HIGH"], ["ASIA"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

QUERIES, ORACLES = {}, {}


def _add(name: str, plan, columns: str, sql: str) -> None:
    """`columns`: what the plan reads of the activity view; tables that give none of them are not joined."""
    QUERIES[name] = lambda spark, sf_dir: plan(activity(spark, sf_dir, columns.split()))
    ORACLES[name] = f"WITH {ACT}{', ' if sql.lstrip().startswith('+') else ' '}{sql.lstrip().removeprefix('+')}"


_N = "count(*)::BIGINT AS total_observaciones"
_M = "sum(cantidad_menciones)::BIGINT AS total_menciones"
_I = "sum(cantidad_interacciones)::BIGINT AS total_interacciones"


def _mean(c: str, name: str) -> str:
    return f"round(CAST(sum({c}) AS DOUBLE) / count({c}), 4) AS {name}"


def _sum(c: str, name: str) -> str:
    return f"round(CAST(sum({c}) AS DOUBLE), 4) AS {name}"


_SHARE = "round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE"
_MONTH = f"+ m AS (SELECT year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, {_N}, {_M}, {_I}, {_sum('score_actividad', 'score_actividad_total')} FROM act GROUP BY 1, 2)"
_PCT = "round((total_observaciones - lag(total_observaciones) OVER w) * 100.0 / nullif(lag(total_observaciones) OVER w, 0), 2)::DOUBLE"
_W1 = "fecha_evento BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND nombre_agente <> 'Brand#11'"
_W2 = (
    "fecha_evento >= DATE '1996-06-15' AND nombre_agente IN ('Brand#12', 'Brand#23', 'Brand#34') AND lower(nombre_fuente) = '1-urgent' "
    "AND nombre_fuente IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
)
_OPEN = "(nombre_fuente IN ('1-URGENT', '2-HIGH') OR nombre_plataforma IN ('ASIA'))"

_add("kpi_adoption", kpi.adoption, "nombre_agente categoria_agente cantidad_menciones cantidad_interacciones score_adopcion", f"SELECT nombre_agente, categoria_agente, {_N}, {_M}, {_I}, {_mean('score_adopcion', 'promedio_score_adopcion')}, {_sum('score_adopcion', 'score_adopcion_total')} FROM act GROUP BY 1, 2")
_add("kpi_source_share", kpi.source_share, "nombre_fuente tipo_fuente cantidad_menciones cantidad_interacciones", f"SELECT nombre_fuente, tipo_fuente, {_N}, {_M}, {_I}, {_SHARE} AS porcentaje_participacion FROM act GROUP BY 1, 2")
_add("kpi_monthly_trend", kpi.by_month, "fecha_evento cantidad_menciones cantidad_interacciones score_actividad score_popularidad score_adopcion", f"SELECT year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, {_N}, {_M}, {_I}, {_sum('score_actividad', 'score_actividad_total')}, {_mean('score_popularidad', 'promedio_popularidad')}, {_mean('score_adopcion', 'promedio_adopcion')} FROM act GROUP BY 1, 2")
_add("kpi_agent_ranking", kpi.agent_ranking, "nombre_agente score_actividad score_popularidad score_adopcion", f"+ s AS (SELECT nombre_agente, {_N}, sum(score_actividad + score_popularidad + score_adopcion) AS t FROM act GROUP BY 1) SELECT nombre_agente, total_observaciones, round(t::DOUBLE, 4) AS score_total_relevancia, rank() OVER (ORDER BY t DESC)::INTEGER AS ranking_agente, dense_rank() OVER (ORDER BY total_observaciones DESC)::INTEGER AS ranking_por_observaciones FROM s")
_add("kpi_open_popularity", lambda a: kpi.open_source_popularity(a, OPEN_SOURCES, OPEN_PLATFORMS), "nombre_agente nombre_fuente nombre_plataforma cantidad_interacciones score_popularidad score_actividad", f"SELECT nombre_agente, nombre_fuente, nombre_plataforma, {_N}, {_I}, {_mean('score_popularidad', 'promedio_score_popularidad')}, {_sum('score_actividad', 'score_actividad_total')} FROM act WHERE {_OPEN} GROUP BY 1, 2, 3")
_add("kpi_monthly_growth", kpi.monthly_growth, "fecha_evento cantidad_menciones cantidad_interacciones score_actividad score_popularidad score_adopcion", f"{_MONTH} SELECT anio, mes, total_observaciones, lag(total_observaciones) OVER w AS observaciones_mes_anterior, total_observaciones - coalesce(lag(total_observaciones) OVER w, 0) AS variacion_absoluta, {_PCT} AS variacion_porcentual, total_menciones, total_interacciones, score_actividad_total FROM m WINDOW w AS (ORDER BY anio, mes)")
_add("kpi_platform_distribution", kpi.platform_distribution, "nombre_plataforma tipo_plataforma cantidad_menciones cantidad_interacciones score_popularidad", f"SELECT nombre_plataforma, tipo_plataforma, {_N}, {_M}, {_I}, {_mean('score_popularidad', 'promedio_popularidad')}, {_SHARE} AS porcentaje_distribucion, dense_rank() OVER (ORDER BY count(*) DESC)::INTEGER AS ranking_plataforma FROM act GROUP BY 1, 2")
_add("q_overall", lambda a: kpi.overall(a, 1996, 1999), "fecha_evento nombre_agente nombre_fuente nombre_plataforma cantidad_menciones score_adopcion", f"SELECT {_N}, count(DISTINCT nombre_agente)::BIGINT AS agentes, count(DISTINCT nombre_fuente)::BIGINT AS fuentes, count(DISTINCT nombre_plataforma)::BIGINT AS plataformas, {_M}, {_mean('score_adopcion', 'promedio_adopcion')}, min(fecha_evento) AS primera_fecha, max(fecha_evento) AS ultima_fecha FROM act WHERE year(fecha_evento) BETWEEN 1996 AND 1999")
_add("q_top10", kpi.top_agents, "nombre_agente cantidad_menciones score_adopcion", f"+ s AS (SELECT nombre_agente, {_N}, {_M}, {_sum('score_adopcion', 'score_adopcion_total')} FROM act GROUP BY 1) SELECT *, rank() OVER (ORDER BY score_adopcion_total DESC, total_observaciones DESC)::INTEGER AS ranking FROM s ORDER BY ranking, nombre_agente LIMIT 10")
_add("q_source_activity_share", kpi.source_activity_share, "nombre_fuente score_actividad", f"+ s AS (SELECT nombre_fuente, count(*)::BIGINT AS total_observaciones, sum(score_actividad)::DOUBLE AS a FROM act GROUP BY 1) SELECT nombre_fuente, total_observaciones, round(total_observaciones * 100.0 / sum(total_observaciones) OVER (), 2)::DOUBLE AS porcentaje_observaciones, round(a * 100.0 / sum(a) OVER (), 2) AS porcentaje_actividad FROM s")
_add("q_community_rank", kpi.community_rank, "nombre_plataforma nombre_comunidad nombre_agente", f"SELECT nombre_plataforma, nombre_comunidad, {_N}, count(DISTINCT nombre_agente)::BIGINT AS agentes, dense_rank() OVER (ORDER BY count(*) DESC)::INTEGER AS ranking FROM act GROUP BY 1, 2")
_add("q_technology_share", kpi.technology_share, "nombre_tecnologia categoria_tecnologia nombre_agente cantidad_menciones", f"SELECT nombre_tecnologia, categoria_tecnologia, {_N}, count(DISTINCT nombre_agente)::BIGINT AS agentes, {_M}, {_SHARE} AS porcentaje FROM act GROUP BY 1, 2")

_add("rep_adoption_filtered", lambda a: reports.adoption(a, SCOPED), "fecha_evento nombre_agente nombre_fuente cantidad_menciones score_adopcion", f"SELECT nombre_agente, {_N}, {_M}, {_mean('score_adopcion', 'promedio_adopcion')} FROM act WHERE {_W2} GROUP BY 1")
_add("rep_share", lambda a: reports.source_share(a, YEARS), "fecha_evento nombre_agente nombre_fuente", f"SELECT nombre_fuente, {_N}, {_SHARE} AS porcentaje FROM act WHERE {_W1} GROUP BY 1")
_add("rep_trend_mode", lambda a: reports.trend_with_mode(a, YEARS), "fecha_evento nombre_agente nombre_fuente cantidad_interacciones", f"+ c AS (SELECT year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, nombre_fuente, count(*) AS n, sum(cantidad_interacciones) AS i FROM act WHERE {_W1} GROUP BY 1, 2, 3) SELECT anio, mes, sum(n)::BIGINT AS total_observaciones, sum(i)::BIGINT AS total_interacciones, (list(nombre_fuente ORDER BY n DESC, nombre_fuente))[1] AS fuente_predominante FROM c GROUP BY 1, 2")
_add("rep_agent_month", lambda a: reports.agent_months(a, YEARS), "fecha_evento nombre_agente score_actividad", f"SELECT nombre_agente, year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, {_N}, {_sum('score_actividad', 'score_actividad_total')} FROM act WHERE {_W1} GROUP BY 1, 2, 3")
_add("rep_ranking_page", lambda a: reports.ranking_page(a, YEARS, "score_adopcion_total", True, 10, 5), "fecha_evento nombre_agente cantidad_menciones score_adopcion score_actividad nombre_fuente", f"+ s AS (SELECT nombre_agente, {_N}, {_M}, {_sum('score_adopcion', 'score_adopcion_total')}, {_sum('score_actividad', 'score_actividad_total')}, count(DISTINCT nombre_fuente)::BIGINT AS fuentes, count(DISTINCT strftime(fecha_evento, '%Y-%m'))::BIGINT AS meses FROM act WHERE {_W1} GROUP BY 1) SELECT *, rank() OVER (ORDER BY score_adopcion_total DESC)::INTEGER AS ranking FROM s ORDER BY ranking, nombre_agente LIMIT 10 OFFSET 5")
_add("rep_matrix", lambda a: reports.coverage_matrix(a, YEARS), "fecha_evento nombre_agente nombre_fuente", f"SELECT nombre_agente, nombre_fuente, {_N} FROM act WHERE {_W1} GROUP BY 1, 2")
_add("rep_matrix_pivot", lambda a: reports.coverage_matrix_wide(a, YEARS, PRIORITIES), "fecha_evento nombre_agente nombre_fuente", "SELECT nombre_agente, " + ", ".join(f"count(*) FILTER (nombre_fuente = '{p}')::BIGINT AS s{i + 1}" for i, p in enumerate(PRIORITIES)) + f" FROM act WHERE {_W1} GROUP BY 1")
_add("rep_popularity_top20", lambda a: reports.popularity_top(a, YEARS, OPEN_SOURCES, OPEN_PLATFORMS), "fecha_evento nombre_agente nombre_fuente nombre_plataforma score_actividad", f"SELECT nombre_agente, nombre_plataforma, {_N}, {_sum('score_actividad', 'score_actividad_total')} FROM act WHERE {_W1} AND {_OPEN} GROUP BY 1, 2 ORDER BY score_actividad_total DESC, nombre_agente, nombre_plataforma LIMIT 20")
_add("rep_growth", lambda a: reports.growth(a, YEARS), "fecha_evento nombre_agente", f"+ m AS (SELECT year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, {_N} FROM act WHERE {_W1} GROUP BY 1, 2) SELECT anio, mes, total_observaciones, total_observaciones - coalesce(lag(total_observaciones) OVER w, 0) AS variacion_absoluta, {_PCT} AS variacion_porcentual FROM m WINDOW w AS (ORDER BY anio, mes)")
_add("rep_distribution", lambda a: reports.distribution(a, YEARS), "fecha_evento nombre_agente nombre_plataforma cantidad_menciones", f"SELECT nombre_plataforma, {_N}, {_M}, {_SHARE} AS porcentaje FROM act WHERE {_W1} GROUP BY 1")
_add("rep_category", lambda a: reports.by_category(a, YEARS), "fecha_evento nombre_agente categoria_agente score_adopcion", f"SELECT categoria_agente, {_N}, count(DISTINCT nombre_agente)::BIGINT AS agentes, {_mean('score_adopcion', 'promedio_adopcion')} FROM act WHERE {_W1} GROUP BY 1")
_add("rep_domain", lambda a: reports.by_domain(a, YEARS), "fecha_evento nombre_agente categoria_tecnologia score_adopcion", f"SELECT categoria_tecnologia, {_N}, {_mean('score_adopcion', 'promedio_adopcion')} FROM act WHERE {_W1} GROUP BY 1")
_add("rep_options", lambda a: reports.options(a, YEARS), "fecha_evento nombre_agente categoria_agente nombre_plataforma nombre_tecnologia", f"SELECT DISTINCT 'categoria' AS option, categoria_agente AS value FROM act WHERE {_W1} UNION SELECT DISTINCT 'plataforma', nombre_plataforma FROM act WHERE {_W1} UNION SELECT DISTINCT 'tecnologia', nombre_tecnologia FROM act WHERE {_W1}")

_add("der_trend_ma", derived.trend, "fecha_evento cantidad_menciones cantidad_interacciones score_actividad score_popularidad score_adopcion", f"{_MONTH} SELECT anio, mes, total_observaciones, round(avg(total_observaciones::DOUBLE) OVER (ORDER BY anio, mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS media_movil, {_PCT} AS variacion_porcentual FROM m WINDOW w AS (ORDER BY anio, mes)")
_add("der_leader", derived.leader, "nombre_agente cantidad_interacciones", f"+ s AS (SELECT nombre_agente, count(*) AS n, sum(cantidad_interacciones) AS i, row_number() OVER (ORDER BY count(*) DESC, nombre_agente) AS r FROM act GROUP BY 1) SELECT max(nombre_agente) FILTER (r = 1) AS lider, max(nombre_agente) FILTER (r = 2) AS segundo, round((max(n) FILTER (r = 1) - max(n) FILTER (r = 2)) * 100.0 / max(n) FILTER (r = 2), 2)::DOUBLE AS brecha_pct, (list(nombre_agente ORDER BY i / n DESC, nombre_agente DESC))[1] AS lider_intensidad FROM s")
_add("der_quadrants", lambda a: derived.quadrants(derived.agent_points(a)), "nombre_agente score_adopcion score_popularidad", "+ p AS (SELECT nombre_agente, round(sum(score_adopcion)::DOUBLE, 4) AS adopcion, round(sum(score_popularidad)::DOUBLE, 4) AS popularidad, count(*)::DOUBLE AS v FROM act GROUP BY 1), k AS (SELECT median(adopcion) AS mx, median(popularidad) AS my FROM p) SELECT nombre_agente, adopcion, popularidad, CASE WHEN adopcion >= mx AND popularidad >= my THEN 'lideres' WHEN popularidad >= my THEN 'populares' WHEN adopcion >= mx THEN 'adoptados' ELSE 'emergentes' END AS cuadrante, round(log10(1 + adopcion), 6) AS x_log, round(log10(1 + popularidad), 6) AS y_log, round(ln(1 + v), 6) AS volumen_log, row_number() OVER (ORDER BY adopcion DESC, nombre_agente)::INTEGER AS marcador FROM p, k")
_add("der_heatmap", derived.heat_map, "nombre_agente fecha_evento", f"+ c AS (SELECT nombre_agente, year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, {_N} FROM act GROUP BY 1, 2, 3), r AS (SELECT *, dense_rank() OVER (ORDER BY anio DESC, mes DESC) AS d FROM c), l AS (SELECT * EXCLUDE (d) FROM r WHERE d <= 18) SELECT *, (sum(total_observaciones) OVER (PARTITION BY nombre_agente))::BIGINT AS total_agente, max(total_observaciones) OVER (PARTITION BY nombre_agente) AS maximo_agente, max(total_observaciones) OVER () AS maximo_global FROM l")
_add("der_others", derived.category_others, "categoria_agente", f"+ s AS (SELECT categoria_agente, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, categoria_agente) AS r FROM act GROUP BY 1), o AS (SELECT CASE WHEN r > 6 THEN 'Otros' ELSE categoria_agente END AS categoria_agente, sum(n)::BIGINT AS total_observaciones FROM s GROUP BY 1) SELECT *, round(total_observaciones * 100.0 / sum(total_observaciones) OVER (), 2)::DOUBLE AS porcentaje FROM o")
_add("der_top_variations", derived.top_variations, "fecha_evento cantidad_menciones cantidad_interacciones score_actividad score_popularidad score_adopcion", f"{_MONTH}, p AS (SELECT anio, mes, {_PCT} AS variacion_porcentual FROM m WINDOW w AS (ORDER BY anio, mes)) SELECT * FROM p WHERE variacion_porcentual IS NOT NULL ORDER BY abs(variacion_porcentual) DESC, anio, mes LIMIT 3")
_add("der_insights", derived.insights, "fecha_evento cantidad_menciones cantidad_interacciones score_actividad score_popularidad score_adopcion nombre_fuente nombre_agente", f"{_MONTH} SELECT (SELECT anio || '-' || lpad(mes::VARCHAR, 2, '0') FROM m ORDER BY total_observaciones DESC, anio DESC, mes DESC LIMIT 1) AS mes_pico, (SELECT nombre_fuente FROM act GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS fuente_principal, (SELECT nombre_agente FROM act GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS agente_principal")
_add("der_last_complete_month", lambda a: derived.last_complete_month(a, "2001-07-20"), "fecha_evento cantidad_menciones cantidad_interacciones score_actividad score_popularidad score_adopcion", f"{_MONTH} SELECT anio, mes, total_observaciones FROM m WHERE NOT (anio = 2001 AND mes >= 7) AND anio <= 2001 ORDER BY anio DESC, mes DESC LIMIT 1")
_add("der_totals", derived.totals, "score_adopcion cantidad_menciones", f"SELECT {_N}, {_sum('score_adopcion', 'adopcion_total')}, {_M} FROM act")
_add("der_hhi", lambda a: concentration(a, "nombre_fuente"), "nombre_fuente", "+ s AS (SELECT nombre_fuente, count(*) AS n FROM act GROUP BY 1) SELECT round(sum(power(n::DOUBLE / t, 2)), 6) AS hhi FROM s, (SELECT sum(n)::DOUBLE AS t FROM s)")
_MONTHS = "['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre', 'Noviembre', 'Diciembre']"
_add(
    "q_monthly_lag",
    lambda a: kpi.monthly_adoption(a, 1996, 1999),
    "fecha_evento cantidad_menciones cantidad_interacciones score_adopcion",
    f"""+ m AS (SELECT year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, {_N}, {_M}, {_I}, {_mean('score_adopcion', 'promedio_score_adopcion')}, sum(score_adopcion) AS s FROM act WHERE year(fecha_evento) BETWEEN 1996 AND 1999 GROUP BY 1, 2)
SELECT * EXCLUDE (s), {_MONTHS}[mes] AS nombre_mes, round(s::DOUBLE, 4) AS score_adopcion_total, round((lag(s) OVER w)::DOUBLE, 4) AS score_adopcion_mes_anterior, round((s - coalesce(lag(s) OVER w, 0))::DOUBLE, 4) AS variacion_absoluta_adopcion,
  round((s - lag(s) OVER w)::DOUBLE * 100.0 / nullif((lag(s) OVER w)::DOUBLE, 0), 2) AS variacion_porcentual_adopcion FROM m WINDOW w AS (ORDER BY anio, mes)""",
)
_add("rep_trend_without_type", lambda a: reports.trend_with_mode(a, Filters(without_type="O")), "fecha_evento nombre_fuente tipo_fuente cantidad_interacciones", "+ c AS (SELECT year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, nombre_fuente, count(*) AS n, sum(cantidad_interacciones) AS i FROM act WHERE tipo_fuente <> 'O' GROUP BY 1, 2, 3) SELECT anio, mes, sum(n)::BIGINT AS total_observaciones, sum(i)::BIGINT AS total_interacciones, (list(nombre_fuente ORDER BY n DESC, nombre_fuente))[1] AS fuente_predominante FROM c GROUP BY 1, 2")
_add(
    "der_executive",
    derived.executive,
    "fecha_evento nombre_agente score_adopcion",
    """+ s AS (SELECT nombre_agente, sum(score_adopcion)::DOUBLE AS a, count(*) AS n FROM act GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY a DESC, nombre_agente) AS k FROM s),
m AS (SELECT year(fecha_evento) AS y, month(fecha_evento) AS m, sum(score_adopcion)::DOUBLE AS a FROM act GROUP BY 1, 2), l AS (SELECT *, lag(a) OVER (ORDER BY y, m) AS p FROM m)
SELECT max(nombre_agente) FILTER (k = 1) AS lider, max(nombre_agente) FILTER (k = 2) AS segundo, round((max(a) FILTER (k = 1) - max(a) FILTER (k = 2)) * 100.0 / greatest(max(a) FILTER (k = 2), 1), 2) AS brecha_pct,
  (list(nombre_agente ORDER BY a / n DESC, nombre_agente DESC))[1] AS lider_intensidad, (SELECT round((a - p) * 100.0 / p, 2) FROM l ORDER BY y DESC, m DESC LIMIT 1) AS crecimiento_mensual_pct FROM r""",
)
_add("der_top_sources", lambda a: derived.top_sources(a, 7, "P"), "nombre_fuente tipo_fuente", f"SELECT nombre_fuente, {_N}, {_SHARE} AS participacion FROM act WHERE tipo_fuente <> 'P' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7")
_add("der_top_popularity", derived.top_popularity, "nombre_agente score_popularidad", f"SELECT nombre_agente, {_sum('score_popularidad', 'popularidad')} FROM act GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
_add(
    "der_heatmap_top20",
    derived.heat_map_top,
    "nombre_agente fecha_evento score_adopcion",
    """+ c AS (SELECT nombre_agente, year(fecha_evento)::INTEGER AS anio, month(fecha_evento)::INTEGER AS mes, sum(score_adopcion) AS a FROM act GROUP BY 1, 2, 3), r AS (SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY anio DESC, mes DESC) AS d FROM c) WHERE d <= 18)
SELECT nombre_agente, anio, mes, round(a::DOUBLE, 4) AS adopcion FROM r WHERE nombre_agente IN (SELECT nombre_agente FROM r GROUP BY 1 ORDER BY sum(a) DESC, 1 LIMIT 20)""",
)


def _points(spark, sf_dir):
    """Customers as points; a balance below 0 is no valid score."""
    return read(spark, sf_dir, "customer").select(F.col("c_name").alias("nombre_agente"), F.col("c_acctbal").cast("string").alias("adopcion"), (F.col("c_acctbal") + 500).alias("popularidad"))


QUERIES["der_omitted"] = lambda spark, sf_dir: derived.omitted(_points(spark, sf_dir))
ORACLES["der_omitted"] = "SELECT (count(*) FILTER (c_acctbal < 0))::BIGINT AS omitidos FROM customer"
