"""Keys, upserts, dimensions, facts and the pull-request catalog over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.operators import keys, measures
from veleta.plans import catalog, gold, governance
from veleta.plans.activity import SQL as ACT
from veleta.plans.activity import activity, read

QUERIES, ORACLES = {}, {}


def _add(name: str, query, sql: str) -> None:
    QUERIES[name], ORACLES[name] = query, sql


_add(
    "snapshot_dedup",
    lambda spark, sf_dir: keys.snapshot_dedup(read(spark, sf_dir, "events"), ["event_type", "user_id"], ["ts", "event_id"]).select("event_type", "user_id", "event_id", "value"),
    "SELECT event_type, user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1",
)
_add(
    "snapshot_by_aggregate",
    lambda spark, sf_dir: keys.newest_by_aggregate(read(spark, sf_dir, "events"), ["event_type", "user_id"], ["ts", "event_id"], ["value"]).drop("ts"),
    "SELECT event_type, user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1",
)


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = read(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "ts", "value")
    newest = lambda d: keys.latest_per_key(d, ["event_type", "user_id"], [F.desc("ts"), F.desc("event_id")])
    return newest(e.filter("event_id % 2 = 0")), newest(e.filter("event_id % 2 = 1"))


_add(
    "upsert_newest",
    lambda spark, sf_dir: keys.upsert_newest(*_halves(spark, sf_dir), ["event_type", "user_id"], ["ts", "event_id"]).drop("ts"),
    "SELECT event_type, user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1",
)
_add(
    "ledger_pending",
    lambda spark, sf_dir: keys.pending(
        read(spark, sf_dir, "documents").select("source").distinct(), read(spark, sf_dir, "documents").filter("source < 'src2'").select("source", F.lit("v1").alias("version")).distinct(), "source", "version", "v1"
    ),
    "SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE source < 'src2')",
)
_add(
    "idempotence_ratio",
    lambda spark, sf_dir: measures.idempotence_ratio(read(spark, sf_dir, "events"), ["event_type", "user_id"]),
    "SELECT round(count(*)::DOUBLE / count(DISTINCT (event_type, user_id)), 6) AS f FROM events",
)
_add(
    "dim_time",
    lambda spark, sf_dir: gold.time_dimension(activity(spark, sf_dir, ["fecha_evento"]), "fecha_evento"),
    f"""WITH {ACT}, d AS (SELECT DISTINCT fecha_evento AS fecha FROM act)
SELECT fecha, year(fecha)::INTEGER AS anio, CASE WHEN month(fecha) <= 6 THEN 1 ELSE 2 END AS semestre, quarter(fecha)::INTEGER AS trimestre, month(fecha)::INTEGER AS mes,
  ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'][month(fecha)] AS nombre_mes,
  weekofyear(fecha)::INTEGER AS semana, day(fecha)::INTEGER AS dia, isodow(fecha)::INTEGER AS dia_semana,
  ['Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado', 'Domingo'][isodow(fecha)] AS nombre_dia, isodow(fecha) >= 6 AS es_fin_semana FROM d""",
)
_add("dim_agent", lambda spark, sf_dir: gold.consolidated(activity(spark, sf_dir, ["nombre_agente", "categoria_agente"]), "nombre_agente", "categoria_agente"), f"WITH {ACT} SELECT nombre_agente, min(categoria_agente) AS categoria_agente FROM act GROUP BY 1")
_add(
    "dim_latest_attrs",
    lambda spark, sf_dir: gold.latest_attributes(activity(spark, sf_dir, ["nombre_comunidad", "nombre_plataforma", "tipo_plataforma", "fecha_evento", "id_origen_registro"]), ["nombre_comunidad"], ["nombre_plataforma", "tipo_plataforma"], ["fecha_evento", "id_origen_registro"]),
    f"WITH {ACT} SELECT nombre_comunidad, nombre_plataforma, tipo_plataforma FROM act QUALIFY row_number() OVER (PARTITION BY nombre_comunidad ORDER BY fecha_evento DESC, id_origen_registro DESC) = 1",
)


def _dims(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Old and new customers as a dimension, by their balance; some are both."""
    c = read(spark, sf_dir, "customer")
    old = c.filter("c_acctbal < 6000").select(F.col("c_name").alias("nombre"), F.col("c_mktsegment").alias("segmento"), F.col("c_custkey").alias("id"))
    new = c.filter("c_acctbal > 2000").select(F.col("c_name").alias("nombre"), F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("segmento"))
    return old, new


_add(
    "dim_upsert",
    lambda spark, sf_dir: (lambda old, new: keys.with_surrogate_keys(new, old, ["nombre"], "id"))(*_dims(spark, sf_dir)),
    """WITH o AS (SELECT c_name AS nombre, c_mktsegment AS segmento, c_custkey AS id FROM customer WHERE c_acctbal < 6000),
n AS (SELECT c_name AS nombre, c_mktsegment || '-' || c_nationkey AS segmento FROM customer WHERE c_acctbal > 2000),
j AS (SELECT coalesce(n.nombre, o.nombre) AS nombre, coalesce(n.segmento, o.segmento) AS segmento, o.id FROM n FULL JOIN o ON n.nombre = o.nombre)
SELECT nombre, segmento, coalesce(id, (SELECT max(id) FROM o) + row_number() OVER (PARTITION BY id IS NULL ORDER BY nombre))::BIGINT AS id FROM j""",
)
_add(
    "fact_derive",
    lambda spark, sf_dir: _observations(spark, sf_dir).transform(gold.fact_scores).select(
        "id_origen_registro", "cantidad_menciones", "score_popularidad", "score_actividad", "score_comunidad", "score_adopcion", "valor_numerico_normalizado",
        gold.lineage(F.col("raw_record_id"), [F.col("fuente"), F.col("id_origen_registro")]).alias("fact_lineage_key"),
    ),
    """SELECT event_id::VARCHAR AS id_origen_registro, user_id AS cantidad_menciones, CAST(coalesce(CASE WHEN value > 10 THEN value END, 0) AS DECIMAL(12,4)) AS score_popularidad,
  CAST(event_id % 5 + event_id % 11 AS DECIMAL(12,4)) AS score_actividad, CAST(CASE WHEN event_type = 'devto' OR event_id % 4 = 0 THEN user_id + event_id % 5 ELSE 0 END AS DECIMAL(12,4)) AS score_comunidad,
  CAST(coalesce(CASE WHEN event_id % 3 = 0 THEN value * 2 END, 0) AS DECIMAL(12,4)) AS score_adopcion,
  CAST(coalesce(CAST(CASE WHEN value > 10 THEN value END AS DECIMAL(18,6)), CAST(CASE WHEN event_id % 3 = 0 THEN value * 2 END AS DECIMAL(18,6)), CAST(event_id % 5 AS DECIMAL(18,6))) AS DECIMAL(12,6)) AS valor_numerico_normalizado,
  CASE WHEN event_id % 2 = 0 THEN 'raw:' || event_id ELSE 'legacy:' || md5(event_type || chr(31) || event_id) END AS fact_lineage_key FROM events""",
)


def _observations(spark, sf_dir) -> DataFrame:
    e, i = read(spark, sf_dir, "events"), F.col("event_id")
    return e.select(
        i.cast("string").alias("id_origen_registro"),
        F.col("event_type").alias("fuente"),
        F.when(i % 4 == 0, "comunidad").alias("categoria"),
        F.when(i % 2 == 0, i).alias("raw_record_id"),
        F.col("user_id").alias("cantidad_menciones"),
        (i % 5).alias("cantidad_interacciones"),
        (i % 11).alias("stars_github"),
        F.lit(None).cast("long").alias("forks_github"),
        F.lit(None).cast("long").alias("issues_abiertos"),
        F.lit(0).cast("long").alias("releases"),
        F.when(F.col("value") > 10, F.col("value")).alias("score_popularidad"),
        F.when(i % 3 == 0, F.col("value") * 2).alias("indice_adopcion"),
        F.lit(None).cast("double").alias("indice_innovacion"),
    )


def _facts(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    old = o.filter("o_orderdate < timestamp'1999-01-01'").select(F.col("o_orderkey").alias("id_hecho"), F.col("o_orderkey").cast("string").alias("grano"), F.concat(F.lit("raw:"), "o_orderkey").alias("linaje"), F.col("o_totalprice").alias("medida"))
    new = o.filter("o_orderdate >= timestamp'1997-01-01'").select(F.col("o_orderkey").cast("string").alias("grano"), F.concat(F.lit("new:"), "o_orderkey").alias("linaje"), (F.col("o_totalprice") * 2).alias("medida"))
    return keys.upsert_fact(new, old, ["grano"], "id_hecho", "linaje")


_add(
    "fact_upsert",
    _facts,
    """WITH o AS (SELECT o_orderkey AS id, o_orderkey::VARCHAR AS g, 'raw:' || o_orderkey AS l, o_totalprice AS m FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
n AS (SELECT o_orderkey::VARCHAR AS g, 'new:' || o_orderkey AS l, o_totalprice * 2 AS m FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
j AS (SELECT o.id, coalesce(n.g, o.g) AS grano, coalesce(o.l, n.l) AS linaje, coalesce(n.m, o.m) AS medida FROM n FULL JOIN o ON n.g = o.g)
SELECT coalesce(id, (SELECT max(id) FROM o) + row_number() OVER (PARTITION BY id IS NULL ORDER BY grano))::BIGINT AS id_hecho, grano, linaje, medida FROM j""",
)
_add(
    "fk_check",
    lambda spark, sf_dir: gold.orphans(read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), read(spark, sf_dir, "customer").filter("c_acctbal > 0"), "c_custkey").agg(F.count(F.lit(1)).alias("huerfanos")),
    "SELECT count(*)::BIGINT AS huerfanos FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
_add(
    "retire_source",
    lambda spark, sf_dir: keys.retire(read(spark, sf_dir, "events"), "event_type", "click").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
    "SELECT event_type, count(*)::BIGINT AS n FROM events WHERE event_type <> 'click' GROUP BY 1",
)
_add(
    "retire_orphans",
    lambda spark, sf_dir: keys.without_orphans(read(spark, sf_dir, "events").select("user_id").distinct(), keys.retire(read(spark, sf_dir, "events"), "event_type", "click").filter("value > 50"), "user_id"),
    "SELECT DISTINCT user_id FROM events WHERE event_type <> 'click' AND value > 50",
)
_add(
    "backfill_run",
    lambda spark, sf_dir: governance.backfilled(read(spark, sf_dir, "events").select(F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("run-"), F.col("event_id") % 3)).alias("run_id"))).groupBy("run_id").agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE WHEN event_id % 3 > 0 THEN 'run-' || (event_id % 3) ELSE 'legacy' END AS run_id, count(*)::BIGINT AS n FROM events GROUP BY 1",
)


def _consolidated(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    new = c.filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre"), F.lit("nuevo").alias("origen"))
    old = c.filter("c_acctbal < 5000").select(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("id"), F.upper("c_name").alias("nombre"))
    return keys.consolidate(new, old, "id")


_add(
    "consolidate",
    _consolidated,
    """SELECT c_custkey AS id, c_name AS nombre, 'nuevo' AS origen FROM customer WHERE c_acctbal > 0
UNION ALL SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END, upper(c_name), NULL FROM customer WHERE c_acctbal < 5000 AND (c_mktsegment = 'BUILDING' OR c_acctbal <= 0)""",
)
_add(
    "key_report",
    lambda spark, sf_dir: keys.key_report(_consolidated(spark, sf_dir), "id"),
    "WITH c AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0 UNION ALL SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END FROM customer WHERE c_acctbal < 5000 AND (c_mktsegment = 'BUILDING' OR c_acctbal <= 0)) SELECT count(*)::BIGINT AS n_rows, count(DISTINCT id)::BIGINT AS n_keys, (count(*) FILTER (id IS NULL))::BIGINT AS null_keys FROM c",
)



def _staging(spark, sf_dir, part: int = 0, parts: int = 1) -> DataFrame:
    """Line items as staging rows; Asia has no name of its own as a platform, so its rows are under the default member.

    One of several parts holds the line items of some orders.
    """
    t = lambda n: read(spark, sf_dir, n)
    of = lambda n, key: t(n) if parts == 1 else t(n).filter(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
    # orders get their customers first, so that line items, which are many, are shuffled by part and by order only
    orders = (
        of("orders", "o_orderkey").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    joined = of("lineitem", "l_orderkey").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    null = lambda kind: F.lit(None).cast(kind)
    return joined.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id_origen_registro"),
        F.to_date("o_orderdate").alias("fecha_evento"),
        F.col("p_brand").alias("nombre_agente"), F.col("p_type").alias("categoria"), F.col("o_orderpriority").alias("fuente"), F.col("o_orderstatus").alias("tipo_fuente"), F.col("r_name").alias("plataforma"),
        F.col("o_orderkey").alias("raw_file_id"), (F.col("l_linenumber").cast("long") * 10**12 + F.col("l_partkey") * 10**6 + F.col("l_suppkey")).alias("raw_record_id"),
        F.when(F.col("r_name") == "ASIA", " ").otherwise(F.col("r_name")).alias("dim_nombre_plataforma"), F.col("n_name").alias("dim_tipo_plataforma"), F.col("c_mktsegment").alias("dim_ecosistema"),
        F.col("l_returnflag").alias("dim_nombre_tecnologia"), F.col("l_linestatus").alias("dim_categoria_tecnologia"), F.col("p_type").alias("dim_dominio_tecnologico"), F.col("o_orderpriority").alias("dim_tipo_senal"),
        F.col("c_mktsegment").alias("dim_nombre_comunidad"), F.col("n_name").alias("dim_tipo_comunidad"), F.col("o_orderpriority").alias("dim_region_comunidad"),
        F.col("l_linenumber").cast("long").alias("cantidad_menciones"), F.col("l_quantity").cast("long").alias("cantidad_interacciones"), null("long").alias("stars_github"), null("long").alias("forks_github"),
        F.col("p_size").cast("long").alias("issues_abiertos"), null("long").alias("releases"), (F.col("l_discount") * 100).alias("score_popularidad"), null("double").alias("indice_adopcion"), null("double").alias("indice_innovacion"),
        null("double").alias("sentimiento_promedio"), null("string").alias("titulo"), null("string").alias("url"), F.lit(False).alias("is_imputed_date"),
    )


def _staging_parts(spark, sf_dir) -> list[DataFrame]:
    n = keys.slices_of(read(spark, sf_dir, "lineitem").count())
    return [_staging(spark, sf_dir, i, n) for i in range(n)]


_STAGING = """s AS (SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id_origen_registro, o_orderdate::DATE AS fecha, p_brand AS agente, o_orderpriority AS fuente, o_orderstatus AS tipo, l_orderkey AS file, l_linenumber::BIGINT * 1000000000000 + l_partkey * 1000000 + l_suppkey AS record,
  coalesce(nullif(CASE WHEN r_name = 'ASIA' THEN '' ELSE r_name END, ''), 'No determinada') AS plat, n_name, c_mktsegment, l_returnflag, l_linestatus, p_type, p_size, l_linenumber::BIGINT AS m, l_quantity::BIGINT AS i, l_discount * 100 AS pop
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dp AS (SELECT plat AS nombre_plataforma, n_name AS tipo_plataforma, c_mktsegment AS ecosistema FROM s QUALIFY row_number() OVER (PARTITION BY plat ORDER BY fecha DESC, file DESC, record DESC) = 1),
dx AS (SELECT l_returnflag AS nombre_tecnologia, l_linestatus AS categoria_tecnologia, p_type AS dominio_tecnologico, fuente AS tipo_senal FROM s QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY fecha DESC, file DESC, record DESC) = 1),
dc AS (SELECT c_mktsegment AS nombre_comunidad, n_name AS tipo_comunidad, plat AS plataforma_comunidad, fuente AS region FROM s QUALIFY row_number() OVER (PARTITION BY c_mktsegment, n_name, plat ORDER BY fecha DESC, file DESC, record DESC) = 1)"""
_add("dim_source", lambda spark, sf_dir: gold.source_dimension(_staging(spark, sf_dir)), f"WITH {_STAGING} SELECT DISTINCT fuente AS nombre_fuente, tipo AS tipo_fuente, tipo AS categoria_fuente, 'No especificado' AS confiabilidad_fuente FROM s")
_add("dim_platform", lambda spark, sf_dir: gold.platform_dimension(_staging(spark, sf_dir)), f"WITH {_STAGING} SELECT * FROM dp")
_add("dim_technology", lambda spark, sf_dir: gold.technology_dimension(_staging(spark, sf_dir)), f"WITH {_STAGING} SELECT * FROM dx")
_add("dim_community", lambda spark, sf_dir: gold.community_dimension(_staging(spark, sf_dir)), f"WITH {_STAGING} SELECT * FROM dc")
_add(
    "dim_agent_full",
    lambda spark, sf_dir: gold.agent_dimension(_staging(spark, sf_dir), "nombre_agente"),
    f"WITH {_STAGING} SELECT DISTINCT agente AS nombre_agente, 'No especificado' AS categoria_agente, 'No especificado' AS tipo_agente, 'No especificado' AS proveedor, 'No especificado' AS caracteristica_clave, 'No especificado' AS modelo_precios, true AS es_agente_identificado FROM s",
)
_add(
    "gold_load",
    lambda spark, sf_dir: gold.load(_staging_parts(spark, sf_dir))[1].select("id_hecho", *[k for _, k in gold.DIMENSIONS.values()], "id_origen_registro", "fact_lineage_key", "cantidad_interacciones", "score_popularidad", "score_actividad", "valor_numerico_normalizado"),
    f"""WITH {_STAGING}, t AS (SELECT fecha, row_number() OVER (ORDER BY fecha) AS id FROM (SELECT DISTINCT fecha FROM s)), a AS (SELECT agente, row_number() OVER (ORDER BY agente) AS id FROM (SELECT DISTINCT agente FROM s)),
f AS (SELECT fuente, tipo, row_number() OVER (ORDER BY fuente, tipo) AS id FROM (SELECT DISTINCT fuente, tipo FROM s)), p AS (SELECT nombre_plataforma AS plat, row_number() OVER (ORDER BY nombre_plataforma) AS id FROM dp),
x AS (SELECT nombre_tecnologia AS l_returnflag, categoria_tecnologia AS l_linestatus, row_number() OVER (ORDER BY nombre_tecnologia, categoria_tecnologia) AS id FROM dx),
c AS (SELECT nombre_comunidad AS c_mktsegment, tipo_comunidad AS n_name, plataforma_comunidad AS plat, row_number() OVER (ORDER BY nombre_comunidad, tipo_comunidad, plataforma_comunidad) AS id FROM dc)
SELECT row_number() OVER (ORDER BY a.id, f.id, p.id, id_origen_registro)::BIGINT AS id_hecho, t.id::BIGINT AS id_tiempo, a.id::BIGINT AS id_agente, f.id::BIGINT AS id_fuente, p.id::BIGINT AS id_plataforma, x.id::BIGINT AS id_tecnologia, c.id::BIGINT AS id_comunidad,
  id_origen_registro, 'raw:' || record AS fact_lineage_key, i AS cantidad_interacciones, pop::DECIMAL(12,4) AS score_popularidad, (i + p_size)::DECIMAL(12,4) AS score_actividad, pop::DECIMAL(18,6)::DECIMAL(12,6) AS valor_numerico_normalizado
FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY agente, fuente, tipo, plat, id_origen_registro ORDER BY fecha DESC, file DESC, record DESC, l_returnflag DESC, l_linestatus DESC, i DESC, pop DESC) = 1) s JOIN t USING (fecha) JOIN a USING (agente) JOIN f USING (fuente, tipo) JOIN p USING (plat) JOIN x USING (l_returnflag, l_linestatus) JOIN c USING (c_mktsegment, n_name, plat)""",
)
_SOURCES = ("catalogo", "github", "hackernews")


def _profiles(spark, sf_dir) -> DataFrame:
    source = F.when(F.col("lang") == "en", "github").when(F.col("lang") == "fr", "hackernews").when(F.col("lang") == "de", "catalogo").otherwise("reddit")
    rows = read(spark, sf_dir, "documents").select(source.alias("fuente"))
    kept = F.array_compact(F.array(*[F.when(gold.in_profile(F.col("fuente"), _SOURCES, p), F.lit(p)) for p in ("all", "main", "catalogo")]))
    return rows.select("fuente", F.explode(kept).alias("perfil")).groupBy("perfil", "fuente").agg(F.count(F.lit(1)).alias("n"))


_add(
    "profile_rows",
    _profiles,
    """WITH d AS (SELECT CASE lang WHEN 'en' THEN 'github' WHEN 'fr' THEN 'hackernews' WHEN 'de' THEN 'catalogo' ELSE 'reddit' END AS fuente FROM documents), a AS (SELECT * FROM d WHERE fuente <> 'reddit')
SELECT 'all' AS perfil, fuente, count(*)::BIGINT AS n FROM a GROUP BY 2 UNION ALL SELECT 'main', fuente, count(*) FROM a WHERE fuente <> 'github' GROUP BY 2 UNION ALL SELECT 'catalogo', fuente, count(*) FROM a WHERE fuente = 'catalogo' GROUP BY 2""",
)


def _ledger(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as files, line items as their rows, and a ledger of the orders before 1998."""
    files = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("fuente"), "o_orderdate")
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("raw_file_id"))
    old = files.filter("o_orderdate < timestamp'1998-01-01'").select(F.col("id").alias("file_id"), F.lit("v1").alias("transformation_version"), F.lit("r1").alias("run_id"), F.lit(0).cast("long").alias("records_processed"))
    return files, rows, old


def _written(spark, sf_dir) -> DataFrame:
    files, rows, old = _ledger(spark, sf_dir)
    return keys.ledger_upsert(old, keys.processed_counts(files.filter("o_orderdate >= timestamp'1997-01-01'"), rows, "v2", "r2"))


_LEDGER = "n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), w AS (SELECT o_orderkey AS file_id, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'v2' ELSE 'v1' END AS transformation_version, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'r2' ELSE 'r1' END AS run_id, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN coalesce(n, 0) ELSE 0 END::BIGINT AS records_processed, o_orderpriority FROM orders LEFT JOIN n ON o_orderkey = l_orderkey)"
_add("ledger_write", _written, f"WITH {_LEDGER} SELECT * EXCLUDE (o_orderpriority) FROM w")
_add(
    "ledger_of_sources",
    lambda spark, sf_dir: keys.processed_of(_written(spark, sf_dir), _ledger(spark, sf_dir)[0], ["1-URGENT", "5-LOW"]).groupBy("transformation_version").agg(F.count(F.lit(1)).alias("n"), F.sum("records_processed").alias("registros")),
    f"WITH {_LEDGER} SELECT transformation_version, count(*)::BIGINT AS n, sum(records_processed)::BIGINT AS registros FROM w WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1",
)
_add(
    "query_last_wins",
    lambda spark, sf_dir: keys.last_wins(read(spark, sf_dir, "events").select("event_id", "ts", F.when(F.col("event_type") != "click", F.col("user_id")).alias("id"), F.when(F.col("event_type") == "click", F.col("props")).alias("nombre")), ["id", "nombre"], ["ts", "event_id"]).select("event_id"),
    "SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY coalesce(CASE WHEN event_type <> 'click' THEN user_id::VARCHAR END, CASE WHEN event_type = 'click' THEN props END) ORDER BY ts DESC, event_id DESC) = 1",
)
_add(
    "lost_keys",
    lambda spark, sf_dir: keys.lost_keys(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), [read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))], "id"),
    "SELECT id FROM (SELECT c_custkey AS id FROM customer UNION SELECT s_suppkey FROM supplier) WHERE id NOT IN (SELECT o_custkey FROM orders)",
)

# The catalog: orders stand for pull requests, line items for reviews, parts for repositories, customers for users.
AGENTS = {"1-URGENT": "Urgent", "2-HIGH": "High"}
SUPPORTED = ("Urgent", "High", "3-MEDIUM", "5-LOW")


def _catalog_inputs(spark, sf_dir) -> tuple[DataFrame, ...]:
    t = lambda n: read(spark, sf_dir, n)
    ts = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    repo = F.col("o_custkey") * 2  # some of these are no part: repositories that nobody knows
    prs = t("orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("t"), "o_orderkey").alias("title"),
        F.col("o_orderpriority").alias("agent"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderstatus") == "O", repo).alias("repo_id"),
        F.when(F.month("o_orderdate") < 11, F.concat(F.lit("https://github.com/org/r"), repo)).alias("repo_url"),
        F.concat(F.lit("u"), "o_orderkey").alias("html_url"),
        ts.alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", ts).alias("merged_at"),
    )
    repos = t("part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("https://github.com/org/r"), "p_partkey").alias("url"), F.lit("MIT").alias("license"),
        F.concat(F.lit("org/r"), "p_partkey").alias("full_name"), F.col("p_brand").alias("language"), F.col("p_size").alias("forks"), (F.col("p_size") * 2).alias("stars"),
    )
    reviews = t("lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"), F.col("l_orderkey").alias("pr_id"),
        F.when(F.col("l_returnflag") == "A", "APPROVED").when(F.col("l_returnflag") == "R", "CHANGES_REQUESTED").otherwise("COMMENTED").alias("state"),
        F.when(F.col("l_linestatus") == "O", "User").otherwise("Bot").alias("user_type"),
    )
    tasks = t("orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("k"), F.quarter("o_orderdate")).alias("type"), F.dayofmonth("o_orderdate").cast("double").alias("confidence"))
    users = t("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    return prs, repos, reviews, tasks, users


def _catalog(spark, sf_dir, annual: bool = False) -> tuple[DataFrame, DataFrame]:
    prs, repos, reviews, tasks, users = _catalog_inputs(spark, sf_dir)
    repos = catalog.repositories(repos)
    kept = catalog.pull_requests(prs, repos, AGENTS, SUPPORTED, "1996-01-01", "1999-12-31", annual=annual)
    return kept, catalog.catalog(kept, repos, reviews, tasks, users)


def _final(spark, sf_dir) -> DataFrame:
    rows = catalog.records(_catalog(spark, sf_dir, True)[1], 0, "catalog")
    pairs = F.transform(F.map_entries("task_type_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return rows.withColumn("task_type_counts", F.array_join(pairs, ",")).withColumn("task_confidence_mean", F.round("task_confidence_mean", 6)).drop("dataset", "total_users_dataset")


_PRS = """r AS (SELECT p_partkey AS id, 'https://github.com/org/r' || p_partkey AS url, 'org/r' || p_partkey AS full_name, p_brand AS language, p_size AS forks, p_size * 2 AS stars FROM part),
p0 AS (SELECT o_orderkey AS id, 't' || o_orderkey AS title, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' ELSE o_orderpriority END AS agent, o_custkey AS user_id,
  CASE WHEN o_orderstatus = 'O' THEN o_custkey * 2 END AS rid, CASE WHEN month(o_orderdate) < 11 THEN 'https://github.com/org/r' || (o_custkey * 2) END AS repo_url, 'u' || o_orderkey AS html_url,
  o_orderdate AS created_at, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS merged_at FROM orders),
p1 AS (SELECT p0.*, coalesce(rid, r.id) AS repo_id FROM p0 LEFT JOIN r ON p0.repo_url = r.url WHERE agent IN ('Urgent', 'High', '3-MEDIUM', '5-LOW') AND created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '2000-01-01'),
p AS (SELECT *, coalesce('id:' || repo_id, 'url:' || repo_url, 'pr:' || id){suffix} AS repo_key FROM p1),
v AS (SELECT l_orderkey AS pr_id, count(*) AS review_count, count(*) FILTER (l_linestatus = 'O') AS human, count(*) FILTER (l_linestatus <> 'O') AS bot, count(*) FILTER (l_returnflag = 'A') AS approved, count(*) FILTER (l_returnflag = 'R') AS changes
  FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey ORDER BY CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END, CASE l_linestatus WHEN 'O' THEN 2 ELSE 1 END) = 1) GROUP BY 1),
k AS (SELECT o_orderkey AS id, 'k' || quarter(o_orderdate) AS type, day(o_orderdate)::DOUBLE AS confidence FROM orders WHERE o_orderstatus <> 'P'),
u AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0)"""
_add(
    "cat_prs",
    lambda spark, sf_dir: _catalog(spark, sf_dir)[0].select("id", "agent", "repo_id", "repo_key"),
    f"WITH {_PRS.format(suffix='')} SELECT id, agent, repo_id, repo_key FROM p",
)
_add(
    "cat_reviews",
    lambda spark, sf_dir: catalog.reviews_by_pr(_catalog_inputs(spark, sf_dir)[2]),
    f"WITH {_PRS.format(suffix='')} SELECT pr_id, review_count, human AS human_review_count, bot AS bot_review_count, approved AS approved_review_count, changes AS changes_requested_review_count FROM v",
)
_ISO = "'%Y-%m-%dT%H:%M:%SZ'"
_GROUPED = f"""g AS (SELECT p.agent, repo_key, min(repo_id) AS repo_id, min(repo_url) AS repo_url, count(*)::BIGINT AS pull_requests_count, count(merged_at)::BIGINT AS merged_pull_requests, count(DISTINCT user_id)::BIGINT AS unique_contributors,
  count(DISTINCT u.id)::BIGINT AS known_contributors, strftime(min(created_at), {_ISO}) AS first_activity, strftime(max(created_at), {_ISO}) AS last_activity, arg_min(title, p.id) AS sample_pr_title, arg_min(html_url, p.id) AS sample_pr_url,
  count(v.pr_id)::BIGINT AS reviewed_pull_requests, coalesce(sum(review_count), 0)::BIGINT AS review_count, coalesce(sum(human), 0)::BIGINT AS human_review_count, coalesce(sum(bot), 0)::BIGINT AS bot_review_count,
  coalesce(sum(approved), 0)::BIGINT AS approved_review_count, coalesce(sum(changes), 0)::BIGINT AS changes_requested_review_count, count(k.type)::BIGINT AS task_classified_pull_requests, round(avg(confidence), 6) AS task_confidence_mean
  FROM p LEFT JOIN v ON p.id = v.pr_id LEFT JOIN k ON p.id = k.id LEFT JOIN u ON p.user_id = u.id GROUP BY 1, 2)"""
_add(
    "cat_grouped",
    lambda spark, sf_dir: (lambda i, kept: catalog.grouped(kept, i[2], i[3], i[4]).withColumn("task_confidence_mean", F.round("task_confidence_mean", 6)))(_catalog_inputs(spark, sf_dir), _catalog(spark, sf_dir)[0]),
    f"WITH {_PRS.format(suffix='')}, {_GROUPED} SELECT * FROM g",
)
_add(
    "cat_final",
    _final,
    f"""WITH {_PRS.format(suffix=" || ':year:' || year(created_at)")}, {_GROUPED}, c AS (SELECT agent, repo_key, type, count(*) AS n FROM p JOIN k ON p.id = k.id GROUP BY 1, 2, 3), m AS (SELECT agent, repo_key, string_agg(type || '=' || n, ',' ORDER BY type) AS t FROM c GROUP BY 1, 2)
SELECT g.agent || ':' || g.repo_key AS id, g.* EXCLUDE (repo_key, repo_url, sample_pr_title, sample_pr_url), coalesce(g.repo_url, '') AS repo_url, g.sample_pr_title, g.sample_pr_url,
  year(strptime(g.first_activity, {_ISO}))::INTEGER AS activity_year, round_even(merged_pull_requests / pull_requests_count, 4) AS merge_rate, coalesce(r.url, '') AS repo_api_url,
  coalesce(r.full_name, nullif(regexp_replace(g.repo_url, '^https?://(api\\.)?github\\.com/(repos/)?', ''), ''), g.repo_key) AS full_name, coalesce(r.language, '') AS language, CASE WHEN r.id IS NULL THEN '' ELSE 'MIT' END AS license,
  coalesce(r.stars, 0)::BIGINT AS stars, coalesce(r.forks, 0)::BIGINT AS forks, coalesce(m.t, '') AS task_type_counts
FROM g LEFT JOIN r ON g.repo_id = r.id LEFT JOIN m ON g.agent = m.agent AND g.repo_key = m.repo_key""",
)
_add(
    "cat_stats",
    lambda spark, sf_dir: (lambda i, c: catalog.statistics(*c, i[1], i[4]))(_catalog_inputs(spark, sf_dir), _catalog(spark, sf_dir)),
    f"WITH {_PRS.format(suffix='')}, {_GROUPED} SELECT (SELECT count(*) FROM p)::BIGINT AS pull_request_rows_read, (SELECT count(*) FROM p WHERE repo_id IS NULL)::BIGINT AS unresolved_repository_prs, count(*)::BIGINT AS records_generated, sum(review_count)::BIGINT AS review_rows_linked, sum(task_classified_pull_requests)::BIGINT AS task_rows_linked, (SELECT count(*) FROM r)::BIGINT AS repository_rows_read, (SELECT count(*) FROM u)::BIGINT AS user_rows_read, (SELECT count(DISTINCT id) FROM u)::BIGINT AS unique_users FROM g",
)
_add(
    "cat_inputs",
    lambda spark, sf_dir: catalog.input_counts(**dict(zip(("pull_request", "repository", "review", "task", "user"), _catalog_inputs(spark, sf_dir)))),
    "SELECT (SELECT count(*) FROM orders)::BIGINT AS pull_request_rows_input, (SELECT count(*) FROM part)::BIGINT AS repository_rows_input, (SELECT count(*) FROM lineitem)::BIGINT AS review_rows_input, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')::BIGINT AS task_rows_input, (SELECT count(*) FROM customer WHERE c_acctbal > 0)::BIGINT AS user_rows_input",
)
_add("cat_agents", lambda spark, sf_dir: catalog.agent_counts(_catalog(spark, sf_dir)[0]), f"WITH {_PRS.format(suffix='')} SELECT agent, count(*)::BIGINT AS pull_requests FROM p GROUP BY 1")
