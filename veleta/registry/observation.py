"""Source shaping, cleaning, rules, joins and set operations over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta import contracts
from veleta.functions import cleaning
from veleta.operators import rules, staging
from veleta.operators.measures import first_per_stratum, union_counts
from veleta.plans import gold
from veleta.plans.activity import SQL as ACT
from veleta.plans.activity import activity, read
from veleta.plans.reports import prefer_annual
from veleta.scratch import shared_folder
from veleta.sources import mappers, raw
from veleta.streaming import incremental

QUERIES, ORACLES = {}, {}


def _add(name: str, query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def _events(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events")


_add(
    "props_json",
    lambda spark, sf_dir: _events(spark, sf_dir).select("event_id", F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k")),
    "SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events",
)
_add(
    "hash_id",
    lambda spark, sf_dir: read(spark, sf_dir, "nation").transform(lambda d: d.select("n_nationkey", cleaning.record_hash(d).alias("id"))),
    """SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') AS id FROM nation""",
)


def _wide(spark, sf_dir) -> DataFrame:
    kinds = ["click", "purchase", "view"]
    e = _events(spark, sf_dir).groupBy(F.to_date("ts").alias("date")).pivot("event_type", kinds).agg(F.count(F.lit(1)))
    return e.withColumn("isPartial", F.lit(False))


_add(
    "unpivot_series",
    lambda spark, sf_dir: mappers.interest_over_time(_wide(spark, sf_dir)),
    "SELECT event_type AS agente, CAST(ts AS DATE) AS fecha, count(*)::BIGINT AS valor FROM events WHERE event_type IN ('click', 'purchase', 'view') GROUP BY 1, 2",
)


def _hits(spark, sf_dir) -> DataFrame:
    """First hit within a (type, user) query, then the last query of a user."""
    w = first_per_stratum(_events(spark, sf_dir), ["event_type", "user_id"], [F.asc("ts"), F.asc("event_id")], 1)
    last = first_per_stratum(w, ["user_id"], [F.desc("event_type")], 1)
    return last.select("user_id", "event_type", "event_id")


_add(
    "hit_dedup",
    _hits,
    "WITH f AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1) SELECT user_id, event_type, event_id FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type DESC) = 1",
)
_add(
    "window_filter",
    lambda spark, sf_dir: _events(spark, sf_dir).filter(cleaning.in_window(F.col("ts"), "2024-01-05", "2024-01-11")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
    "SELECT event_type, count(*)::BIGINT AS n FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' GROUP BY 1",
)
_add(
    "date_impute",
    lambda spark, sf_dir: cleaning.dated(
        _events(spark, sf_dir).select(
            "event_id",
            F.when(F.col("event_id") % 4 == 0, "junk").when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd")).alias("fecha_evento_raw"),
            F.when(F.col("event_id") % 5 > 0, F.lit("2024-03-01T01:00:00Z")).alias("fecha_carga_raw"),
        )
    ).select("event_id", "fecha_evento", "is_imputed_date"),
    """SELECT event_id, CASE WHEN event_id % 4 IN (1, 2) THEN CAST(ts AS DATE) ELSE DATE '2024-03-01' END AS fecha_evento, event_id % 4 NOT IN (1, 2) AS is_imputed_date
FROM events WHERE event_id % 4 IN (1, 2) OR event_id % 5 > 0""",
)
_add(
    "year_slices",
    lambda spark, sf_dir: cleaning.year_slices(
        read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("desde"), F.to_date(F.max("o_orderdate")).alias("hasta")), "desde", "hasta"
    ),
    """WITH c AS (SELECT o_custkey, min(o_orderdate)::DATE AS desde, max(o_orderdate)::DATE AS hasta FROM orders GROUP BY 1), y AS (SELECT *, unnest(range(year(desde), year(hasta) + 1)) AS y FROM c)
SELECT o_custkey, desde, hasta, greatest(desde, make_date(y, 1, 1)) AS slice_start, least(hasta, make_date(y, 12, 31)) AS slice_end FROM y""",
)
_add(
    "dirty_number",
    lambda spark, sf_dir: read(spark, sf_dir, "part").select("p_partkey", cleaning.dirty_number(F.concat(F.format_number("p_retailprice", 1), F.element_at(F.array(F.lit("k"), F.lit(" M"), F.lit("")), (F.col("p_partkey") % 3 + 1).cast("int")))).alias("n")),
    "SELECT p_partkey, regexp_replace(replace(replace(lower(replace(replace(printf('%.1f', p_retailprice), '.', ''), ',', '') || ['k', ' m', ''][(p_partkey % 3 + 1)::INTEGER]), 'k', '000'), 'm', '000000'), '[^0-9]', '', 'g')::BIGINT AS n FROM part",
)
_NAMES = (("brand#1", "Uno"), ("brand#2", "Dos"))
_add(
    "name_standard",
    lambda spark, sf_dir: read(spark, sf_dir, "part").select("p_partkey", cleaning.standard_name(F.when(F.col("p_partkey") % 10 > 0, F.concat(F.lit(" "), "p_brand")), _NAMES).alias("nombre")),
    "SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'Desconocido' WHEN contains(lower(p_brand), 'brand#1') THEN 'Uno' WHEN contains(lower(p_brand), 'brand#2') THEN 'Dos' ELSE p_brand END AS nombre FROM part",
)
_add(
    "impute_median",
    lambda spark, sf_dir: cleaning.impute(
        read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal")).alias("saldo"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_mktsegment")).alias("segmento")),
        {"saldo": "median", "segmento": "unknown", "missing": "zero"},
    ),
    "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal END AS saldo, CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment END AS s FROM customer) SELECT c_custkey, coalesce(saldo, (SELECT median(saldo) FROM c)) AS saldo, coalesce(s, 'Desconocido') AS segmento FROM c",
)
_add(
    "index_to_max",
    lambda spark, sf_dir: cleaning.index_to_max(_events(spark, sf_dir).select("event_id", "event_type", F.floor("value").alias("v")), "v", "event_type", "indice").select("event_id", "indice"),
    "SELECT event_id, round_even(floor(value) / max(floor(value)) OVER (PARTITION BY event_type) * 100.0, 2) AS indice FROM events",
)

# Vocabularies of words that occur in the given documents.
_RULES = (("Licencia", "legal", r"\blicensed?\b"), ("Secreto", "seguridad", r"\btoken\b"), ("Correo", "contacto", "@"), ("Comun", "otro", r" (the|der|les) "))
_RULE_SQL = "CASE WHEN regexp_matches({0}, '(?i)\\blicensed?\\b') THEN 'Licencia' WHEN regexp_matches({0}, '(?i)\\btoken\\b') THEN 'Secreto' WHEN regexp_matches({0}, '(?i)@') THEN 'Correo' WHEN regexp_matches({0}, '(?i) (the|der|les) ') THEN 'Comun' END"
_SOURCE_RULES = (("Fuente uno", "origen", "^SRC1.*"), ("Fuente siete", "origen", "7$"))
_ALIASES = (("licensed under", "Licencia"), ("token", "Secreto"), ("version", "Version"))


def _docs(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "documents")


_add(
    "rule_first_match",
    lambda spark, sf_dir: _docs(spark, sf_dir).select("doc_id", rules.first_match(F.col("text"), _RULES, ("nombre", "tipo")).alias("r")).select("doc_id", "r.nombre"),
    f"SELECT doc_id, {_RULE_SQL.format('text')} AS nombre FROM documents",
)


def _two_pass(spark, sf_dir) -> DataFrame:
    first = rules.first_match(F.col("source"), _SOURCE_RULES, ("nombre", "tipo"), "metadata_estructurada")
    second = rules.first_match(F.col("text"), _RULES, ("nombre", "tipo"), "regla_contextual")
    third = rules.lookup(F.col("lang"), {"es": ("Espanol", "idioma")}, ("nombre", "tipo"), "regla_agente")
    rest = F.struct(F.lit("No determinada").alias("nombre"), F.lit("ninguno").alias("tipo"), F.lit("sin_evidencia").alias("method"))
    return _docs(spark, sf_dir).select("doc_id", F.coalesce(first, second, third, rest).alias("r")).select("doc_id", "r.nombre", "r.method")


_TWO_SQL = f"""t AS (SELECT doc_id, lang, CASE WHEN regexp_matches(source, '(?i)^SRC1.*') THEN 'Fuente uno' WHEN regexp_matches(source, '(?i)7$') THEN 'Fuente siete' END AS a, {_RULE_SQL.format('text')} AS b FROM documents),
m AS (SELECT doc_id, coalesce(a, b, CASE WHEN lang = 'es' THEN 'Espanol' END, 'No determinada') AS nombre, CASE WHEN a IS NOT NULL THEN 'metadata_estructurada' WHEN b IS NOT NULL THEN 'regla_contextual' WHEN lang = 'es' THEN 'regla_agente' ELSE 'sin_evidencia' END AS method FROM t)"""
_add("rule_two_pass", _two_pass, f"WITH {_TWO_SQL} SELECT * FROM m")
_add("rule_method_share", lambda spark, sf_dir: rules.method_shares(_two_pass(spark, sf_dir), "method"), f"WITH {_TWO_SQL} SELECT method, count(*)::BIGINT AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2)::DOUBLE AS pct FROM m GROUP BY 1")
_add("rule_coverage", lambda spark, sf_dir: rules.coverage(_two_pass(spark, sf_dir), {"cobertura": "nombre"}, {"cobertura": "No determinada"}), f"WITH {_TWO_SQL} SELECT round(avg(CASE WHEN nombre <> 'No determinada' THEN 1.0 ELSE 0.0 END) * 100, 2)::DOUBLE AS cobertura FROM m")
_add(
    "rule_alias",
    lambda spark, sf_dir: _docs(spark, sf_dir).select("doc_id", rules.detect_agent(F.col("lang"), F.lit(""), F.col("text"), _ALIASES).alias("agente")),
    "SELECT doc_id, CASE WHEN regexp_matches(lower(replace(text, '_', ' ')), '\\blicensed under\\b') THEN 'Licencia' WHEN regexp_matches(lower(replace(text, '_', ' ')), '\\btoken\\b') THEN 'Secreto' WHEN regexp_matches(lower(replace(text, '_', ' ')), '\\bversion\\b') THEN 'Version' ELSE 'Otro Agente IA' END AS agente FROM documents",
)
_add(
    "category_case",
    lambda spark, sf_dir: _docs(spark, sf_dir).select("doc_id", rules.category(F.element_at(F.array(F.lit("github"), F.lit("hackernews"), F.lit("google_trends"), F.lit("devto")), (F.col("doc_id") % 4 + 1).cast("int")), F.col("n_chars")).alias("categoria")),
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 AND n_chars > 1000 THEN 'popularidad' WHEN doc_id % 4 = 0 THEN 'produccion_tecnica' WHEN doc_id % 4 = 1 THEN 'comunidad' WHEN doc_id % 4 = 2 THEN 'popularidad' ELSE 'actividad_tecnica' END AS categoria FROM documents",
)


def _answers(spark, sf_dir) -> DataFrame:
    """Labels as cached answers, keyed by the digest of the text's first 1000 characters."""
    d = _docs(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id")
    return d.groupBy(F.md5(F.substring("text", 1, 1000)).alias("clave")).agg(
        F.max(F.when(F.col("quality") == 1, 0.9).otherwise(0.5)).alias("confianza"),
        F.min("lang").alias("entorno"),
        F.min("source").alias("integracion"),
        F.array(F.min("lang"), F.min("source")).alias("capacidades"),
        F.array(F.max("lang")).alias("tecnologias"),
    )


_add(
    "enrich_cached",
    lambda spark, sf_dir: staging.with_cached_answers(_docs(spark, sf_dir).select("doc_id", F.col("text").alias("texto")), _answers(spark, sf_dir)).drop("texto"),
    """WITH a AS (SELECT md5(substr(text, 1, 1000)) AS k, max(CASE WHEN quality = 1 THEN 0.9 ELSE 0.5 END)::DOUBLE AS c, min(lang) AS e, min(source) AS i, max(lang) AS t FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT doc_id, coalesce(c, 0.0) AS llm_confianza, CASE WHEN c >= 0.85 THEN e END AS llm_entorno_uso, CASE WHEN c >= 0.85 THEN i END AS llm_tipo_integracion, CASE WHEN c >= 0.85 THEN e || ', ' || i END AS llm_capacidades, CASE WHEN c >= 0.85 THEN t END AS llm_tecnologia
FROM documents LEFT JOIN a ON md5(substr(text, 1, 1000)) = k""",
)
_add(
    "pilot_acceptance",
    lambda spark, sf_dir: staging.answer_report(read(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("valido"), (F.col("doc_id") % 7).cast("double").alias("segundos"), F.when(F.col("quality") == 1, 0.9).otherwise(0.5).alias("confianza"), (F.col("toxic") == 0).alias("con_evidencia"))),
    "SELECT round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) * 100, 2)::DOUBLE AS pct_valido, round(avg((doc_id % 7)::DOUBLE), 2) AS segundos_media, round(avg(CASE WHEN quality = 1 AND toxic = 0 THEN 1.0 ELSE 0.0 END) * 100, 2)::DOUBLE AS pct_aceptado FROM labels",
)
_add("pilot_sample", lambda spark, sf_dir: first_per_stratum(_docs(spark, sf_dir).select("doc_id", "source"), ["source"], [F.md5(F.col("doc_id").cast("string"))], 10), "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR)) <= 10")

_add(
    "union_counts",
    lambda spark, sf_dir: union_counts(activity(spark, sf_dir, ["nombre_agente", "nombre_comunidad"]), {"agentes": "nombre_agente", "comunidades": "nombre_comunidad"}),
    f"WITH {ACT} SELECT 'filas' AS medida, count(*)::BIGINT AS n FROM act UNION ALL SELECT 'agentes', count(DISTINCT nombre_agente) FROM act UNION ALL SELECT 'comunidades', count(DISTINCT nombre_comunidad) FROM act",
)
_add(
    "union_by_name",
    lambda spark, sf_dir: read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nombre")).unionByName(read(spark, sf_dir, "supplier").select(F.col("s_name").alias("nombre"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("saldo")), allowMissingColumns=True),
    "SELECT c_custkey AS id, c_name AS nombre, NULL::DOUBLE AS saldo FROM customer UNION ALL BY NAME SELECT s_name AS nombre, s_suppkey AS id, s_acctbal AS saldo FROM supplier",
)
_LABELS = {"src0": ("Fuente cero",), "src1": ("Fuente uno",)}
_add(
    "label_lookup",
    lambda spark, sf_dir: _docs(spark, sf_dir).select(F.coalesce(rules.lookup(F.col("source"), _LABELS, ("name",))["name"], F.col("source")).alias("etiqueta")).groupBy("etiqueta").agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE source WHEN 'src0' THEN 'Fuente cero' WHEN 'src1' THEN 'Fuente uno' ELSE source END AS etiqueta, count(*)::BIGINT AS n FROM documents GROUP BY 1",
)
_add(
    "run_scope_join",
    lambda spark, sf_dir: _docs(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id", "left").filter(F.coalesce("quality", F.col("doc_id") % 2) == 1).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("con_etiqueta")),
    "SELECT source, count(*)::BIGINT AS n, count(quality)::BIGINT AS con_etiqueta FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, doc_id % 2) = 1 GROUP BY 1",
)
_add(
    "semi_anti_join",
    lambda spark, sf_dir: _docs(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id", "left_anti").groupBy("lang").agg(F.count(F.lit(1)).alias("sin_etiqueta")),
    "SELECT lang, count(*)::BIGINT AS sin_etiqueta FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id) GROUP BY 1",
)
_add(
    "eligible_rows",
    lambda spark, sf_dir: read(spark, sf_dir, "orders").transform(lambda d: gold.eligible(d.withColumns({"s": F.nullif("o_orderstatus", F.lit("P")), "c": F.nullif("o_orderpriority", F.lit("5-LOW"))}), ["s", "c"])).select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'",
)


def _annual(spark, sf_dir) -> DataFrame:
    i = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(F.when(i % 2 == 0, F.concat(i, F.lit(":year:"), F.year("o_orderdate"))).otherwise(i.cast("string")).alias("id"), F.when(i % 3 > 0, "catalogo").otherwise("github").alias("fuente"))
    return prefer_annual(rows, "id", "fuente", "catalogo").groupBy("fuente").agg(F.count(F.lit(1)).alias("n"))


_add("annual_preference", _annual, "SELECT CASE WHEN o_orderkey % 3 > 0 THEN 'catalogo' ELSE 'github' END AS fuente, count(*)::BIGINT AS n FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 GROUP BY 1")


# Landing and staging: events as JSON files of a source each, landed once, read back, mapped and staged.


def _json_files(spark, sf_dir, cut: bool = False) -> str:
    """A folder of JSON lists, at most 5,000 events each, in a sub-folder for each event type; the end of every other one lost if so asked."""
    item = F.struct("event_id", "user_id", "event_type", "value")
    lists = _events(spark, sf_dir).groupBy(F.col("event_type").alias("fuente"), F.floor(F.col("event_id") / 5000).alias("part")).agg(F.to_json(F.sort_array(F.collect_list(item))).alias("value"))
    if cut:
        lost = F.substring("value", F.lit(1), F.length("value") - 9)
        lists = lists.withColumn("value", F.when(F.col("part") % 2 == 0, lost).otherwise(F.col("value")))
    root = shared_folder(spark, "landing")
    lists.select("fuente", "value").write.option("maxRecordsPerFile", 1).partitionBy("fuente").text(root)
    return root


def _landed(spark, sf_dir, cut: bool = False, split_above: int = raw.SPLIT_ABOVE) -> tuple[DataFrame, DataFrame, DataFrame]:
    records = raw.read_json(spark, _json_files(spark, sf_dir, cut), "*.txt", split_above=split_above)
    return raw.land(records, spark.createDataFrame([], contracts.RAW_FILES), "run-1")


_add(
    "land_files",
    lambda spark, sf_dir: _landed(spark, sf_dir)[0].select(F.substring_index("fuente", "=", -1).alias("fuente"), "registros", "columnas", F.length("hash_sha256").alias("digitos")),
    "SELECT event_type AS fuente, count(*)::BIGINT AS registros, 4 AS columnas, 64 AS digitos FROM events GROUP BY event_type, event_id // 5000",
)
_add(
    "land_records",
    lambda spark, sf_dir: _landed(spark, sf_dir)[1].select(F.get_json_object("raw_data", "$.event_id").cast("long").alias("event_id"), F.get_json_object("raw_data", "$.event_type").alias("event_type")),
    "SELECT event_id, event_type FROM events",
)
_add(
    "land_inventory",
    lambda spark, sf_dir: (lambda landed: raw.inventory(landed[0], landed[1]).groupBy("registros", "cargados", "diferencia").agg(F.count(F.lit(1)).alias("n")))(_landed(spark, sf_dir)),
    "WITH f AS (SELECT count(*)::BIGINT AS c FROM events GROUP BY event_type, event_id // 5000) SELECT c AS registros, c AS cargados, 0::BIGINT AS diferencia, count(*)::BIGINT AS n FROM f GROUP BY 1",
)


def _rejects(spark, sf_dir) -> DataFrame:
    """By source: files landed and rejected, records landed, and files that a second try takes for new."""
    records = raw.read_json(spark, _json_files(spark, sf_dir, True), "*.txt")
    files, landed, rejected = raw.land(records, spark.createDataFrame([], contracts.RAW_FILES), "run-1")
    again = raw.new_files(records.select("ruta", "fuente", "hash_sha256").distinct(), files)
    source, one = F.substring_index("fuente", "=", -1).alias("fuente"), F.lit(1)
    parts = (
        files.select(source, one.alias("aterrizados"), F.col("registros")),
        rejected.select(source, F.when(F.col("reason") == raw.DAMAGED, 1).alias("rechazados")),
        again.select(source, one.alias("pendientes")),
        landed.select(F.get_json_object("raw_data", "$.event_type").alias("fuente"), one.alias("cargados")),
    )
    names = ("aterrizados", "rechazados", "pendientes", "registros", "cargados")
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.groupBy("fuente").agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])


_add(
    "land_rejects",
    _rejects,
    """WITH f AS (SELECT event_type AS fuente, event_id // 5000 AS part, count(*) AS n FROM events GROUP BY 1, 2)
SELECT fuente, count(*) FILTER (part % 2 = 1)::BIGINT AS aterrizados, count(*) FILTER (part % 2 = 0)::BIGINT AS rechazados, count(*) FILTER (part % 2 = 0)::BIGINT AS pendientes,
  coalesce(sum(n) FILTER (part % 2 = 1), 0)::BIGINT AS registros, coalesce(sum(n) FILTER (part % 2 = 1), 0)::BIGINT AS cargados FROM f GROUP BY 1""",
)
_add(
    "land_split",
    lambda spark, sf_dir: _landed(spark, sf_dir, split_above=1)[1].select((F.col("id") % (1 << 32)).alias("lugar"), F.get_json_object("raw_data", "$.event_id").cast("long").alias("event_id"), F.get_json_object("raw_data", "$.event_type").alias("event_type")),
    "SELECT row_number() OVER (PARTITION BY event_type, event_id // 5000 ORDER BY event_id) - 1 AS lugar, event_id, event_type FROM events",
)


def _raw_events(spark, sf_dir) -> DataFrame:
    """Raw records of a forum, as JSON: a title that names an agent, a time, points; every event twice, as two snapshots."""
    title = F.when(F.col("event_type") == "click", "codex tool").when(F.col("event_type") == "view", "a cursor kit").otherwise("noise")
    item = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), title.alias("title"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"), (F.col("user_id") % 100 + F.col("shot")).alias("points")))
    e = _events(spark, sf_dir).withColumn("shot", F.explode(F.array(F.lit(0), F.lit(1))))
    return e.select((F.col("event_id") * 2 + F.col("shot")).alias("raw_record_id"), F.col("shot").cast("long").alias("raw_file_id"), item.alias("raw_data"), F.lit("hackernews").alias("fuente"), F.lit("comunidad").alias("tipo_fuente"), F.lit("2024-03-01").cast("timestamp").alias("fecha_carga_raw"))


_FORUM = {"hackernews": "id string, title string, created_at string, points long"}
_add(
    "staged_records",
    lambda spark, sf_dir: staging.staged(_raw_events(spark, sf_dir), _FORUM).select("id_origen_registro", "nombre_agente", "fecha_evento", "cantidad_interacciones", "raw_file_id", "categoria", "dim_nombre_comunidad"),
    "SELECT event_id::VARCHAR AS id_origen_registro, CASE event_type WHEN 'click' THEN 'Codex' ELSE 'Cursor Agent' END AS nombre_agente, ts::DATE AS fecha_evento, user_id % 100 + 1 AS cantidad_interacciones, 1::BIGINT AS raw_file_id, 'comunidad' AS categoria, 'Hacker News' AS dim_nombre_comunidad FROM events WHERE event_type IN ('click', 'view')",
)
_add(
    "replayed_candidates",
    lambda spark, sf_dir: staging.replayed(_raw_events(spark, sf_dir), _FORUM).groupBy("nombre_agente", "raw_file_id").agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE event_type WHEN 'click' THEN 'Codex' WHEN 'view' THEN 'Cursor Agent' ELSE 'Otro Agente IA' END AS nombre_agente, unnest([0, 1])::BIGINT AS raw_file_id, count(*)::BIGINT AS n FROM events GROUP BY 1, 2",
)
_add(
    "enrichment_rows",
    lambda spark, sf_dir: staging.for_enrichment(_docs(spark, sf_dir).select("doc_id", F.when(F.col("lang") == "en", "reddit").when(F.col("lang") == "fr", "devto").otherwise("github").alias("fuente"), F.when(F.col("n_chars") > 500, F.col("text")).alias("texto"))).select("doc_id"),
    "SELECT doc_id FROM documents WHERE lang IN ('en', 'fr') AND n_chars > 500 AND text <> ''",
)


def _stream_path(sf_dir: str) -> str:
    """A pattern, for a stream takes a plain path as a folder; the table may be one file."""
    return f"{sf_dir}/event[s].parquet"


def _streamed(spark, sf_dir) -> DataFrame:
    """Events as a stream, merged into a table of the newest event of each user and type."""
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    table = incremental.VersionedTable(spark, shared_folder(spark, "stream"), schema, ["event_type", "user_id"])
    stream = spark.readStream.schema(schema).parquet(_stream_path(sf_dir))
    incremental.upsert_stream(stream, table, ["ts", "event_id"], shared_folder(spark, "stream-checkpoint")).awaitTermination()
    return table.current().select("event_type", "user_id", "event_id")


_add("stream_upsert", _streamed, "SELECT event_type, user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1")


def _stream_freshness(spark, sf_dir) -> DataFrame:
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double"
    e = spark.readStream.schema(schema).parquet(_stream_path(sf_dir))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "empty").otherwise("success")
    outcomes = e.select(F.col("user_id").cast("string").alias("source"), status.alias("status"), F.floor("value").cast("long").alias("records_extracted"), F.col("ts").alias("execution_timestamp"))
    out = shared_folder(spark, "stream-freshness")
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/{n}")
    q = incremental.freshness_stream(outcomes).writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", shared_folder(spark, "stream-checkpoint")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{out}/{q.lastProgress['batchId']}").select("source", "last_attempt_at", "last_success_at", "records_extracted")


_add("stream_freshness", _stream_freshness, """SELECT user_id::VARCHAR AS source, max(ts) AS last_attempt_at, max(ts) FILTER (event_type <> 'error') AS last_success_at, sum(floor(value))::BIGINT AS records_extracted FROM events GROUP BY 1""")
