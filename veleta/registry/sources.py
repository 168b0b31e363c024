"""Source mappers over the given tables: each table stands for the parsed records of one source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.plans.activity import read
from veleta.sources import mappers

QUERIES, ORACLES = {}, {}

#: Contract columns that a query returns.
SHOWN = ("id_origen_registro", "plataforma", "titulo", "url", "fecha_evento_raw", "cantidad_menciones", "cantidad_interacciones", "tecnologia_raw", "comunidad_raw", "tipo_comunidad_raw")


def _add(name: str, source: str, table: str, columns: dict[str, str], sql: str, shown: tuple[str, ...] = SHOWN) -> None:
    """Register the mapper of a source over a table; `columns`: the record's fields by expression."""

    def query(spark, sf_dir) -> DataFrame:
        rows = read(spark, sf_dir, table).select(*[F.expr(e).alias(c) for c, e in columns.items()])
        return mappers.normalize(rows, source).select(*shown)

    QUERIES[name], ORACLES[name] = query, sql


def _sql(table: str, **columns: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {table}"


_add(
    "map_code_hosting",
    "github",
    "part",
    {"id": "p_partkey", "name": "p_name", "description": "p_type", "html_url": "concat('https://h/', p_partkey)", "stargazers_count": "p_size", "forks_count": "p_retailprice", "open_issues_count": "nullif(p_size, 7)", "language": "nullif(p_brand, 'Brand#11')", "owner": "named_struct('login', p_brand, 'type', p_type)"},
    _sql("part", id_origen_registro="p_partkey::VARCHAR", plataforma="'github'", titulo="p_name", url="'https://h/' || p_partkey", fecha_evento_raw="NULL::VARCHAR", cantidad_menciones="1::BIGINT", cantidad_interacciones="coalesce(nullif(p_size, 7), 0)::BIGINT",
         tecnologia_raw="nullif(p_brand, 'Brand#11')", comunidad_raw="p_brand", tipo_comunidad_raw="p_type", stars_github="p_size::BIGINT", forks_github="trunc(p_retailprice)::BIGINT"),
    (*SHOWN, "stars_github", "forks_github"),
)
_add(
    "map_developer_blog",
    "devto",
    "documents",
    {"id": "doc_id", "title": "source", "description": "text", "url": "concat('u/', doc_id)", "created_at": "'2025-01-02T03:04:05Z'", "reactions_count": "n_chars", "comments_count": "cast(doc_id as string)", "tag_list": "array(lang, source)"},
    _sql("documents", id_origen_registro="doc_id::VARCHAR", plataforma="'devto'", titulo="source", url="'u/' || doc_id", fecha_evento_raw="'2025-01-02T03:04:05Z'", cantidad_menciones="doc_id", cantidad_interacciones="n_chars", tecnologia_raw="lang || ', ' || source", comunidad_raw="'DEV Community'", tipo_comunidad_raw="'comunidad técnica'", texto="text"),
    (*SHOWN, "texto"),
)
_add(
    "map_community_posts",
    "reddit",
    "documents",
    {"id": "doc_id", "title": "source", "selftext": "lang", "url": "case when lang = 'en' then concat('https://x.org/', doc_id) else concat('https://www.reddit.com/r/', lang, '/comments/', doc_id) end", "score": "n_chars"},
    _sql("documents", id_origen_registro="doc_id::VARCHAR", plataforma="'reddit'", titulo="source", url="CASE WHEN lang = 'en' THEN 'https://x.org/' || doc_id ELSE 'https://www.reddit.com/r/' || lang || '/comments/' || doc_id END", fecha_evento_raw="NULL::VARCHAR",
         cantidad_menciones="1::BIGINT", cantidad_interacciones="n_chars", tecnologia_raw="NULL::VARCHAR", comunidad_raw="CASE WHEN lang = 'en' THEN 'Reddit · búsqueda general' ELSE lang END", tipo_comunidad_raw="CASE WHEN lang = 'en' THEN 'comunidad general' ELSE 'subreddit' END"),
)
_add(
    "map_questions",
    "stackoverflow",
    "conversations",
    {"id": "concat_ws(':', conv_id, turn)", "title": "role", "body": "text", "score": "turn - 2", "answer_count": "turn", "tags": "'react, sql'"},
    _sql("conversations", id_origen_registro="conv_id || ':' || turn", plataforma="'stackoverflow'", titulo="role", url="''", fecha_evento_raw="NULL::VARCHAR", cantidad_menciones="turn + 1", cantidad_interacciones="greatest(turn - 2, 0)", tecnologia_raw="'react, sql'", comunidad_raw="'Stack Overflow'", tipo_comunidad_raw="'Q&A técnica'", texto="text"),
    (*SHOWN, "texto"),
)
_add(
    "map_papers",
    "arxiv",
    "benchmark",
    {"id": "item_id", "title": "concat('p', item_id)", "summary": "text", "categories": "array('cs.AI', 'cs.SE')"},
    _sql("benchmark", id_origen_registro="item_id::VARCHAR", plataforma="'arxiv'", titulo="'p' || item_id", url="''", fecha_evento_raw="NULL::VARCHAR", cantidad_menciones="1::BIGINT", cantidad_interacciones="0::BIGINT", tecnologia_raw="'cs.AI, cs.SE'", comunidad_raw="'arXiv'", tipo_comunidad_raw="'repositorio académico'", texto="text"),
    (*SHOWN, "texto"),
)
_add(
    "map_news",
    "gnews",
    "supplier",
    {"id": "s_suppkey", "title": "case when s_acctbal > 0 then concat('a story - ', s_name) else s_name end", "description": "s_name"},
    _sql("supplier", id_origen_registro="s_suppkey::VARCHAR", plataforma="'google_news'", titulo="CASE WHEN s_acctbal > 0 THEN 'a story - ' || s_name ELSE s_name END", url="''", fecha_evento_raw="NULL::VARCHAR", cantidad_menciones="1::BIGINT", cantidad_interacciones="0::BIGINT",
         tecnologia_raw="NULL::VARCHAR", comunidad_raw="CASE WHEN s_acctbal > 0 THEN s_name ELSE 'Google News' END", tipo_comunidad_raw="'medio o fuente editorial'"),
)
_add(
    "map_curated_catalog",
    "catalogo",
    "nation",
    {"id": "n_nationkey", "nombre_oficial": "n_name", "empresa": "nullif(concat('e', n_regionkey), 'e1')", "categoria": "'IDE'"},
    _sql("nation", id_origen_registro="n_nationkey::VARCHAR", plataforma="'catalogo_manual'", titulo="n_name", url="''", fecha_evento_raw="NULL::VARCHAR", cantidad_menciones="0::BIGINT", cantidad_interacciones="0::BIGINT", tecnologia_raw="'IDE'", comunidad_raw="nullif('e' || n_regionkey, 'e1')", tipo_comunidad_raw="'proveedor de tecnología'"),
)


def _catalog_records(spark, sf_dir) -> DataFrame:
    """Orders of a customer and priority as pull requests of an agent in a repository."""
    by = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("agent"), F.concat(F.lit("org/"), "o_custkey").alias("full_name"))
    return by.agg(F.count(F.lit(1)).alias("pull_requests_count"), F.count_if(F.col("o_orderstatus") == "F").alias("merged_pull_requests"), F.count_distinct("o_orderdate").alias("unique_contributors"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("first_activity")).withColumn("last_activity", F.lit(None).cast("string"))


QUERIES["map_pull_request_catalog"] = lambda spark, sf_dir: mappers.normalize(_catalog_records(spark, sf_dir), "catalogo").select("id_origen_registro", "titulo", "texto", "fecha_evento_raw", "cantidad_menciones", "cantidad_interacciones", "indice_adopcion", "indice_innovacion", "comunidad_raw")
ORACLES["map_pull_request_catalog"] = """WITH g AS (SELECT o_orderpriority AS a, 'org/' || o_custkey AS r, count(*)::BIGINT AS n, (count(*) FILTER (o_orderstatus = 'F'))::BIGINT AS m, count(DISTINCT o_orderdate)::BIGINT AS u, strftime(max(o_orderdate), '%Y-%m-%d') AS f FROM orders GROUP BY 1, 2)
SELECT a || ':' || r AS id_origen_registro, a || ' - ' || r AS titulo, 'dataset=AIDev Dataset: AI Coding; language=; pull_requests=' || n || '; merged_pull_requests=' || m AS texto, f AS fecha_evento_raw, n AS cantidad_menciones, n + m + u AS cantidad_interacciones,
  round_even(n::DOUBLE / max(n) OVER () * 100.0, 2) AS indice_adopcion, round_even(u::DOUBLE / max(u) OVER () * 100.0, 2) AS indice_innovacion, 'org' AS comunidad_raw FROM g"""


def _interest(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("agente"), F.to_date("ts").cast("string").alias("fecha")).agg(F.count(F.lit(1)).alias("valor"))
    return mappers.normalize(rows, "google_trends").select("titulo", "fecha_evento_raw", "score_popularidad", "agente", "comunidad_raw", F.length("id_origen_registro").alias("digitos"))


QUERIES["map_search_interest"] = _interest
ORACLES["map_search_interest"] = "SELECT event_type || ' Trend' AS titulo, ts::DATE::VARCHAR AS fecha_evento_raw, count(*)::DOUBLE AS score_popularidad, event_type AS agente, 'Audiencia de Google Search' AS comunidad_raw, 64 AS digitos FROM events GROUP BY event_type, ts::DATE"


def _hits(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    hits = e.select(F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("objectID"), F.unix_timestamp("ts").alias("created_at_i"), F.col("event_type").alias("title"), F.when(F.col("event_type") == "click", F.lit("https://x/1")).alias("url"), F.when(F.col("value") > 10, F.col("user_id")).alias("points"), F.lit(None).cast("long").alias("num_comments"))
    return mappers.search_hits(hits)


QUERIES["search_hits"] = _hits
ORACLES["search_hits"] = """SELECT event_id::VARCHAR AS id, event_type AS title, CASE WHEN event_type = 'click' THEN 'https://x/1' ELSE 'https://news.ycombinator.com/item?id=' || event_id END AS url, strftime(date_trunc('second', ts) - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S') AS created_at,
  CASE WHEN value > 10 THEN user_id ELSE 0 END AS points, 0::BIGINT AS num_comments FROM events WHERE event_type <> 'error'"""
QUERIES["validated_records"] = lambda spark, sf_dir: mappers.validated(
    read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("nombre_oficial"), F.when(F.col("p_size") > 3, F.col("p_brand")).otherwise(" x ").alias("empresa"), F.col("p_type").alias("categoria"), F.when(F.col("p_size") > 10, F.col("p_size") * 40 + 500).cast("string").alias("anio"))
).select("p_partkey", "is_valid")
ORACLES["validated_records"] = "SELECT p_partkey, p_size > 3 AND length(trim(p_name)) >= 2 AND length(trim(p_type)) >= 2 AND (p_size <= 10 OR p_size * 40 + 500 BETWEEN 1950 AND 2030) AS is_valid FROM part"
QUERIES["map_any_source"] = lambda spark, sf_dir: mappers.normalize(read(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("link")), "otra").select("plataforma", "titulo", "texto", "url", "fuente", "tipo_fuente", F.length("id_origen_registro").alias("digitos"))
ORACLES["map_any_source"] = "SELECT 'otra' AS plataforma, r_name AS titulo, '' AS texto, r_regionkey::VARCHAR AS url, 'otra' AS fuente, 'desconocido' AS tipo_fuente, 64 AS digitos FROM region"
