"""Source mappers: records of one source to the observation contract.

A mapper is a projection: contract column -> expression over the source's
columns. What it leaves out is filled by `complete`. Columns that a source does
not have count as their defaults by schema, not by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta import contracts
from veleta.functions.cleaning import first_existing, first_non_null, index_to_max, joined_list, nested, number, record_hash

Projection = dict[str, Column]


def _text(df: DataFrame, *columns: str, default: str | None = "") -> Column:
    return first_existing(df, columns, default).cast("string")


def _count(df: DataFrame, *columns: str, default: int = 0) -> Column:
    return number(first_existing(df, columns, default), "long", default)


def _id(df: DataFrame) -> Column:
    return F.col("id").cast("string") if "id" in df.columns else record_hash(df)


def _community(name: str, kind: str) -> Projection:
    return {"comunidad_raw": F.lit(name), "tipo_comunidad_raw": F.lit(kind)}


def _post(df: DataFrame, platform: str, *texts: str) -> Projection:
    """What posts of all kinds share."""
    return {
        "id_origen_registro": _id(df),
        "plataforma": F.lit(platform),
        "titulo": _text(df, "title"),
        "texto": _text(df, *texts),
        "url": _text(df, "url"),
        "fecha_evento_raw": _text(df, "created_at", default=None),
    }


def code_hosting(df: DataFrame) -> Projection:
    return {
        "id_origen_registro": _id(df),
        "plataforma": F.lit("github"),
        "titulo": _text(df, "name"),
        "texto": _text(df, "description"),
        "url": _text(df, "html_url"),
        "fecha_evento_raw": _text(df, "created_at", default=None),
        "stars_github": _count(df, "stargazers_count"),
        "forks_github": _count(df, "forks_count"),
        "issues_abiertos": _count(df, "open_issues_count"),
        "cantidad_menciones": F.lit(1),
        "cantidad_interacciones": _count(df, "open_issues_count"),
        "tecnologia_raw": _text(df, "language", default=None),
        "comunidad_raw": nested(df, "owner", "login"),
        "tipo_comunidad_raw": nested(df, "owner", "type"),
    }


def developer_blog(df: DataFrame) -> Projection:
    tags = "tags" if "tags" in df.columns else "tag_list"
    return _post(df, "devto", "description") | _community("DEV Community", "comunidad técnica") | {
        "cantidad_interacciones": _count(df, "reactions_count"),
        "cantidad_menciones": _count(df, "comments_count"),
        "tecnologia_raw": joined_list(df, tags),
    }


def discussion(df: DataFrame) -> Projection:
    return _post(df, "hackernews", "story_text", "text") | _community("Hacker News", "foro técnico") | {
        "cantidad_interacciones": _count(df, "points"),
        "cantidad_menciones": _count(df, "num_comments"),
    }


def search_interest(df: DataFrame) -> Projection:
    return _community("Audiencia de Google Search", "audiencia de búsqueda") | {
        "id_origen_registro": record_hash(df),
        "plataforma": F.lit("google_trends"),
        "titulo": F.concat(_text(df, "agente"), F.lit(" Trend")),
        "texto": F.lit("Tendencia de busqueda en Google Trends"),
        "url": F.lit("https://trends.google.com/"),
        "fecha_evento_raw": _text(df, "fecha", default=None),
        "score_popularidad": number(first_existing(df, ["valor"], 0)),
        "agente": _text(df, "agente", default=None),
    }


#: Supplemental counts of a catalog record that go into its text.
EVIDENCE = ("review_count", "human_review_count", "bot_review_count", "reviewed_pull_requests", "task_classified_pull_requests", "known_contributors")


def _pull_request_catalog(df: DataFrame) -> Projection:
    agent, repo = _text(df, "agent", default="Agente IA"), _text(df, "full_name")
    prs, merged, people = (_count(df, c) for c in ("pull_requests_count", "merged_pull_requests", "unique_contributors"))
    key = F.concat_ws(":", agent, repo)
    if "activity_year" in df.columns:
        key = F.when(F.col("activity_year").isNotNull(), F.col("id").cast("string")).otherwise(key)
    figures = [("language", _text(df, "language")), ("pull_requests", prs), ("merged_pull_requests", merged)]
    figures += [(c, _count(df, c)) for c in EVIDENCE if c in df.columns]
    if "task_type_counts" in df.columns:
        kind = df.schema["task_type_counts"].dataType.typeName()
        figures.append(("task_type_counts", F.to_json("task_type_counts") if kind in ("map", "struct") else F.col("task_type_counts").cast("string")))
    text = F.concat_ws("; ", F.lit("dataset=AIDev Dataset: AI Coding"), *[F.concat(F.lit(f"{n}="), v.cast("string")) for n, v in figures])
    return {
        "id_origen_registro": key,
        "plataforma": F.lit("aidedev_ai_coding"),
        "titulo": F.concat_ws(" - ", agent, repo),
        "texto": text,
        "url": _text(df, "sample_pr_url", "repo_url"),
        "fecha_evento_raw": first_non_null(df, ["last_activity", "first_activity"]).cast("string"),
        "cantidad_menciones": prs,
        "cantidad_interacciones": prs + merged + people,
        "score_popularidad": number(first_existing(df, ["merge_rate"], 0)),
        "stars_github": _count(df, "stars"),
        "forks_github": _count(df, "forks"),
        "indice_adopcion": F.col("indice_adopcion_"),
        "indice_innovacion": F.col("indice_innovacion_"),
        "tecnologia_raw": _text(df, "language"),
        "comunidad_raw": F.split_part(repo, F.lit("/"), F.lit(1)),
        "tipo_comunidad_raw": F.lit("organización o propietario de repositorio"),
    }


def _curated_catalog(df: DataFrame) -> Projection:
    figures = [F.concat(F.lit(f"{c}="), _text(df, c)) for c in ("empresa", "categoria", "estado")]
    return {
        "id_origen_registro": _text(df, "id"),
        "plataforma": F.lit("catalogo_manual"),
        "titulo": _text(df, "nombre_oficial", "name", "title", default="Agente IA"),
        "texto": F.concat_ws("; ", *figures),
        "url": F.lit(""),
        "tecnologia_raw": _text(df, "categoria", default=None),
        "comunidad_raw": _text(df, "empresa", default="Catálogo curado"),
        "tipo_comunidad_raw": F.lit("proveedor de tecnología"),
    }


def catalog(df: DataFrame) -> Projection:
    return _pull_request_catalog(df) if "pull_requests_count" in df.columns else _curated_catalog(df)


def community_posts(df: DataFrame) -> Projection:
    part = F.nullif(F.regexp_extract(_text(df, "url"), r"reddit\.com/r/([^/]+)", 1), F.lit(""))
    return _post(df, "reddit", "selftext", "text") | {
        "cantidad_interacciones": _count(df, "score", "upvotes"),
        "cantidad_menciones": _count(df, "num_comments", "comments", default=1),
        "comunidad_raw": F.coalesce(part, F.lit("Reddit · búsqueda general")),
        "tipo_comunidad_raw": F.when(part.isNotNull(), "subreddit").otherwise("comunidad general"),
    }


def questions(df: DataFrame) -> Projection:
    return _post(df, "stackoverflow", "description", "body") | _community("Stack Overflow", "Q&A técnica") | {
        "cantidad_interacciones": F.greatest(_count(df, "score"), F.lit(0)),
        "cantidad_menciones": _count(df, "answer_count") + 1,
        "tecnologia_raw": joined_list(df, "tags"),
    }


def papers(df: DataFrame) -> Projection:
    return _post(df, "arxiv", "description", "summary") | _community("arXiv", "repositorio académico") | {
        "cantidad_menciones": F.lit(1),
        "tecnologia_raw": joined_list(df, "categories"),
    }


def news(df: DataFrame) -> Projection:
    publisher = F.nullif(F.regexp_extract(_text(df, "title"), r"\s+-\s+([^-]+)$", 1), F.lit(""))
    return _post(df, "google_news", "description") | {
        "cantidad_menciones": F.lit(1),
        "comunidad_raw": F.coalesce(_text(df, "publisher", default=None), publisher, F.lit("Google News")),
        "tipo_comunidad_raw": F.lit("medio o fuente editorial"),
    }


def any_source(df: DataFrame, source: str) -> Projection:
    return {
        "id_origen_registro": record_hash(df),
        "plataforma": F.lit(source),
        "titulo": _text(df, "title", "name", default="Sin titulo"),
        "texto": _text(df, "text", "description"),
        "url": _text(df, "url", "link"),
        "fecha_evento_raw": _text(df, "created_at", "date", default=None),
    }


MAPPERS: dict[str, Callable[[DataFrame], Projection]] = {
    "github": code_hosting,
    "devto": developer_blog,
    "hackernews": discussion,
    "google_trends": search_interest,
    "catalogo": catalog,
    "reddit": community_posts,
    "stackoverflow": questions,
    "arxiv": papers,
    "gnews": news,
}
#: Columns that come with every record from the landing.
LINEAGE = ("raw_file_id", "raw_record_id", "fecha_carga_raw", "tipo_fuente")


def normalize(df: DataFrame, source: str) -> DataFrame:
    """Observations of one source; `df` holds its parsed records and, where known, the lineage columns."""
    if source == "catalogo" and "pull_requests_count" in df.columns:
        file = "raw_file_id" if "raw_file_id" in df.columns else None
        df = df.withColumn("one_", F.lit(1))
        for column, name in (("pull_requests_count", "indice_adopcion_"), ("unique_contributors", "indice_innovacion_")):
            df = df.withColumn("value_", _count(df, column))
            df = index_to_max(df, "value_", file or "one_", name).drop("value_")
        df = df.drop("one_")
    own = df.drop(*LINEAGE)
    projection = MAPPERS[source](own) if source in MAPPERS else any_source(own, source)
    return complete(df, projection, source)


def complete(df: DataFrame, projection: Projection, source: str) -> DataFrame:
    """The projection with every contract column: counts default to 0, all others to null."""
    given = projection | {"fuente": F.lit(source)} | {c: F.col(c) for c in LINEAGE if c in df.columns}
    given.setdefault("tipo_fuente", F.lit("desconocido"))
    out = []
    for name, kind in contracts.OBSERVATION.items():
        default = F.lit(0) if name in contracts.COUNT_MEASURES else F.lit(None)
        out.append(given.get(name, default).cast(kind).alias(name))
    return df.select(*out)


def interest_over_time(wide: DataFrame, date: str = "date") -> DataFrame:
    """Date x keyword frame to rows (agente, fecha, valor), without the mark of incomplete days."""
    rows = wide.drop("isPartial")
    return rows.unpivot([date], [c for c in rows.columns if c != date], "agente", "valor").withColumnRenamed(date, "fecha")


def search_hits(hits: DataFrame, zone: str = "America/Guayaquil", item_url: str = "https://news.ycombinator.com/item?id=") -> DataFrame:
    """Search hits to records: local time, default address; hits without identifier or time are dropped."""
    return hits.filter(F.col("objectID").isNotNull() & F.col("created_at_i").isNotNull()).select(
        F.col("objectID").alias("id"),
        "title",
        F.coalesce("url", F.concat(F.lit(item_url), "objectID")).alias("url"),
        F.date_format(F.from_utc_timestamp(F.timestamp_seconds("created_at_i"), zone), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.coalesce("points", F.lit(0)).alias("points"),
        F.coalesce("num_comments", F.lit(0)).alias("num_comments"),
    )


def validated(records: DataFrame, required: tuple[str, ...] = ("nombre_oficial", "empresa", "categoria"), least: int = 2, year: str = "anio") -> DataFrame:
    """`records` with `is_valid`: required texts of a length, and a year from 1950 to 2030 where one is given."""
    ok = F.lit(True)
    for c in required:
        ok = ok & (F.length(F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))) >= least)
    if year in records.columns:
        ok = ok & (F.col(year).isNull() | F.coalesce(F.col(year).try_cast("int").between(1950, 2030), F.lit(False)))
    return records.withColumn("is_valid", ok)
