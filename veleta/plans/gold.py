"""Star schema: dimensions, fact derivation and integrity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veleta.operators.keys import newest_by_aggregate, unique, upsert_fact, with_surrogate_keys
from veleta.operators.rules import OTHER_AGENT, lookup
from veleta.scratch import forget, keep, keep_parts

# Default members of the dimensions.
UNKNOWN = "No especificado"
UNDETERMINED = {
    "dim_nombre_plataforma": "No determinada",
    "dim_tipo_plataforma": "No determinado",
    "dim_ecosistema": "No determinado",
    "dim_nombre_tecnologia": "No determinada",
    "dim_categoria_tecnologia": "No determinada",
    "dim_dominio_tecnologico": "No determinado",
    "dim_tipo_senal": "Observación digital",
    "dim_nombre_comunidad": "Comunidad no determinada",
    "dim_tipo_comunidad": "comunidad no determinada",
    "dim_region_comunidad": UNKNOWN,
}

# Spanish names of months and weekdays.
MONTHS = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
WEEKDAYS = ("Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado", "Domingo")


def time_dimension(rows: DataFrame, date: str) -> DataFrame:
    """One row for each date: calendar parts, ISO week and weekday, names and weekend flag."""
    d = F.col("fecha")
    month, weekday = F.month(d), F.weekday(d) + 1
    name = lambda i, names: F.element_at(F.array(*[F.lit(n) for n in names]), i)
    return rows.select(F.col(date).alias("fecha")).filter(d.isNotNull()).distinct().select(
        d,
        F.year(d).alias("anio"),
        F.when(month <= 6, 1).otherwise(2).alias("semestre"),
        F.quarter(d).alias("trimestre"),
        month.alias("mes"),
        name(month, MONTHS).alias("nombre_mes"),
        F.weekofyear(d).alias("semana"),
        F.dayofmonth(d).alias("dia"),
        weekday.alias("dia_semana"),
        name(weekday, WEEKDAYS).alias("nombre_dia"),
        (weekday >= 6).alias("es_fin_semana"),
    )


# Attributes of known agents (category, type, vendor, key feature, pricing).
AGENT_ATTRIBUTES = {
    "Codex": ("Modelo fundacional de codigo", "API / Modelo", "OpenAI", "Pionero en autocompletado LLM", "Deprecado / API"),
    "GitHub Copilot Coding Agent": ("Equipos GitHub/Microsoft", "Ecosistema nativo", "Microsoft / GitHub", "Copilot Workspaces, integracion profunda con GitHub", "Suscripcion por usuario"),
    "Cursor Agent": ("Usuarios de VS Code, desarrollo general", "IDE dedicado", "Anysphere", "Razonamiento en codebase multi-repo", "Gratis + de pago"),
    "Windsurf Cascade": ("Codebases grandes, enterprise", "IDE dedicado", "Codeium", "Carga automatica de contexto (Cascade)", "Gratis + de pago"),
    "Devin": ("Ingenieria de software autonoma", "Agente autonomo", "Cognition", "Agente 100% autonomo cloud", "Enterprise"),
    "OpenCode": ("Desarrollo en terminal agnostico", "Primero en terminal", "OpenCode", "Orquestador agnostico de terminal", "Gratis (Open Source)"),
    "Claude Code": ("Tareas de razonamiento complejo", "Primero en terminal", "Anthropic", "Profundidad de razonamiento multi-paso", "Segun uso"),
    "Cline": ("Usuarios de VS Code agnosticos al modelo", "Extension BYOK", "Open Source", "Open source, agnostico al modelo", "Gratis (BYOK)"),
    "Google Antigravity": ("Estado del arte / IDE integrado", "IDE y Agente", "Google Deepmind", "Memoria a largo plazo e integracion total", "Preview / Beta"),
    "Google Jules": (UNKNOWN, UNKNOWN, "Google", UNKNOWN, UNKNOWN),
}
_ATTRIBUTES = ("categoria_agente", "tipo_agente", "proveedor", "caracteristica_clave", "modelo_precios")


def agent_dimension(rows: DataFrame, agent: str) -> DataFrame:
    """Agents with the attributes of the known ones, and whether they are identified."""
    known = lookup(F.col("nombre_agente"), AGENT_ATTRIBUTES, _ATTRIBUTES)
    by = rows.filter(F.col(agent).isNotNull()).select(default_member(F.col(agent), UNKNOWN).alias("nombre_agente")).distinct()
    return by.withColumn("k_", known).select(
        "nombre_agente",
        *[F.coalesce(F.col(f"k_.{a}"), F.lit(UNKNOWN)).alias(a) for a in _ATTRIBUTES],
        (~F.col("nombre_agente").isin(OTHER_AGENT, UNKNOWN)).alias("es_agente_identificado"),
    )


def consolidated(rows: DataFrame, key: str, attribute: str) -> DataFrame:
    """The smallest attribute of each key, blanks under the default member."""
    clean = rows.filter(F.col(key).isNotNull()).select(default_member(F.col(key), UNKNOWN).alias(key), default_member(F.col(attribute), UNKNOWN).alias(attribute))
    return clean.groupBy(key).agg(F.min(attribute).alias(attribute))


def latest_attributes(rows: DataFrame, natural: Sequence[str], attributes: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Attributes of the newest row of each natural key."""
    return newest_by_aggregate(rows, list(natural), list(version), list(attributes)).select(*natural, *attributes)


def default_member(column: Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(default))


#: Sources whose counts are community activity.
COMMUNITY_SOURCES = ("reddit", "hackernews", "devto")


def fact_scores(rows: DataFrame) -> DataFrame:
    """Measures of a fact: counts without nulls, the five scores, and the first normalized value that is there."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    money = lambda c: c.cast("decimal(12,4)")
    talk = (default_member(F.col("categoria"), UNKNOWN) == "comunidad") | default_member(F.col("fuente"), UNKNOWN).isin(*COMMUNITY_SOURCES)
    counts = ("cantidad_menciones", "cantidad_interacciones", "stars_github", "forks_github", "issues_abiertos", "releases")
    first = F.coalesce(*[F.col(c).cast("decimal(18,6)") for c in ("score_popularidad", "indice_adopcion", "indice_innovacion", *counts[1::-1])])
    return rows.withColumns(
        {
            **{c: n(c) for c in counts},
            "score_popularidad": money(n("score_popularidad")),
            "score_actividad": money(sum((n(c) for c in counts[2:]), n(counts[1]))),
            "score_comunidad": money(F.when(talk, n(counts[0]) + n(counts[1])).otherwise(0)),
            "score_adopcion": money(n("indice_adopcion")),
            "score_innovacion": money(n("indice_innovacion")),
            "valor_numerico_normalizado": first.cast("decimal(12,6)"),
        }
    )


def lineage(record_id: Column, parts: Sequence[Column]) -> Column:
    """`raw:<id>` of a landed record, else a digest of the joined key parts."""
    joined = F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.when(record_id.isNotNull(), F.concat(F.lit("raw:"), record_id.cast("string"))).otherwise(F.concat(F.lit("legacy:"), F.md5(joined)))


def in_profile(source: Column, active: Sequence[str], profile: str = "all") -> Column:
    """Rows of active sources that a profile loads: all, main (all but the code host) or one source by name."""
    wanted = F.lit(True) if profile == "all" else F.coalesce(source, F.lit("")) != "github" if profile == "main" else source == profile
    if profile not in ("all", "main", *active):
        raise ValueError(f"unknown profile {profile}")
    return source.isin(*active) & wanted


def source_dimension(rows: DataFrame) -> DataFrame:
    """Sources with their type, which is their category too; nothing tells how reliable they are."""
    by = rows.filter("fuente is not null").select(default_member(F.col("fuente"), UNKNOWN).alias("nombre_fuente"), default_member(F.col("tipo_fuente"), UNKNOWN).alias("tipo_fuente")).distinct()
    return by.withColumns({"categoria_fuente": F.col("tipo_fuente"), "confiabilidad_fuente": F.lit(UNKNOWN)})


#: Dimension columns of staging, by the dimension's own names; the natural key comes first.
PLATFORM = {"nombre_plataforma": "dim_nombre_plataforma", "tipo_plataforma": "dim_tipo_plataforma", "ecosistema": "dim_ecosistema"}
TECHNOLOGY = {
    "nombre_tecnologia": "dim_nombre_tecnologia", "categoria_tecnologia": "dim_categoria_tecnologia",
    "dominio_tecnologico": "dim_dominio_tecnologico", "tipo_senal": "dim_tipo_senal",
}
COMMUNITY = {
    "nombre_comunidad": "dim_nombre_comunidad", "tipo_comunidad": "dim_tipo_comunidad",
    "plataforma_comunidad": "dim_nombre_plataforma", "region": "dim_region_comunidad",
}
_VERSION = ("fecha_evento", "raw_file_id", "raw_record_id")


def _of_newest(rows: DataFrame, columns: Mapping[str, str], natural: int) -> DataFrame:
    """Members by their natural key (the first columns), blanks under the default members, attributes of the newest row."""
    names = list(columns)
    known = rows.filter(F.col(columns[names[0]]).isNotNull())
    clean = known.select(*_VERSION, *[default_member(F.col(c), UNDETERMINED[c]).alias(n) for n, c in columns.items()])
    return latest_attributes(clean, names[:natural], names[natural:], _VERSION)


def platform_dimension(rows: DataFrame) -> DataFrame:
    return _of_newest(rows, PLATFORM, 1)


def technology_dimension(rows: DataFrame) -> DataFrame:
    return _of_newest(rows, TECHNOLOGY, 2)


def community_dimension(rows: DataFrame) -> DataFrame:
    return _of_newest(rows, COMMUNITY, 3)


#: Natural key and surrogate key of each dimension.
DIMENSIONS = {
    "tiempo": (("fecha",), "id_tiempo"),
    "agente": (("nombre_agente",), "id_agente"),
    "fuente": (("nombre_fuente", "tipo_fuente"), "id_fuente"),
    "plataforma": (("nombre_plataforma",), "id_plataforma"),
    "tecnologia": (("nombre_tecnologia", "categoria_tecnologia"), "id_tecnologia"),
    "comunidad": (("nombre_comunidad", "tipo_comunidad", "plataforma_comunidad"), "id_comunidad"),
}
#: Columns that a row must have to become a fact.
REQUIRED = ("id_origen_registro", "fecha_evento", "nombre_agente", "fuente", "tipo_fuente", "plataforma", "categoria", "dim_nombre_plataforma", "dim_nombre_tecnologia", "dim_nombre_comunidad")
#: A fact is one record of one source about one agent on one platform.
GRAIN = ("id_agente", "id_fuente", "id_plataforma", "id_origen_registro")


def dimensions(rows: DataFrame, old: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The six dimensions with stable surrogate keys, from staging rows and the dimensions of the last load."""
    made = {
        "tiempo": time_dimension(rows, "fecha_evento"),
        "agente": agent_dimension(rows, "nombre_agente"),
        "fuente": source_dimension(rows),
        "plataforma": platform_dimension(rows),
        "tecnologia": technology_dimension(rows),
        "comunidad": community_dimension(rows),
    }
    out = {}
    for name, new in made.items():
        natural, key = DIMENSIONS[name]
        out[name] = keep(rows.sparkSession, with_surrogate_keys(new, (old or {}).get(name), list(natural), key), name)
    return out


def with_keys(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Staging rows with the surrogate keys of the six dimensions, found by their natural keys; rows without a member are left out."""
    member = lambda c: default_member(F.col(c), UNDETERMINED[c])
    natural = {
        "tiempo": [F.col("fecha_evento")],
        "agente": [default_member(F.col("nombre_agente"), UNKNOWN)],
        "fuente": [default_member(F.col("fuente"), UNKNOWN), default_member(F.col("tipo_fuente"), UNKNOWN)],
        "plataforma": [member("dim_nombre_plataforma")],
        "tecnologia": [member("dim_nombre_tecnologia"), member("dim_categoria_tecnologia")],
        "comunidad": [member("dim_nombre_comunidad"), member("dim_tipo_comunidad"), member("dim_nombre_plataforma")],
    }
    out = rows
    for name, columns in natural.items():
        keys, surrogate = DIMENSIONS[name]
        dim = dims[name].select(*[F.col(k).alias(f"{name}_{i}_") for i, k in enumerate(keys)], surrogate)
        on = F.lit(True)
        for i, c in enumerate(columns):
            on = on & (c == F.col(f"{name}_{i}_"))
        out = out.join(dim, on).drop(*[f"{name}_{i}_" for i in range(len(keys))])
    return out


#: Measures and attributes of a fact.
_FACT = (
    "cantidad_menciones", "cantidad_interacciones", "score_popularidad", "score_actividad", "score_comunidad", "score_adopcion", "score_innovacion",
    "valor_numerico_normalizado", "stars_github", "forks_github", "issues_abiertos", "releases", "sentimiento_promedio", "titulo", "url", "is_imputed_date",
)


def facts(rows: DataFrame, dims: Mapping[str, DataFrame], old: DataFrame | None = None) -> DataFrame:
    """The fact table: eligible staging rows on their surrogate keys, upserted on the grain of the last load.

    Of several rows of one grain the newest snapshot counts.
    """
    keyed = with_keys(fact_scores(eligible(rows, REQUIRED)), dims)
    line = lineage(F.col("raw_record_id"), [F.col(c) for c in ("fuente", "plataforma", "id_origen_registro", "nombre_agente")])
    columns = [*[k for _, k in DIMENSIONS.values()], "id_origen_registro", "raw_file_id", "raw_record_id"]
    new = keyed.select(*columns, line.alias("fact_lineage_key"), *_FACT, F.col("fecha_evento").alias("version_"))
    version = ["version_", *_VERSION[1:]]
    old = None if old is None else old.withColumn("version_", F.lit(None).cast("date"))
    return upsert_fact(new, old, list(GRAIN), "id_hecho", "fact_lineage_key", version, rows.count()).drop("version_")


def load(rows: DataFrame | Sequence[DataFrame], old_dims: Mapping[str, DataFrame] | None = None, old_facts: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """One load of the star schema: dimensions first, then facts on their keys.

    The staging rows, a frame or parts of one that are made one after the
    other, are made once, and so is each result. A load ends only if every fact
    has a grain and a key of its own.
    """
    parts = [rows] if isinstance(rows, DataFrame) else list(rows)
    spark = parts[0].sparkSession
    rows = keep_parts(spark, parts, "staging")
    dims = dimensions(rows, old_dims)
    made = facts(rows, dims, old_facts)  # new facts were written when they got their numbers
    made = made if old_facts is None else keep_parts(spark, [made], "facts")
    forget(spark, rows)
    return dims, unique(unique(made, GRAIN), ["id_hecho"])


def eligible(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that may become facts: none of the columns is null."""
    return rows.dropna(subset=list(columns))


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Facts whose key the dimension does not know."""
    return fact.join(dim.select(key), key, "left_anti")
