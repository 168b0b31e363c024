"""Staging: landed records of all sources to classified, de-duplicated observations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta import contracts
from veleta.functions.cleaning import clamped, dated
from veleta.operators.keys import SNAPSHOT_KEY, snapshot_dedup
from veleta.operators.rules import OTHER_AGENT, category, detect_agent, enrich
from veleta.sources.mappers import normalize
from veleta.sources.raw import parsed

#: Accepted confidence of cached semantic answers.
CONFIDENT = 0.85
#: Sources with free text, whose records may be enriched by cached answers.
UNSTRUCTURED = ("devto", "hackernews", "reddit", "stackoverflow", "gnews")


def normalized(records: DataFrame, schemas: Mapping[str, str]) -> DataFrame:
    """Observations of all sources: one projection for each source, not for each file."""
    parts = [normalize(parsed(records.filter(F.col("fuente") == s), schema), s) for s, schema in schemas.items()]
    return reduce(DataFrame.unionByName, parts)


def candidates(rows: DataFrame) -> DataFrame:
    """Dates, agents, category and semantic dimensions of observations, those without a known agent included."""
    rows = dated(rows)
    rows = rows.withColumn("nombre_agente", detect_agent(F.col("agente"), F.col("titulo"), F.col("texto")))
    rows = rows.withColumn("categoria", category(F.col("fuente"), F.col("stars_github")))
    return clamped(enrich(rows), contracts.WIDTHS)


def classified(rows: DataFrame) -> DataFrame:
    """Candidates with a known agent; the others are noise."""
    return candidates(rows).filter(F.col("nombre_agente") != OTHER_AGENT)


def replayed(records: DataFrame, schemas: Mapping[str, str]) -> DataFrame:
    """Candidates of raw records as they would be staged, without loading them and without cached answers; missing key parts are 'N/A'."""
    rows = candidates(normalized(records, schemas))
    return rows.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("N/A")) for k in SNAPSHOT_KEY})


def for_enrichment(rows: DataFrame) -> DataFrame:
    """Rows that cached answers may enrich: free text that is there, blank or not, of an unstructured source."""
    return rows.filter(F.col("fuente").isin(*UNSTRUCTURED) & (F.col("texto") != ""))


def staged(records: DataFrame, schemas: Mapping[str, str]) -> DataFrame:
    rows = snapshot_dedup(classified(normalized(records, schemas)))
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in contracts.STAGING.items()])


def with_cached_answers(rows: DataFrame, answers: DataFrame, text: str = "texto") -> DataFrame:
    """Cached answers joined by the digest of the text's first 1000 characters (the key of the cache).

    Confidence is always kept; the answers only count from `CONFIDENT` on.
    """
    keyed = rows.withColumn("key_", F.md5(F.substring(F.coalesce(F.col(text), F.lit("")), 1, 1000)))
    joined = keyed.join(answers.withColumnRenamed("clave", "key_"), "key_", "left").drop("key_")
    sure = F.col("confianza") >= CONFIDENT
    return joined.withColumns(
        {
            "llm_confianza": F.coalesce("confianza", F.lit(0.0)),
            "llm_entorno_uso": F.when(sure, F.col("entorno")),
            "llm_tipo_integracion": F.when(sure, F.col("integracion")),
            "llm_capacidades": F.when(sure, F.array_join("capacidades", ", ")),
            "llm_tecnologia": F.when(sure, F.get("tecnologias", F.lit(0))),
        }
    ).drop("confianza", "entorno", "integracion", "capacidades", "tecnologias")


def answer_report(answers: DataFrame) -> DataFrame:
    """Share of valid answers, mean seconds, share of certain answers with evidence."""
    pct = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)) * 100, 2)
    return answers.agg(
        pct(F.col("valido")).alias("pct_valido"),
        F.round(F.avg("segundos"), 2).alias("segundos_media"),
        pct((F.col("confianza") >= CONFIDENT) & F.col("con_evidencia")).alias("pct_aceptado"),
    )


def semantic_gate(rows: DataFrame) -> None:
    """Stop before the star schema while staging rows lack a dimension."""
    lacking = rows.filter("dim_nombre_plataforma is null or dim_nombre_tecnologia is null or dim_nombre_comunidad is null")
    if lacking.limit(1).count():
        raise ValueError("staging rows lack semantic dimensions")
