"""KPI queries over activity rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.operators.measures import change, mean, share, with_distinct_counts
from veleta.plans.gold import MONTHS


def rows():
    return F.count(F.lit(1)).alias("total_observaciones")


def mentions():
    return F.sum("cantidad_menciones").alias("total_menciones")


def interactions():
    return F.sum("cantidad_interacciones").alias("total_interacciones")


def total(column: str, name: str):
    return F.round(F.sum(column).cast("double"), 4).alias(name)


def adoption(act: DataFrame) -> DataFrame:
    return act.groupBy("nombre_agente", "categoria_agente").agg(
        rows(), mentions(), interactions(), mean("score_adopcion").alias("promedio_score_adopcion"), total("score_adopcion", "score_adopcion_total")
    )


def source_share(act: DataFrame) -> DataFrame:
    by = act.groupBy("nombre_fuente", "tipo_fuente").agg(rows(), mentions(), interactions())
    return by.withColumn("porcentaje_participacion", share("total_observaciones"))


def by_month(act: DataFrame) -> DataFrame:
    months = act.withColumn("anio", F.year("fecha_evento")).withColumn("mes", F.month("fecha_evento"))
    return months.groupBy("anio", "mes").agg(
        rows(),
        mentions(),
        interactions(),
        total("score_actividad", "score_actividad_total"),
        mean("score_popularidad").alias("promedio_popularidad"),
        mean("score_adopcion").alias("promedio_adopcion"),
    )


def agent_ranking(act: DataFrame) -> DataFrame:
    scores = F.col("score_actividad") + F.col("score_popularidad") + F.col("score_adopcion")
    by = act.withColumn("s_", scores).groupBy("nombre_agente").agg(rows(), F.sum("s_").alias("s_"))
    return by.select(
        "nombre_agente",
        "total_observaciones",
        F.round(F.col("s_").cast("double"), 4).alias("score_total_relevancia"),
        F.rank().over(W.orderBy(F.desc("s_"))).alias("ranking_agente"),
        F.dense_rank().over(W.orderBy(F.desc("total_observaciones"))).alias("ranking_por_observaciones"),
    )


def open_source_popularity(act: DataFrame, sources: list[str], platforms: list[str]) -> DataFrame:
    kept = act.filter(F.col("nombre_fuente").isin(sources) | F.col("nombre_plataforma").isin(platforms))
    return kept.groupBy("nombre_agente", "nombre_fuente", "nombre_plataforma").agg(
        rows(), interactions(), mean("score_popularidad").alias("promedio_score_popularidad"), total("score_actividad", "score_actividad_total")
    )


def monthly_growth(act: DataFrame) -> DataFrame:
    months = change(by_month(act), "total_observaciones", ["anio", "mes"])
    return months.select(
        "anio",
        "mes",
        "total_observaciones",
        F.col("previous_").alias("observaciones_mes_anterior"),
        F.col("absolute_").alias("variacion_absoluta"),
        F.col("percent_").alias("variacion_porcentual"),
        "total_menciones",
        "total_interacciones",
        "score_actividad_total",
    )


def platform_distribution(act: DataFrame) -> DataFrame:
    by = act.groupBy("nombre_plataforma", "tipo_plataforma").agg(rows(), mentions(), interactions(), mean("score_popularidad").alias("promedio_popularidad"))
    return by.withColumn("porcentaje_distribucion", share("total_observaciones")).withColumn(
        "ranking_plataforma", F.dense_rank().over(W.orderBy(F.desc("total_observaciones")))
    )


def overall(act: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """One row over a range of years."""
    kept = act.filter(F.year("fecha_evento").between(first_year, last_year))
    members = {"agentes": "nombre_agente", "fuentes": "nombre_fuente", "plataformas": "nombre_plataforma"}
    sums = [
        ("total_observaciones", F.count(F.lit(1)), "sum"),
        ("total_menciones", F.sum("cantidad_menciones"), "sum"),
        ("adopcion_", F.sum("score_adopcion"), "sum"),
        ("adopciones_", F.count("score_adopcion"), "sum"),
        ("primera_fecha", F.min("fecha_evento"), "min"),
        ("ultima_fecha", F.max("fecha_evento"), "max"),
    ]
    one = with_distinct_counts(kept, [], members, sums)
    one = one.withColumn("total_observaciones", F.coalesce("total_observaciones", F.lit(0)))
    return one.withColumn("promedio_adopcion", F.round(F.col("adopcion_").cast("double") / F.col("adopciones_"), 4)).drop("adopcion_", "adopciones_")


def top_agents(act: DataFrame, most: int = 10) -> DataFrame:
    by = act.groupBy("nombre_agente").agg(rows(), mentions(), total("score_adopcion", "score_adopcion_total"))
    w = W.orderBy(F.desc("score_adopcion_total"), F.desc("total_observaciones"))
    ranked = by.withColumn("ranking", F.rank().over(w))
    return ranked.orderBy("ranking", "nombre_agente").limit(most)


def source_activity_share(act: DataFrame) -> DataFrame:
    by = act.groupBy("nombre_fuente").agg(rows(), F.sum("score_actividad").cast("double").alias("a_"))
    return by.select(
        "nombre_fuente",
        "total_observaciones",
        share("total_observaciones").alias("porcentaje_observaciones"),
        F.round(F.col("a_") * 100.0 / F.sum("a_").over(W.partitionBy()), 2).alias("porcentaje_actividad"),
    )


def community_rank(act: DataFrame) -> DataFrame:
    by = act.groupBy("nombre_plataforma", "nombre_comunidad").agg(rows(), F.count_distinct("nombre_agente").alias("agentes"))
    return by.withColumn("ranking", F.dense_rank().over(W.orderBy(F.desc("total_observaciones"))))


def technology_share(act: DataFrame) -> DataFrame:
    by = act.groupBy("nombre_tecnologia", "categoria_tecnologia").agg(rows(), F.count_distinct("nombre_agente").alias("agentes"), mentions())
    return by.withColumn("porcentaje", share("total_observaciones"))


def monthly_adoption(act: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Adoption of each month, of the month before, and its change."""
    months = act.filter(F.year("fecha_evento").between(first_year, last_year)).withColumns({"anio": F.year("fecha_evento"), "mes": F.month("fecha_evento")})
    by = months.groupBy("anio", "mes").agg(
        rows(), mentions(), interactions(), mean("score_adopcion").alias("promedio_score_adopcion"), F.sum("score_adopcion").alias("s_")
    )
    before = F.lag("s_").over(W.orderBy("anio", "mes"))
    by = by.withColumn("p_", before)
    number = lambda c: F.round(c.cast("double"), 4)
    return by.select(
        "anio",
        "mes",
        F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.col("mes")).alias("nombre_mes"),
        "total_observaciones",
        "total_menciones",
        "total_interacciones",
        "promedio_score_adopcion",
        number(F.col("s_")).alias("score_adopcion_total"),
        number(F.col("p_")).alias("score_adopcion_mes_anterior"),
        number(F.col("s_") - F.coalesce("p_", F.lit(0))).alias("variacion_absoluta_adopcion"),
        F.round((F.col("s_") - F.col("p_")).cast("double") * 100.0 / F.nullif(F.col("p_").cast("double"), F.lit(0.0)), 2).alias("variacion_porcentual_adopcion"),
    )
