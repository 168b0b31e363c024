"""Filtered reports: one filter builder, many groupings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.operators.measures import change, mean, share, with_distinct_counts
from veleta.plans import kpi
from veleta.plans.kpi import total


@dataclass(frozen=True)
class Filters:
    """User filters; a field that is not set does not filter."""

    start: str | None = None
    end: str | None = None
    agents: tuple[str, ...] = ()
    category: str | None = None
    source: str | None = None
    platform: str | None = None
    technology: str | None = None
    exclude: tuple[str, ...] = ()  # unidentified agents
    without_type: str | None = None  # a type of source that is left out
    scope: tuple[str, ...] = ()  # active sources; holds whatever the user asks for

    def condition(self) -> Column:
        found = F.lit(True)
        if self.start:
            found = found & (F.col("fecha_evento") >= F.lit(self.start).cast("date"))
        if self.end:
            found = found & (F.col("fecha_evento") <= F.lit(self.end).cast("date"))
        if self.agents:
            found = found & F.col("nombre_agente").isin(*self.agents)
        for column, value in (("categoria_agente", self.category), ("nombre_plataforma", self.platform), ("nombre_tecnologia", self.technology)):
            if value:
                found = found & (F.col(column) == value)
        if self.source:
            found = found & (F.lower("nombre_fuente") == self.source.lower())
        if self.without_type:
            found = found & (F.col("tipo_fuente") != self.without_type)
        if self.exclude:
            found = found & ~F.col("nombre_agente").isin(*self.exclude)
        if self.scope:
            found = found & F.col("nombre_fuente").isin(*self.scope)
        return found


def _rows(act: DataFrame, filters: Filters) -> DataFrame:
    return act.filter(filters.condition())


def prefer_annual(rows: DataFrame, id_col: str, source_col: str, source: str) -> DataFrame:
    """Rows of `source` without a year in their identifier stay only where none has one."""
    annual = rows.filter((F.col(source_col) == source) & F.col(id_col).like("%:year:%")).select(F.lit(True).alias("annual_")).limit(1)
    legacy = (F.col(source_col) == source) & ~F.col(id_col).like("%:year:%")
    return rows.join(annual, F.lit(True), "left").filter(~(legacy & F.col("annual_").isNotNull())).drop("annual_")


def adoption(act: DataFrame, f: Filters) -> DataFrame:
    return _rows(act, f).groupBy("nombre_agente").agg(kpi.rows(), kpi.mentions(), mean("score_adopcion").alias("promedio_adopcion"))


def source_share(act: DataFrame, f: Filters) -> DataFrame:
    return _rows(act, f).groupBy("nombre_fuente").agg(kpi.rows()).withColumn("porcentaje", share("total_observaciones"))


def trend_with_mode(act: DataFrame, f: Filters) -> DataFrame:
    """Months with the predominant source; ties take the smallest name."""
    rows = _rows(act, f).withColumn("anio", F.year("fecha_evento")).withColumn("mes", F.month("fecha_evento"))
    return rows.groupBy("anio", "mes").agg(kpi.rows(), kpi.interactions(), F.mode("nombre_fuente", True).alias("fuente_predominante"))


def agent_months(act: DataFrame, f: Filters) -> DataFrame:
    rows = _rows(act, f).withColumn("anio", F.year("fecha_evento")).withColumn("mes", F.month("fecha_evento"))
    return rows.groupBy("nombre_agente", "anio", "mes").agg(kpi.rows(), total("score_actividad", "score_actividad_total"))


#: Columns that a ranking may be sorted by.
SORTABLE = ("total_observaciones", "score_adopcion_total", "score_actividad_total", "total_menciones")


def ranking_page(act: DataFrame, f: Filters, sort_by: str, descending: bool = True, limit: int = 20, offset: int = 0) -> DataFrame:
    if sort_by not in SORTABLE:
        raise ValueError(f"not sortable: {sort_by}")
    members = {"fuentes": "nombre_fuente", "meses": F.date_format("fecha_evento", "yyyy-MM")}
    sums = [("total_observaciones", F.count(F.lit(1)), "sum"), ("total_menciones", F.sum("cantidad_menciones"), "sum")]
    sums += [(f"{c}_total", F.sum(c), "sum") for c in ("score_adopcion", "score_actividad")]
    by = with_distinct_counts(_rows(act, f), ["nombre_agente"], members, sums)
    by = by.withColumns({f"{c}_total": F.round(F.col(f"{c}_total").cast("double"), 4) for c in ("score_adopcion", "score_actividad")})
    key = F.desc(sort_by) if descending else F.asc(sort_by)
    return by.withColumn("ranking", F.rank().over(W.orderBy(key))).orderBy("ranking", "nombre_agente").offset(offset).limit(limit)


def coverage_matrix(act: DataFrame, f: Filters) -> DataFrame:
    return _rows(act, f).groupBy("nombre_agente", "nombre_fuente").agg(kpi.rows())


def coverage_matrix_wide(act: DataFrame, f: Filters, sources: list[str]) -> DataFrame:
    wide = _rows(act, f).groupBy("nombre_agente").pivot("nombre_fuente", sources).agg(F.count(F.lit(1)))
    return wide.select("nombre_agente", *[F.coalesce(F.col(f"`{s}`"), F.lit(0)).alias(f"s{i + 1}") for i, s in enumerate(sources)])


def popularity_top(act: DataFrame, f: Filters, sources: list[str], platforms: list[str], most: int = 20) -> DataFrame:
    rows = _rows(act, f).filter(F.col("nombre_fuente").isin(sources) | F.col("nombre_plataforma").isin(platforms))
    by = rows.groupBy("nombre_agente", "nombre_plataforma").agg(kpi.rows(), total("score_actividad", "score_actividad_total"))
    return by.orderBy(F.desc("score_actividad_total"), "nombre_agente", "nombre_plataforma").limit(most)


def growth(act: DataFrame, f: Filters) -> DataFrame:
    rows = _rows(act, f).withColumn("anio", F.year("fecha_evento")).withColumn("mes", F.month("fecha_evento")).groupBy("anio", "mes").agg(kpi.rows())
    return change(rows, "total_observaciones", ["anio", "mes"]).select(
        "anio", "mes", "total_observaciones", F.col("absolute_").alias("variacion_absoluta"), F.col("percent_").alias("variacion_porcentual")
    )


def distribution(act: DataFrame, f: Filters) -> DataFrame:
    return _rows(act, f).groupBy("nombre_plataforma").agg(kpi.rows(), kpi.mentions()).withColumn("porcentaje", share("total_observaciones"))


def by_category(act: DataFrame, f: Filters) -> DataFrame:
    return _rows(act, f).groupBy("categoria_agente").agg(kpi.rows(), F.count_distinct("nombre_agente").alias("agentes"), mean("score_adopcion").alias("promedio_adopcion"))


def by_domain(act: DataFrame, f: Filters) -> DataFrame:
    return _rows(act, f).groupBy("categoria_tecnologia").agg(kpi.rows(), mean("score_adopcion").alias("promedio_adopcion"))


def options(act: DataFrame, f: Filters) -> DataFrame:
    """Distinct values that filters can take: (option, value), from one pass over the rows."""
    pairs = F.explode(
        F.array(
            F.struct(F.lit("categoria").alias("option"), F.col("categoria_agente").alias("value")),
            F.struct(F.lit("plataforma").alias("option"), F.col("nombre_plataforma").alias("value")),
            F.struct(F.lit("tecnologia").alias("option"), F.col("nombre_tecnologia").alias("value")),
        )
    )
    return _rows(act, f).select(pairs.alias("o")).select("o.option", "o.value").distinct()
