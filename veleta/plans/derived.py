"""Derived analytics of aggregated reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.operators.measures import change, moving_average, share, top_and_others
from veleta.operators.quantiles import medians
from veleta.plans import kpi
from veleta.plans.kpi import by_month

MONTH = ["anio", "mes"]


def trend(act: DataFrame) -> DataFrame:
    rows = change(by_month(act), "total_observaciones", MONTH).withColumn("media_movil", moving_average("total_observaciones", MONTH))
    return rows.select("anio", "mes", "total_observaciones", "media_movil", F.col("percent_").alias("variacion_porcentual"))


def leader(act: DataFrame) -> DataFrame:
    """One row: leader, runner-up, their gap in percent, and the agent with most interactions an observation."""
    by = act.groupBy("nombre_agente").agg(kpi.rows(), F.sum("cantidad_interacciones").alias("i_"))
    ranked = by.withColumn("rn_", F.row_number().over(W.orderBy(F.desc("total_observaciones"), "nombre_agente")))
    at = lambda c, i: F.max(F.when(F.col("rn_") == i, F.col(c)))
    first, second = at("total_observaciones", 1), at("total_observaciones", 2)
    intensity = F.struct((F.col("i_") / F.col("total_observaciones")).alias("v"), F.col("nombre_agente").alias("n"))
    return ranked.agg(
        at("nombre_agente", 1).alias("lider"),
        at("nombre_agente", 2).alias("segundo"),
        F.round((first - second) * 100.0 / F.nullif(second, F.lit(0)), 2).alias("brecha_pct"),
        F.max_by("nombre_agente", intensity).alias("lider_intensidad"),
    )


def executive(act: DataFrame) -> DataFrame:
    """One row by adoption: leader, runner-up, their gap in percent, growth of the last month, and the agent with most adoption an observation."""
    by = act.groupBy("nombre_agente").agg(F.sum("score_adopcion").cast("double").alias("a_"), F.count(F.lit(1)).alias("n_"))
    ranked = by.withColumn("rn_", F.row_number().over(W.orderBy(F.desc("a_"), "nombre_agente")))
    at = lambda c, i: F.max(F.when(F.col("rn_") == i, F.col(c)))
    first, second = at("a_", 1), at("a_", 2)
    one = ranked.agg(
        at("nombre_agente", 1).alias("lider"),
        at("nombre_agente", 2).alias("segundo"),
        F.round((first - second) * 100.0 / F.greatest(second, F.lit(1.0)), 2).alias("brecha_pct"),
        F.max_by("nombre_agente", F.struct((F.col("a_") / F.col("n_")).alias("v"), "nombre_agente")).alias("lider_intensidad"),
    )
    months = act.groupBy(F.year("fecha_evento").alias("anio"), F.month("fecha_evento").alias("mes")).agg(F.sum("score_adopcion").cast("double").alias("m_"))
    last = months.withColumn("p_", F.lag("m_").over(W.orderBy("anio", "mes"))).agg(F.max_by(F.struct("m_", "p_"), F.struct("anio", "mes")).alias("l_"))
    growth = F.round((F.col("l_.m_") - F.col("l_.p_")) * 100.0 / F.nullif(F.col("l_.p_"), F.lit(0.0)), 2)
    return one.join(last.select(growth.alias("crecimiento_mensual_pct")))


def top_sources(act: DataFrame, most: int = 7, without_type: str | None = None) -> DataFrame:
    """Sources with the greatest share of the observations, of all or of all but one type."""
    rows = act if without_type is None else act.filter(~F.col("tipo_fuente").eqNullSafe(F.lit(without_type)))
    by = rows.groupBy("nombre_fuente").agg(kpi.rows()).withColumn("participacion", share("total_observaciones"))
    return by.orderBy(F.desc("total_observaciones"), "nombre_fuente").limit(most)


def top_popularity(act: DataFrame, most: int = 10) -> DataFrame:
    by = act.groupBy("nombre_agente").agg(F.sum("score_popularidad").cast("double").alias("s_"))
    return by.select("nombre_agente", F.round("s_", 4).alias("popularidad")).orderBy(F.desc("popularidad"), "nombre_agente").limit(most)


def valid_scores(points: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose scores are finite numbers of at least 0, scores as doubles."""
    rows = points
    for c in columns:
        rows = rows.withColumn(c, F.expr(f"try_cast(nullif(trim(cast(`{c}` as string)), '') as double)"))
    ok = F.lit(True)
    for c in columns:
        v = F.col(c)
        ok = ok & v.isNotNull() & ~F.isnan(v) & (v >= 0) & (v != F.lit(float("inf")))
    return rows.filter(ok)


def quadrants(points: DataFrame, label: str = "nombre_agente", x: str = "adopcion", y: str = "popularidad", volume: str = "total_observaciones") -> DataFrame:
    """Quadrant of each point by the medians of both scores, and logarithmic places."""
    rows = valid_scores(points.filter(F.col(label).isNotNull() & (F.col(label) != "")), [x, y])
    middle = medians(rows, [x, y])
    size = F.coalesce(F.expr(f"try_cast(`{volume}` as double)"), F.lit(0.0))
    size = F.when(F.isnan(size) | (F.abs(size) == float("inf")) | (size < 0), 0.0).otherwise(size)
    high_x, high_y = F.col(x) >= F.lit(middle[x]), F.col(y) >= F.lit(middle[y])
    name = F.when(high_x & high_y, "lideres").when(high_y, "populares").when(high_x, "adoptados").otherwise("emergentes")
    return rows.select(
        label,
        x,
        y,
        name.alias("cuadrante"),
        F.round(F.log10(1 + F.col(x)), 6).alias("x_log"),
        F.round(F.log10(1 + F.col(y)), 6).alias("y_log"),
        F.round(F.log1p(size), 6).alias("volumen_log"),
        F.row_number().over(W.orderBy(F.desc(x), label)).alias("marcador"),
    )


def omitted(points: DataFrame, label: str = "nombre_agente", x: str = "adopcion", y: str = "popularidad") -> DataFrame:
    """One row: how many points `quadrants` leaves out, nameless ones and those without valid scores."""
    kept = valid_scores(points.filter(F.col(label).isNotNull() & (F.col(label) != "")), [x, y]).agg(F.count(F.lit(1)).alias("kept_"))
    return points.agg(F.count(F.lit(1)).alias("all_")).join(kept).select((F.col("all_") - F.col("kept_")).alias("omitidos"))


def agent_points(act: DataFrame) -> DataFrame:
    return act.groupBy("nombre_agente").agg(
        F.round(F.sum("score_adopcion").cast("double"), 4).alias("adopcion"),
        F.round(F.sum("score_popularidad").cast("double"), 4).alias("popularidad"),
        F.count(F.lit(1)).cast("double").alias("total_observaciones"),
    )


def heat_map(act: DataFrame, months: int = 18) -> DataFrame:
    """Agent x month cells of the last months, with each agent's total and the row's and overall maximum."""
    cells = act.groupBy("nombre_agente", F.year("fecha_evento").alias("anio"), F.month("fecha_evento").alias("mes")).agg(kpi.rows())
    recent = cells.withColumn("r_", F.dense_rank().over(W.orderBy(F.desc("anio"), F.desc("mes")))).filter(F.col("r_") <= months).drop("r_")
    agent = W.partitionBy("nombre_agente")
    return (
        recent.withColumn("total_agente", F.sum("total_observaciones").over(agent))
        .withColumn("maximo_agente", F.max("total_observaciones").over(agent))
        .withColumn("maximo_global", F.max("total_observaciones").over(W.partitionBy()))
    )


def heat_map_top(act: DataFrame, months: int = 18, most: int = 20) -> DataFrame:
    """Adoption by agent and month, of the last months and the agents with most adoption in them."""
    cells = act.groupBy("nombre_agente", F.year("fecha_evento").alias("anio"), F.month("fecha_evento").alias("mes")).agg(F.sum("score_adopcion").alias("a_"))
    recent = cells.withColumn("r_", F.dense_rank().over(W.orderBy(F.desc("anio"), F.desc("mes")))).filter(F.col("r_") <= months)
    agents = recent.groupBy("nombre_agente").agg(F.sum("a_").alias("t_")).orderBy(F.desc("t_"), "nombre_agente").limit(most)
    return recent.join(agents.select("nombre_agente"), "nombre_agente").select("nombre_agente", "anio", "mes", F.round(F.col("a_").cast("double"), 4).alias("adopcion"))


def category_others(act: DataFrame, most: int = 6) -> DataFrame:
    by = act.groupBy("categoria_agente").agg(kpi.rows())
    return top_and_others(by, "categoria_agente", "total_observaciones", most).withColumn("porcentaje", share("total_observaciones"))


def top_variations(act: DataFrame, most: int = 3) -> DataFrame:
    rows = change(by_month(act), "total_observaciones", MONTH).filter("percent_ is not null")
    return rows.select("anio", "mes", F.col("percent_").alias("variacion_porcentual")).orderBy(F.desc(F.abs("variacion_porcentual")), "anio", "mes").limit(most)


def insights(act: DataFrame) -> DataFrame:
    """One row: peak month, top source and top agent; ties take the later month and the greater name."""
    month = by_month(act).agg(F.max_by(F.concat_ws("-", "anio", F.lpad(F.col("mes").cast("string"), 2, "0")), F.struct("total_observaciones", "anio", "mes")).alias("mes_pico"))
    top = lambda c, name: act.groupBy(c).agg(kpi.rows()).agg(F.max_by(c, F.struct("total_observaciones", c)).alias(name))
    return month.join(top("nombre_fuente", "fuente_principal")).join(top("nombre_agente", "agente_principal"))


def last_complete_month(act: DataFrame, as_of: str) -> DataFrame:
    """The latest month of the data; the month of `as_of` counts only from day 25 on."""
    day = F.lit(as_of).cast("date")
    current = (F.col("anio") == F.year(day)) & (F.col("mes") == F.month(day)) & (F.dayofmonth(day) < 25)
    ahead = F.make_date(F.col("anio"), F.col("mes"), F.lit(1)) > day
    rows = by_month(act).filter(~current & ~ahead)
    return rows.select("anio", "mes", "total_observaciones").orderBy(F.desc("anio"), F.desc("mes")).limit(1)


def totals(act: DataFrame) -> DataFrame:
    return act.agg(kpi.rows(), F.round(F.sum("score_adopcion").cast("double"), 4).alias("adopcion_total"), F.sum("cantidad_menciones").alias("total_menciones"))
