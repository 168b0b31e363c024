"""Connected components of an undirected edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veleta.llm.shared import forget, keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect neighbours of every vertex u to the smallest vertex m around it.

    Large star: neighbours above u. Small star: u and its neighbours below u.
    """
    if large:
        around = edges.select(F.col("u"), F.col("v")).unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m_")).select("u", F.least("u", "m_").alias("m"))
    joined = around.join(least, "u")
    if large:
        made = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return made.filter("u <> v").distinct()


def _open(edges: DataFrame) -> bool:
    """Whether some vertex has several edges down, or is both above and below; else every vertex has one edge, to its component."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    by = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return by.filter("down > 1 or down > 0 and up > 0").limit(1).count() > 0


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """vertex, component (the smallest vertex reachable) for every vertex of `edges` (u, v)."""
    edges = keep(spark, edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while _open(edges):
        before, edges = edges, keep(spark, _star(_star(edges, True), False), "edges")
        forget(spark, before)
    found = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return found.unionByName(roots)
