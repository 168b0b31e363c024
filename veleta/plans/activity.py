"""The activity view: one wide row per observed activity, from the sales tables.

The sales tables stand for observations by the roles of their columns; every
report takes such a frame, whatever tables it comes from.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables beside `lineitem`, each with the table that it is reached through, its join, and its columns of the view.
_JOINS = {
    "orders": (None, ("l_orderkey", "o_orderkey")),
    "part": (None, ("l_partkey", "p_partkey")),
    "customer": ("orders", ("o_custkey", "c_custkey")),
    "nation": ("customer", ("c_nationkey", "n_nationkey")),
    "region": ("nation", ("n_regionkey", "r_regionkey")),
}
_VIEW = {
    "fecha_evento": ("orders", "to_date(o_orderdate)"),
    "nombre_agente": ("part", "p_brand"),
    "categoria_agente": ("part", "p_type"),
    "nombre_fuente": ("orders", "o_orderpriority"),
    "tipo_fuente": ("orders", "o_orderstatus"),
    "nombre_plataforma": ("region", "r_name"),
    "tipo_plataforma": ("nation", "n_name"),
    "nombre_tecnologia": (None, "l_returnflag"),
    "categoria_tecnologia": (None, "l_linestatus"),
    "nombre_comunidad": ("customer", "c_mktsegment"),
    "id_origen_registro": (None, "concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey)"),
    "cantidad_menciones": (None, "cast(l_linenumber as long)"),
    "cantidad_interacciones": (None, "cast(l_quantity as int)"),
    "score_adopcion": (None, "cast(l_discount * 100 as decimal(12,4))"),
    "score_popularidad": (None, "cast(l_tax * 100 as decimal(12,4))"),
    "score_actividad": (None, "cast(l_extendedprice as decimal(14,4))"),
    "o_orderkey": ("orders", "o_orderkey"),
}


def activity(spark: SparkSession, sf_dir: str, columns: Collection[str] = tuple(_VIEW)) -> DataFrame:
    """The view with the given columns, over the tables that these come from.

    Every key of a fact has its row in the other tables, as foreign keys say,
    so a table that gives no column is not joined.
    """
    tables, waiting = {}, {_VIEW[c][0] for c in columns} - {None}
    while waiting:
        name = waiting.pop()
        tables[name] = None
        if (through := _JOINS[name][0]) is not None:
            waiting.add(through)
    joined = read(spark, sf_dir, "lineitem")
    for name, (_, (left, right)) in _JOINS.items():
        if name in tables:
            joined = joined.join(read(spark, sf_dir, name), F.col(left) == F.col(right))
    return joined.select(*[F.expr(_VIEW[c][1]).alias(c) for c in columns])


SQL = """act AS (
  SELECT CAST(o_orderdate AS DATE) AS fecha_evento, p_brand AS nombre_agente, p_type AS categoria_agente,
    o_orderpriority AS nombre_fuente, o_orderstatus AS tipo_fuente, r_name AS nombre_plataforma, n_name AS tipo_plataforma,
    l_returnflag AS nombre_tecnologia, l_linestatus AS categoria_tecnologia, c_mktsegment AS nombre_comunidad,
    concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id_origen_registro,
    CAST(l_linenumber AS BIGINT) AS cantidad_menciones, CAST(l_quantity AS INTEGER) AS cantidad_interacciones,
    CAST(l_discount * 100 AS DECIMAL(12,4)) AS score_adopcion, CAST(l_tax * 100 AS DECIMAL(12,4)) AS score_popularidad,
    CAST(l_extendedprice AS DECIMAL(14,4)) AS score_actividad, o_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
