"""The activity view over a stored star schema, the fact partitioned by month.

Reports read the same columns from here as from the sales tables. A condition
on the date is one on the dimension of time, which shares the month with the
fact's partitions: the planner reads those of the months that it finds there.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veleta.plans.gold import DIMENSIONS
from veleta.tables import Snapshots

#: Column of the fact's partitions: year and month.
MONTH = "mes_clave"
#: Dimension of each column of the view; the others are columns of the fact.
_OF = {
    "fecha_evento": ("tiempo", "fecha"),
    "nombre_agente": ("agente", "nombre_agente"),
    "categoria_agente": ("agente", "categoria_agente"),
    "nombre_fuente": ("fuente", "nombre_fuente"),
    "tipo_fuente": ("fuente", "tipo_fuente"),
    "nombre_plataforma": ("plataforma", "nombre_plataforma"),
    "tipo_plataforma": ("plataforma", "tipo_plataforma"),
    "nombre_tecnologia": ("tecnologia", "nombre_tecnologia"),
    "categoria_tecnologia": ("tecnologia", "categoria_tecnologia"),
    "nombre_comunidad": ("comunidad", "nombre_comunidad"),
}


def _month(time: DataFrame) -> DataFrame:
    return time.withColumn(MONTH, (F.col("anio") * 100 + F.col("mes")).cast("int"))


def store(snapshots: Snapshots, dims: Mapping[str, DataFrame], fact: DataFrame) -> int:
    """Publish dimensions and fact as one snapshot."""
    months = _month(dims["tiempo"]).select("id_tiempo", MONTH)
    return snapshots.publish({**{f"dim_{n}": d for n, d in dims.items()}, "fact": fact.join(months, "id_tiempo")}, {"fact": [MONTH]})


def fact(snapshots: Snapshots) -> DataFrame:
    """The fact as it was loaded."""
    return snapshots.read("fact").drop(MONTH)


def dimensions(snapshots: Snapshots) -> dict[str, DataFrame]:
    return {n: snapshots.read(f"dim_{n}") for n in DIMENSIONS}


def activity(snapshots: Snapshots, columns: Collection[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """The given columns of every fact, of those between two dates; dimensions that give none of them are not joined."""
    rows, needed = snapshots.read("fact"), {_OF[c][0] for c in columns if c in _OF}
    if first is not None or last is not None:
        needed.add("tiempo")
    for name in needed:
        key = DIMENSIONS[name][1]
        dim = snapshots.read(f"dim_{name}")
        wanted = [F.col(column).alias(c) for c, (d, column) in _OF.items() if d == name and (c in columns or c == "fecha_evento")]
        if name != "tiempo":
            rows = rows.join(dim.select(key, *wanted), key)
            continue
        dim = _month(dim)
        for bound, inside in ((first, F.col("fecha") >= F.lit(first)), (last, F.col("fecha") <= F.lit(last))):
            dim = dim if bound is None else dim.filter(inside)
        rows = rows.join(dim.select(key, MONTH, *wanted), [key, MONTH])
    return rows.select(*columns)
