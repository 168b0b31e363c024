"""Shares, ranks, changes and other derivations of aggregated rows.

Windows without a partition run in one task. They are applied here to rows
that a group-by has already reduced to months, sources, agents or platforms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veleta.scratch import keep


def mean(column: str, digits: int = 4) -> Column:
    """Mean as a rounded double quotient, the same in every engine."""
    return F.round(F.sum(column).cast("double") / F.count(column), digits)


def share(column: str, digits: int = 2) -> Column:
    """Percentage of the total over all rows."""
    total = F.sum(column).over(W.partitionBy())
    return F.round(F.col(column) * 100.0 / F.nullif(total, F.lit(0)), digits)


def change(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """previous, absolute change (the first row counts from 0) and change in percent."""
    w = W.orderBy(*order)
    prior = F.lag(column).over(w)
    return (
        df.withColumn("previous_", prior)
        .withColumn("absolute_", F.col(column) - F.coalesce("previous_", F.lit(0)))
        .withColumn("percent_", F.round((F.col(column) - F.col("previous_")) * 100.0 / F.nullif(F.col("previous_"), F.lit(0)), 2))
    )


def moving_average(column: str, order: list[str], rows: int = 3, digits: int = 2) -> Column:
    return F.round(F.avg(F.col(column).cast("double")).over(W.orderBy(*order).rowsBetween(1 - rows, 0)), digits)


def concentration(df: DataFrame, key: str) -> DataFrame:
    """Sum of squared shares of the groups of `key`."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    return n.join(total).agg(F.round(F.sum(F.pow(F.col("n") / F.col("t"), 2)), 6).alias("hhi"))


def top_and_others(df: DataFrame, label: str, value: str, most: int, others: str = "Otros") -> DataFrame:
    """The first `most` labels by value, the rest summed under one label."""
    w = W.orderBy(F.desc(value), F.asc(label))
    name = F.when(F.row_number().over(w) > most, F.lit(others)).otherwise(F.col(label))
    return df.withColumn(label, name).groupBy(label).agg(F.sum(value).alias(value))


def first_per_stratum(df: DataFrame, strata: list[str], order: list[Column], n: int) -> DataFrame:
    w = W.partitionBy(*strata).orderBy(*order)
    return df.withColumn("rn_", F.row_number().over(w)).filter(F.col("rn_") <= n).drop("rn_")


def idempotence_ratio(df: DataFrame, keys: list[str], name: str = "f") -> DataFrame:
    """One row: rows per distinct key; 1 where loading twice has added nothing."""
    distinct = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"))
    return distinct.agg(F.round(F.sum("n_") / F.count(F.lit(1)), 6).alias(name))


def share_where(df: DataFrame, group: str, condition: Column, name: str, digits: int = 2) -> DataFrame:
    """Percentage of the rows of each group for which a condition holds."""
    return df.groupBy(group).agg(F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100, digits).alias(name))


def with_distinct_counts(df: DataFrame, by: Sequence[str], members: Mapping[str, str | Column], sums: Sequence[tuple[str, Column, str]]) -> DataFrame:
    """Distinct members of several columns, and further aggregates, by the given columns (none: one row), in two levels.

    Rows are combined to one for each combination of members first, in one pass
    that is written to the shared folder; every column is counted from there.
    Rows are not multiplied by the number of columns. `sums`: name, partial aggregate, and
    the function that puts partial ones together (sum, min, max).
    """
    named = {n: F.col(c) if isinstance(c, str) else c for n, c in members.items()}
    cells = df.groupBy(*[F.col(b) for b in by], *[c.alias(f"m_{n}") for n, c in named.items()]).agg(*[partial.alias(n) for n, partial, _ in sums])
    cells = keep(df.sparkSession, cells, "cells")  # each count reads other columns of it, so that no shuffle would be shared
    out = cells.groupBy(*by).agg(*[getattr(F, how)(n).alias(n) for n, _, how in sums])
    for n in named:
        one = cells.filter(F.col(f"m_{n}").isNotNull()).select(*by, f"m_{n}").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias(n))
        if by:
            same = reduce(Column.__and__, [F.col(f"l_.{b}").eqNullSafe(F.col(f"r_.{b}")) for b in by])
            out = out.alias("l_").join(one.alias("r_"), same, "left").select("l_.*", F.coalesce(F.col(f"r_.{n}"), F.lit(0)).alias(n))
        else:
            out = out.join(one)
    return out


def union_counts(df: DataFrame, members: dict[str, str], total: str = "filas") -> DataFrame:
    """Rows, and distinct members of each named column, one row each."""
    wide = with_distinct_counts(df, [], members, [(total, F.count(F.lit(1)), "sum")])
    return wide.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in (total, *members)]).unpivot([], [total, *members], "medida", "n")
