"""Exact order statistics by histogram passes: no task holds more than a histogram, whatever the values.

A pass counts the values of each interval that still matters in `BINS` bins,
with the smallest and greatest value of each; the bin of the wanted rank is the
next pass's interval, with those two as its ends. It ends when a bin's two ends
are one value. Values of very different sizes need a few passes more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of one pass; the driver reads as many rows a wanted value at most.
BINS = 4096
_TOP = float("inf")


def _bin(value: Column, low: float, high: float) -> Column:
    """Bin of a value in an interval; infinite values and NaN, which counts as the greatest, have bins of their own."""
    span = high / BINS - low / BINS  # of a part, for the whole may be beyond what a double holds
    share = (value / BINS - F.lit(low / BINS)) / F.lit(span) if span > 0 else F.when(value > low, 1.0).otherwise(0.0)
    inner = F.least(F.floor(F.greatest(share, F.lit(0.0)) * BINS), F.lit(BINS - 1)).cast("int")
    return F.when(F.isnan(value), BINS + 1).when(value == _TOP, BINS).when(value == -_TOP, -1).otherwise(inner)


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[str, list[float]]:
    """For each column the values, as doubles, at the given places (from 0) among its values in order; nulls are no values."""
    wanted = {(c, r): r for c, places in ranks.items() for r in places}  # rank within the current interval
    ends: dict[tuple[str, int], tuple[float, float] | None] = dict.fromkeys(wanted)
    found: dict[tuple[str, int], float] = {}
    values = df.select(*[F.col(c).cast("double").alias(c) for c in ranks])
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != _TOP), F.col(c))
    spans = values.agg(*[f(finite(c)).alias(f"{n}_{c}") for c in ranks for n, f in (("low", F.min), ("high", F.max))]).first() if ranks else None
    for c, r in wanted:
        low, high = spans[f"low_{c}"], spans[f"high_{c}"]
        ends[c, r] = (0.0, 0.0) if low is None else (low, high)
    first = True
    while len(found) < len(wanted):
        open_ = {(c, e): None for (c, r), e in ends.items() if (c, r) not in found}  # intervals, shared ones once
        for c, (low, high) in open_:
            v = F.col(c)
            inside = v.isNotNull() if first else v.between(low, high) & ~F.isnan(v)
            bins = values.filter(inside).groupBy(_bin(v, low, high).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"))
            open_[c, (low, high)] = sorted(bins.collect())  # at most BINS + 3 rows
        for (c, r), e in list(ends.items()):
            if (c, r) in found:
                continue
            for b in open_[c, e]:
                if wanted[c, r] < b.n:
                    break
                wanted[c, r] -= b.n
            else:
                raise ValueError(f"{c} has no value at place {r}")
            if b.bin > BINS or b.low == b.high:
                found[c, r] = b.high
            ends[c, r] = (b.low, b.high)
        first = False
    return {c: [found[c, r] for r in places] for c, places in ranks.items()}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column, the mean of the middle two where there are two; none without values."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    middle = {c: sorted({(counts[c] - 1) // 2, counts[c] // 2}) for c in columns if counts[c]}
    found = order_statistics(df, middle)
    return {c: found[c][0] / 2 + found[c][-1] / 2 if c in found and len(found[c]) > 1 else found[c][0] if c in found else None for c in columns}
