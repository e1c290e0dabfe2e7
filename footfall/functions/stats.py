"""Aggregate statistics with pandas semantics on top of Spark's built-ins.

Spark's ``skewness``/``kurtosis`` are population moments (g1, g2); pandas and
DuckDB report the bias-corrected sample versions.  The corrections below are
plain expressions over aggregates, so they stay inside one hash aggregate and
keep partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# the 7-statistic bundle, in the order features are emitted
STAT_ORDER = ["min", "mean", "median", "max", "count", "std", "skew"]


def corrected_skew(n: Column, g1: Column) -> Column:
    """Sample skewness G1 = g1 * sqrt(n (n-1)) / (n-2); NULL below n = 3."""
    n = n.cast("double")
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(n: Column, g2: Column) -> Column:
    """Sample excess kurtosis G2 = (n-1)/((n-2)(n-3)) ((n+1) g2 + 6); NULL below n = 4."""
    n = n.cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def median_of(v: Column, mode: str = "exact") -> Column:
    """Exact median (linear interpolation, as pandas) or a bounded-memory sketch.

    ``exact`` keeps a value->count map per group (partial aggregation merges
    them), so memory grows with the distinct values of a group; ``approx``
    uses ``percentile_approx`` whose buffer is bounded by its accuracy.
    """
    if mode == "approx":
        return F.percentile_approx(v, 0.5, 10000).cast("double")
    return F.median(v).cast("double")


def stat_aggs(value: Column, names: dict[str, str], cond: Column | None = None,
              median_mode: str = "exact") -> list[Column]:
    """Aggregates for the requested statistics of ``value`` (optionally only
    rows where ``cond`` holds), aliased by ``names[stat]``.

    Supported stats: min, mean, median, max, count, std, skew, kurt, sum,
    abs_mean.  NULL values are skipped, as pandas skips NaN.
    """
    v = F.when(cond, value) if cond is not None else value
    out = []
    for stat, alias in names.items():
        if stat == "min":
            c = F.min(v)
        elif stat == "max":
            c = F.max(v)
        elif stat == "mean":
            c = F.avg(v)
        elif stat == "median":
            c = median_of(v, median_mode)
        elif stat == "count":
            c = F.count(v)
        elif stat == "std":
            c = F.stddev_samp(v)
        elif stat == "skew":
            c = corrected_skew(F.count(v), F.skewness(v))
        elif stat == "kurt":
            c = corrected_kurtosis(F.count(v), F.kurtosis(v))
        elif stat == "sum":
            c = F.sum(v)
        elif stat == "abs_mean":
            c = F.avg(F.abs(v))
        else:
            raise ValueError(f"unknown statistic {stat!r}")
        out.append(c.alias(alias))
    return out
