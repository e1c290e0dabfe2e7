"""Data-profiling queries (A-15 ... A-24, O-02, U-01, P-12).

All are single aggregations (partial per task) or a join against a spine
whose length is bounded by the calendar, never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column: one pass, then a 1-row unpivot (A-15)."""
    wide = df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], [_q(c) for c in df.columns], "column_name", "null_count")


def value_counts(df: DataFrame, col: str, count_col: str = "n") -> DataFrame:
    """Frequency table, most frequent first (A-16); NULL keys dropped as pandas does."""
    return (df.where(_q(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(F.desc(count_col), col))


def relative_frequency(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share) with share = n / total (A-17).  The total is one
    global count, so no window ever gathers the groups into one task."""
    kept = df.where(_q(col).isNotNull())
    total = kept.count()
    vc = kept.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return vc.withColumn("share", F.col("n") / F.lit(float(total)) if total else F.lit(None).cast("double"))


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """count, mean, std (sample), min, quartiles (linear interpolation, as
    pandas), max -- one row per column (A-18).

    Moments come from one aggregate.  Quartiles use distributed exact
    selection (``ranking.exact_quantiles``): a global ``percentile`` would
    merge one map entry per distinct value in a single task.  ``exact=False``
    uses ``percentile_approx`` instead."""
    from footfall.operators.ranking import exact_quantiles_multi
    quart = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75]) if exact else {}
    aggs = []
    for i, c in enumerate(cols):
        v = _q(c).cast("double")
        aggs += [F.count(v).alias(f"count_{i}"), F.avg(v).alias(f"mean_{i}"),
                 F.stddev_samp(v).alias(f"std_{i}"), F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}")]
        if not exact:
            aggs += [F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias(f"q_{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        if exact:
            qs = quart[c]
            p25, p50, p75 = (F.lit(qs[p]).cast("double") for p in (0.25, 0.5, 0.75))
        else:
            p25, p50, p75 = (F.col(f"q_{i}")[j].cast("double") for j in range(3))
        rows.append(F.struct(F.lit(c).alias("column_name"), F.col(f"count_{i}").alias("count"),
                             F.col(f"mean_{i}").alias("mean"), F.col(f"std_{i}").alias("std"),
                             F.col(f"min_{i}").alias("min"), p25.alias("p25"), p50.alias("p50"),
                             p75.alias("p75"), F.col(f"max_{i}").alias("max")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def positional_slice(df: DataFrame, start: int, stop: int) -> DataFrame:
    """Columns ``start:stop`` by position (P-12)."""
    return df.select(*[_q(c) for c in df.columns[start:stop]])


def min_max(df: DataFrame, col: str) -> DataFrame:
    """Global min and max (A-19)."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Exact number of distinct non-NULL values (A-20)."""
    return df.agg(F.count_distinct(col).alias("n_distinct"))


def hour_by_dayname(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Pivot table: hour of day x weekday name, sum of ``value`` (A-21).
    Listing the 7 pivot values avoids the extra distinct-values job."""
    return (df.withColumn("day_name", F.date_format(ts, "EEEE"))
              .groupBy(F.hour(ts).alias("hour")).pivot("day_name", DAY_NAMES).agg(F.sum(value)))


def resample_sum(df: DataFrame, ts: str, value: str, freq: str = "D") -> DataFrame:
    """Calendar resample with empty periods = 0 (A-22).

    ``D``: one row per day; ``M``: one row per month labelled by its last day
    (pandas' month-end label).  The spine spans min..max of the data and has
    one row per period, so it is bounded by the calendar.
    """
    if freq == "D":
        period = F.to_date(_q(ts))
        step = F.expr("interval 1 day")
    elif freq == "M":
        period = F.last_day(_q(ts))
        step = F.expr("interval 1 month")
    else:
        raise ValueError(freq)
    totals = df.groupBy(period.alias("period")).agg(F.sum(value).alias("total"))
    bounds = totals.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    if freq == "D":
        spine = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias("period"))
    else:
        # month ends: step over first days of months, then take last_day
        spine = bounds.select(F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), step))
                              .alias("m")).select(F.last_day("m").alias("period"))
    return (spine.join(totals, "period", "left")
                 .select("period", F.coalesce(F.col("total"), F.lit(0.0)).cast("double").alias("total")))


def totals_ranked(df: DataFrame, key: str, value: str, total_col: str = "total") -> DataFrame:
    """Total per key, largest first (A-23)."""
    return df.groupBy(key).agg(F.sum(value).alias(total_col)).orderBy(F.desc(total_col), key)


def top_k(df: DataFrame, order_col: str, k: int, tie_break: str) -> DataFrame:
    """Top-k by ``order_col`` descending with a deterministic tie-break (O-02)."""
    return df.orderBy(F.desc(order_col), F.asc(tie_break)).limit(k)


def group_size_histogram(df: DataFrame, key: str, bins: int = 100) -> DataFrame:
    """Histogram of rows-per-key: ``bins`` equal-width bins over [min, max],
    last bin closed on the right; empty bins included (A-24).

    Sizes come from one aggregate; the bin spine has ``bins`` rows.
    """
    sizes = df.where(_q(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    rng = sizes.agg(F.min("size").alias("lo"), F.max("size").alias("hi"))
    # the range is one row of two numbers (a fitted parameter)
    lo_hi = rng.first()
    if lo_hi["lo"] is None:                      # no keys, no bins
        return df.sparkSession.createDataFrame([], "bin int, left_edge double, right_edge double, n_keys bigint")
    lo, hi = int(lo_hi["lo"]), int(lo_hi["hi"])
    span = (hi - lo) if hi > lo else 1
    b = F.least(F.floor((F.col("size") - F.lit(lo)) * F.lit(bins) / F.lit(span)), F.lit(bins - 1)).cast("int")
    counts = sizes.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_keys"))
    width = (hi - lo) / bins
    spine = sizes.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = spine.select("bin",
                         (F.lit(float(lo)) + F.col("bin") * F.lit(width)).alias("left_edge"),
                         (F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(width)).alias("right_edge"))
    return (edges.join(counts, "bin", "left")
                 .select("bin", "left_edge", "right_edge", F.coalesce("n_keys", F.lit(0)).alias("n_keys")))


MOST_DATES = 100_000          # columns of the grid: some 270 years of days


def densify(df: DataFrame, key: str, date: str, value: str, fill: float = 0.0) -> DataFrame:
    """The full grid of keys and dates with ``fill`` where a key has no row on
    a date that any key has (R-02); rows of one key and date are summed.

    The dates in order are one array, bounded by the calendar.  Each key's rows
    become a map as long as that array at most, and the key reads all dates
    from its map: one shuffle of the aggregated rows, no join."""
    rows = df.where(_q(key).isNotNull() & _q(date).isNotNull()).groupBy(key, date).agg(F.sum(value).alias("__v"))
    dates = [r[0] for r in rows.select(date).distinct().limit(MOST_DATES + 1).collect()]
    if len(dates) > MOST_DATES:
        raise ValueError(f"more than {MOST_DATES} values of {date}")
    kind = df.schema[date].dataType
    maps = rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(date, "__v"))).alias("__m"))
    held = F.lit(sorted(dates)) if dates else F.array().cast(T.ArrayType(kind))
    return maps.select(key, "__m", F.explode(held).alias(date)).select(
        key, date, F.coalesce(F.element_at("__m", F.col(date)), F.lit(fill)).alias(value))


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """UNION ALL aligned by column name; missing columns are NULL (U-01)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
