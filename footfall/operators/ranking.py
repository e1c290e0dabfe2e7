"""Exact row numbers and running totals without a single-task global window.

``Window.orderBy(...)`` with no partition moves every row into one task.
Both helpers below split the order into *buckets* that respect it (every
row of bucket b sorts before every row of bucket b + 1), count rows per
bucket, turn the counts into offsets with a window over the (few) bucket
rows, and finish with a window partitioned by bucket.  The result is exactly
the global row number / running sum; no task holds more than one bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def md5_prefix(key: Column, hex_chars: int = 4) -> Column:
    """Leading hex digits of md5(key): uniform buckets that respect md5 order."""
    return F.substring(F.md5(key.cast("string")), 1, hex_chars)


def exact_row_number(df: DataFrame, partition_cols: list[str], order_cols: list[Column],
                     bucket: Column, out: str = "rn") -> DataFrame:
    """0-based row number within ``partition_cols`` ordered by ``order_cols``.

    ``bucket`` must be non-decreasing along ``order_cols`` inside each
    partition (e.g. a prefix of the first sort key).
    """
    b = df.withColumn("__b", bucket)
    counts = b.groupBy(*partition_cols, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*partition_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition_cols, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    joined = b.join(offsets, [*partition_cols, "__b"])
    within = Window.partitionBy(*partition_cols, "__b").orderBy(*order_cols)
    return joined.withColumn(out, (F.col("__off") + F.row_number().over(within) - 1).cast("long")) \
                 .drop("__b", "__off")


def score_buckets(df: DataFrame, score: str, n_buckets: int = 256) -> Column:
    """Bucket index that decreases as ``score`` increases (for descending
    order), from approximate quantiles of the score.  The quantile list is a
    fitted parameter of at most ``n_buckets`` numbers."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.agg(F.percentile_approx(score, probs, 10000).alias("b")).first()["b"] or []
    bounds = sorted(set(float(x) for x in bounds if x is not None))
    arr = F.array(*[F.lit(x) for x in bounds]) if bounds else F.array().cast("array<double>")
    return F.size(F.filter(arr, lambda x: x > F.col(score).cast("double")))


def running_totals_desc(df: DataFrame, score: str, value_cols: list[str], n_buckets: int = 256,
                        prefix: str = "cum_") -> DataFrame:
    """Pre-aggregate ``value_cols`` by distinct ``score``; add inclusive running
    sums over descending score (``cum_<col>``).

    Distinct scores (not rows) are what the windows see; a score shared by a
    third of all rows is one row after the first aggregate.
    """
    g = df.groupBy(score).agg(*[F.sum(c).alias(c) for c in value_cols])
    g = g.withColumn("__b", score_buckets(g, score, n_buckets))
    tot = g.groupBy("__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in value_cols])
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)   # <= n_buckets rows
    offs = tot.select("__b", *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}")
                               for c in value_cols])
    # at most n_buckets rows: a proven bound, broadcast
    j = g.join(F.broadcast(offs), "__b")
    within = Window.partitionBy("__b").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(score, *value_cols,
                    *[(F.col(f"__o_{c}") + F.sum(c).over(within)).alias(prefix + c) for c in value_cols])


def exact_quantiles(df: DataFrame, col: str, probs: list[float], n_buckets: int = 1000) -> dict[float, float | None]:
    """Exact quantiles of one column (see ``exact_quantiles_multi``)."""
    return exact_quantiles_multi(df, [col], probs, n_buckets)[col]


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float],
                          n_buckets: int = 1000) -> dict[str, dict[float, float | None]]:
    """Exact quantiles with linear interpolation (as pandas / ``quantile_cont``)
    for several columns at once, by distributed selection -- never a
    single-task sort or a value map of a whole column.

    The columns are read as (column, value) rows.  Infinite values are counted
    at either end.  Each level splits every interval still holding a wanted
    rank into ``n_buckets`` equal-width buckets (one arithmetic expression per
    row, monotone in the value), and one aggregate returns count, min and max
    per bucket.  A rank keeps the bucket that holds it; that bucket's own min
    and max are the next interval, until they are equal.  The two ends of an
    interval never share a bucket, so it shrinks at every level.  Driver-side
    state is a few numbers per bucket.
    """
    inf = math.inf
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("double").alias("x"))
                                          for i, c in enumerate(cols)])).alias("r"))
              .select("r.c", "r.x").where(F.col("x").isNotNull() & ~F.isnan("x")))
    finite = F.when((F.col("x") != inf) & (F.col("x") != -inf), F.col("x"))
    stats = {r["c"]: r for r in long.groupBy("c").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("x") == -inf, 1)).alias("low"),
        F.count(finite).alias("finite"), F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()}
    pos = {(ci, p): p * (stats[ci]["n"] - 1) for ci in stats for p in probs}
    wanted = sorted({(ci, int(math.floor(h))) for (ci, _), h in pos.items()}
                    | {(ci, int(math.ceil(h))) for (ci, _), h in pos.items()})
    found: dict[tuple, float] = {}
    # per (column, rank): (column, low, high, rows below low, rows in [low, high]); bounds inclusive
    state: dict[tuple, tuple] = {}
    for ci, rank in wanted:
        s = stats[ci]
        if s["low"] <= rank < s["low"] + s["finite"]:
            state[ci, rank] = (ci, s["lo"], s["hi"], s["low"], s["finite"])
        else:
            found[ci, rank] = -inf if rank < s["low"] else inf

    def tag_of(ivs):
        tag = F.lit(None).cast("int")
        for i, (c, lo, hi, _, _) in reversed(list(enumerate(ivs))):
            tag = F.when((F.col("c") == c) & (F.col("x") >= F.lit(lo)) & (F.col("x") <= F.lit(hi)), F.lit(i)).otherwise(tag)
        return tag

    while True:
        found.update({w: iv[1] for w, iv in state.items() if iv[1] == iv[2]})     # a single value: done
        intervals = sorted({iv for w, iv in state.items() if w not in found}, key=repr)
        if not intervals:
            break
        bucket = F.lit(0)
        for i, (_, lo, hi, _, _) in enumerate(intervals):
            # halves, so that the width of any two finite ends is finite, too
            share = (F.col("x") / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) if hi / 2 > lo / 2 else F.lit(0.0)
            b = F.when(F.col("x") == F.lit(hi), F.lit(n_buckets - 1)).otherwise(
                F.least(F.floor(share * n_buckets), F.lit(n_buckets - 2)).cast("int"))
            bucket = F.when(F.col("__iv") == i, b).otherwise(bucket)
        tagged = long.withColumn("__iv", tag_of(intervals)).where(F.col("__iv").isNotNull())
        per: dict[int, list] = {}
        for r in (tagged.groupBy("__iv", bucket.alias("__b"))
                  .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()):
            per.setdefault(r["__iv"], []).append((r["__b"], r["n"], r["lo"], r["hi"]))
        for i, iv in enumerate(intervals):
            below = iv[3]
            for _, n, lo, hi in sorted(per.get(i, [])):
                for w in [w for w, mine in state.items() if mine == iv and below <= w[1] < below + n]:
                    state[w] = (iv[0], lo, hi, below, n)
                below += n
    out: dict[str, dict[float, float | None]] = {c: {p: None for p in probs} for c in cols}
    for (ci, p), h in pos.items():
        a, b = found[(ci, int(math.floor(h)))], found[(ci, int(math.ceil(h)))]
        out[cols[ci]][p] = a if a == b else a + (b - a) * (h - math.floor(h))
    return out
