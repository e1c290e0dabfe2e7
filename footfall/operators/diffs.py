"""Differences between adjacent observed dates (W-01) and their statistics (A-07).

Original semantics: within an anchor's window, lay out every store over all
dates seen in the window by *any* store and take day-to-day differences;
a difference exists only where the store has values on both dates.

Windows are contiguous date ranges, so "the previous date seen in the window"
is the previous date seen anywhere, provided it is still inside the window.
That removes the anchor from the pairing step:

1. ``prev_date`` of every distinct date (a window over distinct dates only,
   bounded by the calendar, not by the data);
2. pair each row with the same store's row at ``prev_date`` (an equi-join on
   (store_id, date) -- no per-store window, so a store holding a third of all
   rows is still spread over many tasks);
3. explode each difference to the anchors whose window holds both dates and
   aggregate per (end_date, store_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions.stats import stat_aggs
from footfall.operators.anchors import Anchor, explode_anchors, lookback_bounds

DIFF_STATS = ["mean", "std", "max", "min", "skew", "kurtosis"]


def diff_columns(windows=K.DIFF_WINDOWS) -> list[str]:
    return [f"store_diff_{s}_{n}" for n in windows for s in DIFF_STATS]


def adjacent_differences(base: DataFrame, value_col: str = "visitors") -> DataFrame:
    """store_id, visit_date, prev_date, diff = v(date) - v(prev_date)."""
    obs = base.where(F.col(value_col).isNotNull()).select("store_id", "visit_date", value_col)
    dates = obs.select("visit_date").distinct()
    # distinct dates only: bounded by the calendar length
    prev = dates.withColumn("prev_date", F.lag("visit_date").over(Window.orderBy("visit_date")))
    cur = obs.join(F.broadcast(prev), "visit_date").where(F.col("prev_date").isNotNull())
    before = obs.select("store_id", F.col("visit_date").alias("prev_date"),
                        F.col(value_col).alias("__prev_v"))
    pairs = cur.join(before, ["store_id", "prev_date"])
    return pairs.select("store_id", "visit_date", "prev_date",
                        (F.col(value_col) - F.col("__prev_v")).alias("diff"))


def diff_block(base: DataFrame, anchors: list[Anchor], windows=K.DIFF_WINDOWS) -> DataFrame:
    """(end_date, store_id) -> store_diff_{mean,std,max,min,skew,kurtosis}_{n}.

    ``mean`` is the mean of absolute differences; the rest use signed ones.
    Both windows of the original (58 and 600 days) are kept, with suffixes.
    """
    max_n = max(windows)
    ends = sorted({a.end_date for a in anchors})
    lo, hi = lookback_bounds(anchors, max_n)
    diffs = adjacent_differences(base.where((F.col("visit_date") > F.lit(lo)) & (F.col("visit_date") < F.lit(hi))))
    d, p = F.col("visit_date"), F.col("prev_date")
    ex = explode_anchors(diffs, [Anchor(e, 0) for e in ends],
                         lambda a: (d < a["end_date"]) & (p > F.date_sub(a["end_date"], max_n)))
    ex = ex.withColumn("prev_age", F.datediff(F.col("end_date"), p))
    aggs = []
    for n in windows:
        names = {"abs_mean": f"store_diff_mean_{n}", "std": f"store_diff_std_{n}",
                 "max": f"store_diff_max_{n}", "min": f"store_diff_min_{n}",
                 "skew": f"store_diff_skew_{n}", "kurt": f"store_diff_kurtosis_{n}"}
        aggs += stat_aggs(F.col("diff"), names, F.col("prev_age") < n)
    return ex.groupBy("end_date", "store_id").agg(*aggs)
