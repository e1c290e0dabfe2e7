"""Base fact, label rows and point-in-time history for many anchors.

* ``store_dim``   encoded store dimension (genre / area codes).
* ``calendar_dim`` calendar with the derived flags.
* ``base_fact``   daily visits (+ optional submission rows), log1p target,
                  day of week, month, store and calendar attributes.
* ``label_rows``  one row per (anchor, store, date) in the horizon, with the
                  shifted calendar (J-06).
* ``history``     base rows exploded to every anchor whose lookback covers
                  them, with ``age`` = days before the anchor.  No row dated on
                  or after its anchor can enter (leak-free by construction).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions import calendar_flag_columns, make_id, weekday, id_date, id_store
from footfall.operators.anchors import (Anchor, explode_anchors, horizon_bounds, in_horizon,
                                        in_lookback, lookback_bounds)
from footfall.operators.encode import label_encode


def store_dim(stores: DataFrame, genre_col: str = "genre_name", area_col: str = "area_name",
              extra: list[str] | tuple = ()) -> DataFrame:
    """store_id, air_genre_name (code), air_area_name (text), air_area_name0
    (code), plus ``extra`` store attributes passed through (e.g. latitude,
    longitude).

    ``air_area_name0`` is the first space-separated token of the area, coded.
    """
    df = stores.select(F.col("store_id").cast("string").alias("store_id"),
                       F.col(genre_col).alias("air_genre_name"),
                       F.col(area_col).alias("air_area_name"),
                       F.get(F.split(F.col(area_col), " "), 0).alias("air_area_name0"),
                       *[F.col(c) for c in extra])
    return label_encode(label_encode(df, "air_genre_name"), "air_area_name0")


def calendar_dim(calendar: DataFrame) -> DataFrame:
    """visit_date, holiday_flg, holiday_flg2, friday_flg, weekend_flg."""
    flags = calendar_flag_columns(F.col("visit_date"), F.col("holiday_flg"))
    return calendar.select(F.col("visit_date").cast("date").alias("visit_date"),
                           *[c.alias(n) for n, c in flags.items()])


def shifted_calendar(cal: DataFrame, offsets: Iterable[int] = K.CALENDAR_OFFSETS) -> DataFrame:
    """Wide calendar: for label date d and offset i the flags of day d - i,
    as ``ahead_holiday_{i}``, ``ahead_holiday2_{i}``, ``ahead_friday_{i}``,
    ``ahead_weekend_{i}`` (J-06).  Every calendar day is dealt to the days it
    is ``i`` before, and one aggregate puts them side by side: no join per
    offset, and no assumption that the calendar has no gaps."""
    names = {"holiday_flg": "ahead_holiday_{}", "holiday_flg2": "ahead_holiday2_{}",
             "friday_flg": "ahead_friday_{}", "weekend_flg": "ahead_weekend_{}"}
    offsets = list(offsets)
    dealt = cal.withColumn("__i", F.explode(F.array(F.lit(None).cast("int"), *[F.lit(i) for i in offsets])))
    side = [F.max(F.when(F.col("__i") == i, F.col(src))).alias(dst.format(i))
            for i in offsets for src, dst in names.items()]
    wide = dealt.groupBy(F.date_add("visit_date", F.coalesce("__i", F.lit(0))).alias("visit_date")).agg(
        F.max(F.col("__i").isNull()).alias("__own"), *side)
    return wide.where("__own").drop("__own")


def base_fact(visits: DataFrame, stores: DataFrame, cal: DataFrame,
              submission: DataFrame | None = None) -> DataFrame:
    """Daily visits (and submission ids with 0 visitors), log1p target,
    dow/month, store attributes (left join) and calendar flags (left join).

    The calendar is bounded by the number of days, so it is broadcast; the
    store dimension is left to the planner's size check (and AQE's runtime
    one), since its size is not bounded a priori.
    """
    v = visits.select(F.col("store_id").cast("string").alias("store_id"),
                      F.col("visit_date").cast("date").alias("visit_date"),
                      F.col("visitors").cast("double").alias("visitors"))
    if submission is not None:
        sub = submission.select(id_store(F.col("id")).alias("store_id"),
                                F.to_date(id_date(F.col("id"))).alias("visit_date"),
                                F.lit(0.0).alias("visitors"))
        v = v.unionByName(sub)
    v = v.select("store_id", "visit_date", F.log1p("visitors").alias("visitors"),
                 weekday(F.col("visit_date")).alias("dow"),
                 F.month("visit_date").alias("month"),
                 make_id(F.col("store_id"), F.col("visit_date")).alias("id"))
    v = v.join(stores, "store_id", "left")
    return v.join(F.broadcast(cal), "visit_date", "left")


def label_rows(base: DataFrame, anchors: list[Anchor], cal: DataFrame) -> DataFrame:
    """Rows of the horizon [end, end + horizon) of every anchor, with
    ``end_date``, ``diff_of_day``, ``month``, ``year`` and the shifted calendar."""
    lo, hi = horizon_bounds(anchors)
    d = F.col("visit_date")
    rows = base.where((d >= F.lit(lo)) & (d < F.lit(hi)))
    rows = explode_anchors(rows, anchors, in_horizon(d))
    rows = rows.select("end_date", "store_id", "visit_date", "id", "visitors", "dow",
                       F.datediff(d, F.col("end_date")).alias("diff_of_day"),
                       F.month(d).alias("month"), F.year(d).alias("year"),
                       *[c for c in base.columns if c not in
                         ("store_id", "visit_date", "id", "visitors", "dow", "month")])
    return rows.join(F.broadcast(shifted_calendar(cal)), "visit_date", "left")


def history(base: DataFrame, anchors: list[Anchor], max_lookback: int,
            value_col: str = "visitors") -> DataFrame:
    """Base rows in ``end - max_lookback < d < end`` of each anchor, with
    ``end_date`` and ``age = end - d`` (1 .. max_lookback-1 days)."""
    ends = sorted({a.end_date for a in anchors})
    lo, hi = lookback_bounds(anchors, max_lookback)
    d = F.col("visit_date")
    rows = base.where((d > F.lit(lo)) & (d < F.lit(hi)) & F.col(value_col).isNotNull())
    rows = explode_anchors(rows, [Anchor(e, 0) for e in ends], in_lookback(d, max_lookback))
    return rows.drop("horizon").withColumn("age", F.datediff(F.col("end_date"), d))
