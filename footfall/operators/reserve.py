"""Known-ahead reservation features (P-06, F-05, J-03, J-04, A-11 ... A-14).

A reservation counts for an anchor when its visit falls in the horizon
[end, end + horizon) and it was made before the anchor (reserve date < end),
so nothing unknown at the anchor leaks in.  Each reservation row is exploded
to the anchors satisfying both conditions (the anchor list is a literal
array), then aggregated:

* per (end_date, store_id, visit_date): visitor and lead-time statistics,
  packed per (end_date, store_id) as an array of at most ``horizon`` structs,
  so the label table joins them on the same key as every store family;
* per (end_date, visit_date): day totals, at most sum(horizons) rows in all,
  which is a proven bound and therefore broadcast.

Lead time is whole days between reservation and visit, floored per row
(the original assigns one channel's lead times by row position after a
merge, which misaligns them; here both channels compute it per row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import floor_day_diff
from footfall.functions.stats import stat_aggs
from footfall.operators.anchors import Anchor, explode_anchors, horizon_bounds

# --- fixed values: output names of the reservation features ----------------
# (channel, level) -> {statistic: feature name} for reserved visitors
VISITOR_NAMES = {
    ("air", "store"): {"sum": "air_reserve_visitors_sum", "count": "air_reserve_visitors_count",
                       "skew": "air_reserve_visitors_skew", "min": "air_reserve_visitors_min",
                       "max": "air_reserve_visitors_max", "median": "air_reserve_visitors_median",
                       "mean": "air_reserve_visitors_mean"},
    ("hpg", "store"): {"sum": "hpg_reserve_sum", "count": "hpg_reserve_count", "mean": "hpg_reserve_mean",
                       "median": "hpg_reserve_median", "min": "hpg_reserve_min", "max": "hpg_reserve_max",
                       "skew": "hpg_reserve_skew"},
    ("air", "date"): {"sum": "air_date_sum", "count": "air_date_count", "min": "air_date_min",
                      "max": "air_date_max", "skew": "air_date_skew", "median": "air_date_median",
                      "mean": "air_date_mean"},
    ("hpg", "date"): {"sum": "hpg_date_visitors", "count": "hpg_date_count"},
}
# (channel, level) -> {statistic: feature name} for lead time in days
LEAD_NAMES = {
    ("air", "store"): {"mean": "air_store_diff_time_mean", "median": "air_store_diff_time_median",
                       "min": "air_store_diff_time_min", "max": "air_store_diff_time_max",
                       "sum": "air_store_diff_time_sum", "skew": "air_store_diff_time_skew"},
    ("hpg", "store"): {"mean": "hpg_store_diff_time_mean", "median": "hpg_store_diff_time_median",
                       "sum": "hpg_store_diff_time_sum", "min": "hpg_store_diff_time_min",
                       "max": "hpg_store_diff_time_max", "skew": "hpg_store_diff_time_skew"},
    ("air", "date"): {"mean": "air_diff_time_mean", "min": "air_diff_time_min", "max": "air_diff_time_max",
                      "median": "air_diff_time_median", "sum": "air_diff_time_sum", "skew": "air_diff_time_skew"},
    ("hpg", "date"): {"mean": "hpg_diff_time_mean", "median": "hpg_diff_time_median", "sum": "hpg_diff_time_sum",
                      "min": "hpg_diff_time_min", "max": "hpg_diff_time_max", "skew": "hpg_diff_time_skew"},
}
# ---------------------------------------------------------------------------


def feature_columns(channel: str, level: str) -> list[str]:
    return list(VISITOR_NAMES[(channel, level)].values()) + list(LEAD_NAMES[(channel, level)].values())


def map_ids(reservations: DataFrame, crosswalk: DataFrame, id_col: str = "ext_store_id") -> DataFrame:
    """store_id = crosswalk id if mapped, else the channel's own id (J-03, P-10).

    The crosswalk is as large as the store list; the planner/AQE decide
    whether to broadcast it."""
    cw = crosswalk.select(F.col(id_col).alias("__ext"), F.col("store_id").alias("__mapped"))
    joined = reservations.join(cw, reservations[id_col] == cw["__ext"], "left")
    return joined.withColumn("store_id", F.coalesce(F.col("__mapped"), F.col(id_col).cast("string"))) \
                 .drop("__ext", "__mapped")


def prepare(reservations: DataFrame) -> DataFrame:
    """visit_date, reserve_date (calendar days) and floored lead time."""
    return reservations.select(
        F.col("store_id").cast("string").alias("store_id"),
        F.col("visit_ts").cast("date").alias("visit_date"),
        F.col("reserve_ts").cast("date").alias("reserve_date"),
        F.col("reserve_visitors").cast("double").alias("reserve_visitors"),
        floor_day_diff(F.col("visit_ts"), F.col("reserve_ts")).alias("diff_time"))


def known_ahead(res: DataFrame, anchors: list[Anchor]) -> DataFrame:
    """Reservations visible at each anchor: end <= visit < end + horizon and
    reserve_date < end (P-06)."""
    lo, hi = horizon_bounds(anchors)
    v, r = F.col("visit_date"), F.col("reserve_date")
    res = res.where((v >= F.lit(lo)) & (v < F.lit(hi)) & (r < F.lit(hi)))
    return explode_anchors(
        res, anchors,
        lambda a: (a["end_date"] <= v) & (v < F.date_add(a["end_date"], a["horizon"])) & (r < a["end_date"]))


def _aggs(channel: str, level: str) -> list:
    return (stat_aggs(F.col("reserve_visitors"), VISITOR_NAMES[(channel, level)])
            + stat_aggs(F.col("diff_time").cast("double"), LEAD_NAMES[(channel, level)]))


def store_date_pack(visible: DataFrame, channel: str) -> DataFrame:
    """(end_date, store_id) -> {channel}_pack: per-visit-date statistics."""
    per_day = visible.groupBy("end_date", "store_id", "visit_date").agg(*_aggs(channel, "store"))
    fields = [c for c in per_day.columns if c not in ("end_date", "store_id")]
    return per_day.groupBy("end_date", "store_id").agg(
        F.collect_list(F.struct(*fields)).alias(f"{channel}_pack"))


def date_block(visible: DataFrame, channel: str) -> DataFrame:
    """(end_date, visit_date) -> day totals and lead-time statistics."""
    return visible.groupBy("end_date", "visit_date").agg(*_aggs(channel, "date"))


def reservation_blocks(reserve_a: DataFrame, reserve_b: DataFrame, crosswalk: DataFrame,
                       stores: DataFrame, anchors: list[Anchor]) -> dict[str, DataFrame]:
    """Both channels.  Channel a keeps only reservations of known stores
    (inner join with store info, J-04); channel b maps ids through the
    crosswalk, unmapped ids stay and only reach the day totals."""
    a = reserve_a.join(stores.select("store_id"), "store_id", "left_semi")
    b = map_ids(reserve_b, crosswalk)
    va = known_ahead(prepare(a), anchors)
    vb = known_ahead(prepare(b), anchors)
    return {
        "air_pack": store_date_pack(va, "air"),
        "hpg_pack": store_date_pack(vb, "hpg"),
        "air_date": date_block(va, "air"),
        "hpg_date": date_block(vb, "hpg"),
    }
