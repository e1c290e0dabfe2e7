"""The profiling set over the original file layout, as one call (A-15 ... A-24).

Returns named DataFrames (lazy); each is a single aggregate or a join with a
calendar-bounded spine, so all of them run over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import split_part
from footfall.operators import profile as P
from footfall.sources.competition import FILES, read_table


def profile_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    t = {name: read_table(spark, folder, name) for name in FILES}
    out: dict[str, DataFrame] = {}
    for name, df in t.items():
        out[f"nulls_{name}"] = P.null_counts(df)
    out["submission_dates"] = P.min_max(t["submission"].select(
        F.to_date(F.substring("id", -10, 10)).alias("d")), "d")
    out["calendar_dates"] = P.min_max(t["date_info"], "calendar_date")
    for ch in ("air", "hpg"):
        r = t[f"{ch}_reserve"]
        out[f"{ch}_reserve_hour_by_day"] = P.hour_by_dayname(r, "reserve_datetime", "reserve_visitors")
        out[f"{ch}_visit_hour_by_day"] = P.hour_by_dayname(r, "visit_datetime", "reserve_visitors")
        out[f"{ch}_visitors_monthly"] = P.resample_sum(r, "visit_datetime", "reserve_visitors", "M")
    for ch in ("air", "hpg"):
        st = t[f"{ch}_store"]
        out[f"{ch}_genre_counts"] = P.value_counts(st, f"{ch}_genre_name")
        out[f"{ch}_area_counts"] = P.value_counts(st, f"{ch}_area_name")
        for i, part in enumerate(("prefecture", "ward", "area")):
            parts = st.select(split_part(F.col(f"{ch}_area_name"), i).alias(part))
            out[f"{ch}_area_{part}_counts"] = P.value_counts(parts, part)
    v = t["air_visit"]
    out["visitors_daily"] = P.resample_sum(v, "visit_date", "visitors", "D")
    out["visitors_monthly"] = P.resample_sum(v, "visit_date", "visitors", "M")
    out["visitors_by_store"] = P.totals_ranked(v, "air_store_id", "visitors", "overall_number_of_visitors")
    out["hpg_distinct_stores"] = P.distinct_count(t["hpg_reserve"], "hpg_store_id")
    out["hpg_reservations_per_store_histogram"] = P.group_size_histogram(t["hpg_reserve"], "hpg_store_id", 100)
    return out
