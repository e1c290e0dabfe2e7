"""Date helpers with the original pipeline's conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(d: Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6 (not ``dayofweek``)."""
    return F.weekday(d)


def floor_day_diff(late: Column, early: Column) -> Column:
    """Whole days between two timestamps, floored (-14 h -> -1, +14 h -> 0).

    Computed on wall-clock (``timestamp_ntz``) values, so the session time
    zone and its daylight-saving changes never shift the count."""
    seconds = F.timestamp_diff("SECOND", early.cast("timestamp_ntz"), late.cast("timestamp_ntz"))
    return F.floor(seconds / F.lit(86_400)).cast("int")


def calendar_flag_columns(visit_date: Column, holiday_flg: Column) -> dict[str, Column]:
    """Calendar flags, keeping the original names and semantics:
    ``friday_flg`` is weekday == 5 (a Saturday), ``weekend_flg`` is weekday > 5
    (Sunday only), ``holiday_flg2`` is weekday > 4 or a holiday."""
    dow = weekday(visit_date)
    return {
        "holiday_flg": holiday_flg.cast("int"),
        "holiday_flg2": ((dow > 4) | (holiday_flg == 1)).cast("int"),
        "friday_flg": (dow == 5).cast("int"),
        "weekend_flg": (dow > 5).cast("int"),
    }
