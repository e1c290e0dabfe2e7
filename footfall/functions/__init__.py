"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from footfall.functions.stats import stat_aggs, corrected_skew, corrected_kurtosis, STAT_ORDER
from footfall.functions.dates import weekday, floor_day_diff, calendar_flag_columns
from footfall.functions.text import id_date, id_store, split_part, make_id, round_half

__all__ = [
    "stat_aggs", "corrected_skew", "corrected_kurtosis", "STAT_ORDER",
    "weekday", "floor_day_diff", "calendar_flag_columns",
    "id_date", "id_store", "split_part", "make_id", "round_half",
]
