"""String helpers: composite ids and whitespace splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_id(store_id: Column, visit_date: Column) -> Column:
    """``<store>_<yyyy-mm-dd>`` key."""
    return F.concat(store_id.cast("string"), F.lit("_"), F.date_format(visit_date, "yyyy-MM-dd"))


def id_date(id_col: Column) -> Column:
    """Last 10 characters of an id: the date part."""
    return F.substring(id_col, -10, 10)


def id_store(id_col: Column) -> Column:
    """All but the last 11 characters of an id: the store part."""
    return _drop_tail(id_col, 11)


def _drop_tail(c: Column, n: int) -> Column:
    return F.substring(c, F.lit(1), F.length(c) - F.lit(n))


def split_part(c: Column, index: int, pattern: str = r"\s+") -> Column:
    """Part ``index`` (0-based) of a regex split; NULL past the end."""
    return F.get(F.split(c, pattern), index)


def round_half(c: Column, digits: int = 6) -> Column:
    """Round a double for engine-independent comparison; -0.0 becomes 0.0."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)
