"""Registered queries: name -> (spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables; names follow ``q_<inventory id>_<short name>``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.plans import oracle as O
from footfall.plans.inputs import customer_inputs, fixture_inputs
from footfall.plans.normalize import normalize
from footfall.plans.snapshot import LABEL_COLUMNS, create_snapshots
from footfall.operators import diffs as DF
from footfall.operators import features as FE
from footfall.operators import reserve as RS
from footfall.sources.fixtures import fixture_anchors
from footfall import constants as K

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

KEYS = ["end_date", "store_id", "visit_date"]


def register(name: str, sql: str | None):
    def deco(fn):
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ snapshots ----
def _snapshot_query(name: str, families, columns: list[str]):
    fams = tuple(families)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = create_snapshots(fixture_inputs(spark, sf_dir), fixture_anchors(), families=fams)
        return normalize(df.select(*[FE.q(c) for c in columns]))

    register(name, O.snapshot_sql(fams, columns))(run)


N = K.LONG_WINDOW
_FAMILY_QUERIES = {
    # label rows with the shifted calendar (P-05, J-06, F-02, F-03, F-13)
    "q_j06_labels": ((), LABEL_COLUMNS),
    "q_a01_store_stats": (("store",), KEYS + FE.stats_columns("store")),
    "q_a02_store_dow_stats": (("store_dow",), KEYS + ["dow"] + FE.stats_columns("store_dow")),
    "q_a03_genre_stats": (("genre",), KEYS + ["air_genre_name"] + FE.stats_columns("genre")
                          + FE.stats_columns("genre_dow")),
    "q_a04_store_decay": (("store",), KEYS + FE.decay_columns("store", K.DECAY_WEIGHTS)),
    "q_a05_store_dow_decay": (("store_dow",), KEYS + FE.decay_columns("store_dow", K.DOW_DECAY_WEIGHTS)),
    "q_a06_genre_decay": (("genre",), KEYS + FE.decay_columns("genre", K.DECAY_WEIGHTS)
                          + FE.decay_columns("genre_dow", K.DOW_DECAY_WEIGHTS)),
    "q_a07_store_diff": (("diff",), KEYS + DF.diff_columns()),
    "q_a08_store_dow_pivot": (("store_dow",), KEYS + FE.dow_pivot_columns()),
    "q_a09_store_holiday": (("store",), KEYS + ["holiday_flg", "holiday_flg2"] + FE.holiday_columns()),
    "q_a10_first_last": (("store",), KEYS + FE.FIRST_LAST_COLUMNS),
    "q_a11_reserve_store": (("reserve",), KEYS + RS.feature_columns("air", "store") + RS.feature_columns("hpg", "store")),
    "q_a13_reserve_date": (("reserve",), KEYS + RS.feature_columns("air", "date") + RS.feature_columns("hpg", "date")),
    "q_f12_ratios": (("ratios",), KEYS + [n for n, _, _ in K.RATIOS]),
}
for _name, (_fams, _cols) in _FAMILY_QUERIES.items():
    _snapshot_query(_name, _fams, _cols)

# the flagship: every family, the whole wide snapshot (J-09)
_ALL = ("weather", "store", "store_dow", "diff", "reserve", "genre", "ratios")
_snapshot_query("q_snapshot", _ALL, O.snapshot_columns(_ALL))


# the store families with a customer as the store (A-01, A-02, A-04, A-05, A-08 ... A-10)
_MANY = ("store", "store_dow")
_MANY_COLUMNS = (KEYS + FE.stats_columns("store") + FE.decay_columns("store", K.DECAY_WEIGHTS) + FE.stats_columns("store_dow")
                 + FE.decay_columns("store_dow", K.DOW_DECAY_WEIGHTS) + FE.FIRST_LAST_COLUMNS)


@register("q_a01_many_stores", O.snapshot_sql(_MANY, _MANY_COLUMNS, O.CUSTOMER_SQL))
def q_a01_many_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = create_snapshots(customer_inputs(spark, sf_dir), fixture_anchors(), families=_MANY)
    return normalize(df.select(*[FE.q(c) for c in _MANY_COLUMNS]))


# weather of the label day itself (observed mode; the reference mode is the
# constant fill value, covered by q_snapshot) (J-08, S-03, P-09)
def _weather_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = create_snapshots(fixture_inputs(spark, sf_dir), fixture_anchors(), families=("weather",),
                          weather_mode="observed")
    return normalize(df.select(*KEYS, "precipitation", "high_temperature"))


register("q_j08_weather_observed", O.weather_observed_sql())(_weather_observed)
