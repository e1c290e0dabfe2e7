"""Visitor feature families over the exploded history (A-01 ... A-10).

Shape of the plan: every family is one hash aggregate over ``history``.
Families whose key is finer than (end_date, store_id) -- store x dow --
are aggregated on their own key and then *packed*: a second aggregate
collects the at most 7 per-dow rows into an array per (end_date, store_id).
So all store-level results share the key (end_date, store_id) and the wide
label table is shuffled once to meet them.  Two-valued keys (holiday flags)
are conditional aggregates in the store block itself.

Genre families are keyed by (end_date, genre); genre x dow is packed the
same way.  Genres are few and large: partial aggregation pre-combines every
statistic map-side (the exact median keeps a value->count map per group),
so a genre holding a third of all rows still ships only one partial buffer
per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.functions.stats import STAT_ORDER, stat_aggs

DOW_VALUES = list(range(7))


def q(name: str) -> Column:
    """Column by exact name (feature names contain dots, e.g. ``_0.9``)."""
    return F.col(f"`{name}`")

FLAG_VALUES = [0, 1]


# ---------------------------------------------------------------- names ----
def stat_names(prefix: str, n: int, order=STAT_ORDER) -> dict[str, str]:
    return {s: f"{prefix}_{s}{n}" for s in order}


def decay_names(level: str, n: int, weights) -> list[tuple[float, str, str]]:
    """(weight, mean-name, weight-sum-name) per weight for a level."""
    w = K.fmt_weight
    if level == "store":
        return [(x, f"store_exp{w(x)}_sum{n}", f"store_exp{w(x)}_weight_sum{n}") for x in weights]
    if level == "store_dow":
        return [(x, f"store_dow_exp_sum{n}_{w(x)}", f"store_dow_exp_weight_sum{n}_{w(x)}") for x in weights]
    if level == "genre":
        return [(x, f"genre_exp{w(x)}_sum{n}", f"genre_exp{w(x)}_weight_sum{n}") for x in weights]
    if level == "genre_dow":
        return [(x, f"genre_dow_exp{w(x)}_sum{n}", f"genre_dow_exp{w(x)}_weight_sum{n}") for x in weights]
    raise ValueError(level)


def stats_columns(prefix: str, lookbacks=K.LOOKBACKS) -> list[str]:
    return [name for n in lookbacks for name in stat_names(prefix, n).values()]


def decay_columns(level: str, weights, n: int = K.LONG_WINDOW) -> list[str]:
    return [c for _, a, b in decay_names(level, n, weights) for c in (a, b)]


HOLIDAY_STATS = ["min", "mean", "median", "max", "count", "std", "skew"]
DOW_PIVOT_STATS = ["mean", "median", "max", "count", "min", "std", "skew"]


def holiday_columns(n: int = K.LONG_WINDOW) -> list[str]:
    return ([f"store_holiday_{s}{n}" for s in HOLIDAY_STATS]
            + [f"store_holiday2_{s}{n}" for s in HOLIDAY_STATS])


def dow_pivot_columns(n: int = K.LONG_WINDOW) -> list[str]:
    cols = []
    for i in DOW_VALUES:
        cols += [f"{i}store_dow_{s}{n}" for s in DOW_PIVOT_STATS] + [f"{i}dow"]
    return cols


FIRST_LAST_COLUMNS = ["first_time", "last_time"]


# ----------------------------------------------------------- aggregates ----
def _age_within(n: int) -> Column:
    return F.col("age") < n


def lookback_stat_aggs(prefix: str, lookbacks, median_mode: str) -> list[Column]:
    out = []
    for n in lookbacks:
        out += stat_aggs(F.col("visitors"), stat_names(prefix, n), _age_within(n), median_mode)
    return out


def decay_aggs(level: str, weights, n: int = K.LONG_WINDOW) -> list[Column]:
    """sum(v w^age) / sum(w^age) and sum(w^age) per weight (A-04 ... A-06)."""
    out = []
    within = _age_within(n)
    for w, mean_name, wsum_name in decay_names(level, n, weights):
        wt = F.when(within, F.pow(F.lit(float(w)), F.col("age")))
        num = F.sum(F.col("visitors") * wt)
        den = F.sum(wt)
        out += [(num / den).alias(mean_name), den.alias(wsum_name)]
    return out


def holiday_aggs(median_mode: str, n: int = K.LONG_WINDOW) -> list[Column]:
    """7 stats for holiday_flg = k and holiday_flg2 = k, k in {0, 1} (A-09)."""
    out = []
    for flag, prefix in (("holiday_flg", "store_holiday"), ("holiday_flg2", "store_holiday2")):
        for k in FLAG_VALUES:
            names = {s: f"__{flag}{k}__{prefix}_{s}{n}" for s in HOLIDAY_STATS}
            out += stat_aggs(F.col("visitors"), names, _age_within(n) & (F.col(flag) == k), median_mode)
    return out


def first_last_aggs(n: int = K.LONG_WINDOW) -> list[Column]:
    """Age in days of the first and last visit in the window (A-10)."""
    d = F.when(_age_within(n), F.col("visit_date"))
    return [F.datediff(F.col("end_date"), F.min(d)).alias("first_time"),
            F.datediff(F.col("end_date"), F.max(d)).alias("last_time")]


# --------------------------------------------------------------- blocks ----
def store_block(hist: DataFrame, lookbacks=K.LOOKBACKS, median_mode: str = "exact") -> DataFrame:
    """(end_date, store_id) -> A-01, A-04, A-09 (per flag value), A-10."""
    aggs = (lookback_stat_aggs("store", lookbacks, median_mode)
            + decay_aggs("store", K.DECAY_WEIGHTS)
            + holiday_aggs(median_mode)
            + first_last_aggs())
    return hist.groupBy("end_date", "store_id").agg(*aggs)


def store_dow_pack(hist: DataFrame, lookbacks=K.LOOKBACKS, median_mode: str = "exact") -> DataFrame:
    """(end_date, store_id) -> dow_pack: array of <= 7 structs, one per dow,
    holding A-02 (7 stats x lookbacks) and A-05 (dow decay)."""
    per_dow = (hist.groupBy("end_date", "store_id", "dow")
                   .agg(*(lookback_stat_aggs("store_dow", lookbacks, median_mode)
                          + decay_aggs("store_dow", K.DOW_DECAY_WEIGHTS))))
    fields = [c for c in per_dow.columns if c not in ("end_date", "store_id")]
    return (per_dow.groupBy("end_date", "store_id")
                   .agg(F.collect_list(F.struct(*[q(c) for c in fields])).alias("dow_pack")))


def genre_block(hist: DataFrame, lookbacks=K.LOOKBACKS, median_mode: str = "exact") -> DataFrame:
    """(end_date, air_genre_name) -> A-03 genre stats, A-06 genre decay, and
    genre_dow_pack (A-03 / A-06 per dow)."""
    h = hist.where(F.col("air_genre_name").isNotNull())
    g = h.groupBy("end_date", "air_genre_name").agg(
        *(lookback_stat_aggs("genre", lookbacks, median_mode) + decay_aggs("genre", K.DECAY_WEIGHTS)))
    per_dow = h.groupBy("end_date", "air_genre_name", "dow").agg(
        *(lookback_stat_aggs("genre_dow", lookbacks, median_mode)
          + decay_aggs("genre_dow", K.DOW_DECAY_WEIGHTS)))
    fields = [c for c in per_dow.columns if c not in ("end_date", "air_genre_name")]
    packed = per_dow.groupBy("end_date", "air_genre_name").agg(
        F.collect_list(F.struct(*[q(c) for c in fields])).alias("genre_dow_pack"))
    return g.join(packed, ["end_date", "air_genre_name"], "full")


# ---------------------------------------------------------------- picks ----
def pick(pack: str, key_field: str, key: Column) -> Column:
    """The struct of ``pack`` whose ``key_field`` equals ``key`` (or NULL)."""
    return F.get(F.filter(F.col(pack), lambda x: x[key_field] == key), 0)


def fill0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def store_dow_columns(lookbacks=K.LOOKBACKS) -> list[str]:
    return stats_columns("store_dow", lookbacks) + decay_columns("store_dow", K.DOW_DECAY_WEIGHTS)


def genre_columns(lookbacks=K.LOOKBACKS) -> list[str]:
    return stats_columns("genre", lookbacks) + decay_columns("genre", K.DECAY_WEIGHTS)


def genre_dow_columns(lookbacks=K.LOOKBACKS) -> list[str]:
    return stats_columns("genre_dow", lookbacks) + decay_columns("genre_dow", K.DOW_DECAY_WEIGHTS)


def store_columns(lookbacks=K.LOOKBACKS) -> list[str]:
    return stats_columns("store", lookbacks) + decay_columns("store", K.DECAY_WEIGHTS)


def select_store_features(lookbacks=K.LOOKBACKS) -> list[Column]:
    """Store-level outputs after the label join (NULL -> 0 per family)."""
    cols = [fill0(q(c)).alias(c) for c in store_columns(lookbacks)]
    for flag, prefix in (("holiday_flg", "store_holiday"), ("holiday_flg2", "store_holiday2")):
        for s in HOLIDAY_STATS:
            name = f"{prefix}_{s}{K.LONG_WINDOW}"
            expr = F.when(F.col(flag) == 0, q(f"__{flag}0__{name}")) \
                    .when(F.col(flag) == 1, q(f"__{flag}1__{name}"))
            cols.append(fill0(expr).alias(name))
    cols += [fill0(q(c)).alias(c) for c in FIRST_LAST_COLUMNS]
    return cols


def select_store_dow_features(lookbacks=K.LOOKBACKS) -> list[Column]:
    """A-02 / A-05 for the label's dow, and A-08: all 7 dows as columns."""
    mine = pick("dow_pack", "dow", F.col("dow"))
    cols = [fill0(mine[c]).alias(c) for c in store_dow_columns(lookbacks)]
    n = K.LONG_WINDOW
    for i in DOW_VALUES:
        blk = pick("dow_pack", "dow", F.lit(i))
        for s in DOW_PIVOT_STATS:
            cols.append(fill0(blk[f"store_dow_{s}{n}"]).alias(f"{i}store_dow_{s}{n}"))
        cols.append(F.when(blk.isNotNull(), F.lit(i)).otherwise(F.lit(0)).alias(f"{i}dow"))
    return cols


def select_genre_features(lookbacks=K.LOOKBACKS) -> list[Column]:
    cols = [fill0(q(c)).alias(c) for c in genre_columns(lookbacks)]
    mine = pick("genre_dow_pack", "dow", F.col("dow"))
    cols += [fill0(mine[c]).alias(c) for c in genre_dow_columns(lookbacks)]
    return cols
