"""Registered profiling queries (A-15 ... A-24, O-02, U-01, P-12, F-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.functions import split_part
from footfall.operators import profile as P
from footfall.plans.normalize import normalize
from footfall.plans.oracle import FIXTURE_SQL, normalize_sql, with_ctes
from footfall.plans.queries import register
from footfall.sources import fixtures as FX


def _fx(*names: str) -> dict[str, str]:
    return {n: FIXTURE_SQL[n] for n in names}


def _sql(ctes: dict[str, str], body: str, columns: list[str], int_cols=(), text_cols=(), date_cols=()) -> str:
    return with_ctes(ctes, normalize_sql(body, columns, set(int_cols), text_cols, date_cols)) if ctes else \
        normalize_sql(body, columns, set(int_cols), text_cols, date_cols)


# A-15: null count per column of the mapped second reservation channel
_RB_COLS = ["ext_store_id", "reserve_ts", "visit_ts", "reserve_visitors", "store_id"]


@register("q_a15_null_counts", with_ctes(
    _fx("fx_reserve_b", "fx_crosswalk") | {
        "mapped": "select r.*, cw.store_id from fx_reserve_b r left join fx_crosswalk cw "
                  "on r.ext_store_id = cw.ext_store_id"},
    " union all ".join(f"select '{c}' as column_name, cast(count(*) filter (where {c} is null) as bigint) "
                       f"as null_count from mapped" for c in _RB_COLS)))
def q_a15_null_counts(spark, sf):
    rb = FX.reserve_b(spark, sf)
    cw = FX.crosswalk(spark, sf)
    mapped = rb.join(cw, "ext_store_id", "left").select(*_RB_COLS)
    return normalize(P.null_counts(mapped))


@register("q_a16_value_counts", "select event_type, cast(count(*) as bigint) as n from events "
                                "where event_type is not null group by event_type")
def q_a16_value_counts(spark, sf):
    return normalize(P.value_counts(FX.table(spark, sf, "events"), "event_type"))


# F-09 + A-16: frequency of each whitespace-separated part of the area name
@register("q_f09_area_parts", with_ctes(_fx("fx_store"), """
    select part_no, part, cast(count(*) as bigint) as n from (
      select 0 as part_no, regexp_split_to_array(area_name, '\\s+')[1] as part from fx_store
      union all select 1, regexp_split_to_array(area_name, '\\s+')[2] from fx_store
      union all select 2, regexp_split_to_array(area_name, '\\s+')[3] from fx_store) t
    where part is not null group by part_no, part"""))
def q_f09_area_parts(spark, sf):
    st = FX.stores(spark, sf)
    parts = None
    for i in range(3):
        one = st.select(F.lit(i).alias("part_no"), split_part(F.col("area_name"), i).alias("part"))
        parts = one if parts is None else parts.unionByName(one)
    counts = parts.where(F.col("part").isNotNull()).groupBy("part_no", "part").agg(F.count(F.lit(1)).alias("n"))
    return normalize(counts)


@register("q_a17_relative_freq", _sql({}, "select quality, count(*) as n, count(*) / sum(count(*)) over () as share "
                                         "from labels where quality is not null group by quality",
                                     ["quality", "n", "share"], int_cols=("quality", "n")))
def q_a17_relative_freq(spark, sf):
    return normalize(P.relative_frequency(FX.table(spark, sf, "labels"), "quality"))


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]   # lineitem columns 4:7


@register("q_a18_describe", _sql({}, " union all ".join(
    f"select '{c}' as column_name, count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std, "
    f"min({c}) as min, quantile_cont({c}, 0.25) as p25, quantile_cont({c}, 0.5) as p50, "
    f"quantile_cont({c}, 0.75) as p75, max({c}) as max from lineitem" for c in _DESC_COLS),
    ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"],
    int_cols=("count",), text_cols=("column_name",)))
def q_a18_describe(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    sliced = P.positional_slice(li, 4, 7)
    return normalize(P.describe(sliced, sliced.columns))


@register("q_a19_min_max", "select min(o_orderdate) as min_value, max(o_orderdate) as max_value from orders")
def q_a19_min_max(spark, sf):
    return normalize(P.min_max(FX.table(spark, sf, "orders"), "o_orderdate"))


@register("q_a20_distinct", with_ctes(_fx("fx_reserve_b"),
                                      "select cast(count(distinct ext_store_id) as bigint) as n_distinct from fx_reserve_b"))
def q_a20_distinct(spark, sf):
    return normalize(P.distinct_count(FX.reserve_b(spark, sf), "ext_store_id"))


@register("q_a21_hour_weekday", _sql({}, "select hour(ts) as hour, " + ", ".join(
    f"sum(value) filter (where dayname(ts) = '{d}') as {d}" for d in P.DAY_NAMES) + " from events group by hour(ts)",
    ["hour"] + P.DAY_NAMES, int_cols=("hour",)))
def q_a21_hour_weekday(spark, sf):
    return normalize(P.hour_by_dayname(FX.table(spark, sf, "events"), "ts", "value"))


@register("q_a22_resample_daily", _sql({}, """
    select s.period, coalesce(t.total, 0) as total from
      (select cast(unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as date) as period
       from events) s
    left join (select cast(ts as date) as period, sum(value) as total from events group by 1) t on s.period = t.period""",
    ["period", "total"], date_cols=("period",)))
def q_a22_resample_daily(spark, sf):
    return normalize(P.resample_sum(FX.table(spark, sf, "events"), "ts", "value", "D"))


@register("q_a22_resample_monthly", _sql(_fx("fx_reserve_a"), """
    select s.period, coalesce(t.total, 0) as total from
      (select cast(last_day(m) as date) as period from
         (select unnest(generate_series(date_trunc('month', min(visit_ts)), date_trunc('month', max(visit_ts)),
                                        interval 1 month)) as m from fx_reserve_a)) s
    left join (select last_day(visit_ts) as period, sum(reserve_visitors) as total from fx_reserve_a group by 1) t
    on s.period = t.period""", ["period", "total"], date_cols=("period",)))
def q_a22_resample_monthly(spark, sf):
    return normalize(P.resample_sum(FX.reserve_a(spark, sf), "visit_ts", "reserve_visitors", "M"))


@register("q_a23_store_totals", _sql(_fx("fx_visits"),
                                     "select store_id, sum(visitors) as total from fx_visits group by store_id",
                                     ["store_id", "total"]))
def q_a23_store_totals(spark, sf):
    return normalize(P.totals_ranked(FX.visits(spark, sf), "store_id", "visitors"))


@register("q_o02_top_stores", _sql(_fx("fx_visits"), "select store_id, sum(visitors) as total from fx_visits "
                                   "group by store_id order by total desc, store_id limit 5", ["store_id", "total"]))
def q_o02_top_stores(spark, sf):
    totals = FX.visits(spark, sf).groupBy("store_id").agg(F.sum("visitors").alias("total"))
    return normalize(P.top_k(totals, "total", 5, "store_id"))


@register("q_a24_size_histogram", _sql(_fx("fx_reserve_b"), """
    with sizes as (select ext_store_id, count(*) as size from fx_reserve_b group by ext_store_id),
    rng as (select min(size) as lo, max(size) as hi from sizes),
    counts as (select least(floor((size - lo) * 100 / (case when hi > lo then hi - lo else 1 end)), 99) as bin,
                      count(*) as n_keys from sizes, rng group by 1),
    spine as (select range as bin, lo + range * (hi - lo) / 100 as left_edge,
                     lo + (range + 1) * (hi - lo) / 100 as right_edge from rng, range(100))
    select spine.bin, left_edge, right_edge, coalesce(n_keys, 0) as n_keys
    from spine left join counts on spine.bin = counts.bin""",
    ["bin", "left_edge", "right_edge", "n_keys"], int_cols=("bin", "n_keys")))
def q_a24_size_histogram(spark, sf):
    return normalize(P.group_size_histogram(FX.reserve_b(spark, sf), "ext_store_id", 100))


@register("q_u01_union", with_ctes(_fx("fx_reserve_a", "fx_reserve_b"), normalize_sql(
    "select store_id, null as ext_store_id, reserve_ts, visit_ts, reserve_visitors from fx_reserve_a "
    "union all select null, ext_store_id, reserve_ts, visit_ts, reserve_visitors from fx_reserve_b",
    ["store_id", "ext_store_id", "reserve_ts", "visit_ts", "reserve_visitors"], set(), (), (),
    keep_cols=("reserve_ts", "visit_ts"))))
def q_u01_union(spark, sf):
    return normalize(P.union_by_name(FX.reserve_a(spark, sf), FX.reserve_b(spark, sf)))
