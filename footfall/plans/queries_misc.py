"""Registered queries for filters, id handling and scalar functions
(P-07, P-08, P-10, R-03, F-07, F-08, F-10, F-15, F-16, F-17)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from footfall.functions import id_date, id_store, make_id
from footfall.operators.adjust import comparable_day_adjust, rules_frame
from footfall.operators.reserve import map_ids
from footfall.plans.normalize import normalize
from footfall.plans.oracle import FIXTURE_SQL, normalize_sql, with_ctes
from footfall.plans.queries import register
from footfall.sources import fixtures as FX


def _fx(*names: str) -> dict[str, str]:
    return {n: FIXTURE_SQL[n] for n in names}


_MAPPED_SQL = ("select coalesce(cw.store_id, r.ext_store_id) as store_id, r.* exclude (ext_store_id) "
               "from fx_reserve_b r left join fx_crosswalk cw on r.ext_store_id = cw.ext_store_id")


@register("q_p07_unmapped_ids", with_ctes(_fx("fx_reserve_b", "fx_crosswalk") | {"mapped": _MAPPED_SQL},
          "select store_id, cast(count(*) as bigint) as n from mapped where starts_with(store_id, 'h') group by store_id"))
def q_p07_unmapped_ids(spark, sf):
    """Ids of the second channel that kept their own prefix (no crosswalk match) (P-07, P-10, J-03)."""
    mapped = map_ids(FX.reserve_b(spark, sf), FX.crosswalk(spark, sf))
    out = mapped.where(F.col("store_id").startswith("h")).groupBy("store_id").agg(F.count(F.lit(1)).alias("n"))
    return normalize(out)


@register("q_p08_crosswalked_visits", with_ctes(_fx("fx_visits", "fx_crosswalk"), normalize_sql(
    "select store_id, visit_date, visitors from fx_visits where store_id in (select store_id from fx_crosswalk)",
    ["store_id", "visit_date", "visitors"])))
def q_p08_crosswalked_visits(spark, sf):
    """Visits of stores that have an id in the second channel (P-08, left semi join)."""
    v = FX.visits(spark, sf)
    return normalize(v.join(FX.crosswalk(spark, sf).select("store_id"), "store_id", "left_semi"))


@register("q_r03_inverse_map", with_ctes(_fx("fx_store", "fx_crosswalk"),
          "select s.store_id, cw.ext_store_id from fx_store s left join fx_crosswalk cw on s.store_id = cw.store_id"))
def q_r03_inverse_map(spark, sf):
    """Inverted id dictionary: every store with its second-channel id, if any (R-03)."""
    inv = FX.crosswalk(spark, sf).select("store_id", "ext_store_id")
    return FX.stores(spark, sf).select("store_id").join(inv, "store_id", "left")


@register("q_f07_id_roundtrip", with_ctes(_fx("fx_visits"), normalize_sql("""
    select id, id[:-12] as store_part, cast(right(id, 10) as date) as date_part, visitors from (
      select store_id || '_' || strftime(visit_date, '%Y-%m-%d') as id, visitors from fx_visits)""",
    ["id", "store_part", "date_part", "visitors"], set(), ("store_part",), ("date_part",))))
def q_f07_id_roundtrip(spark, sf):
    """Compose ``<store>_<date>`` ids and split them back (F-07, F-08)."""
    v = FX.visits(spark, sf).select(make_id(F.col("store_id"), F.col("visit_date")).alias("id"), "visitors")
    return normalize(v.select("id", id_store(F.col("id")).alias("store_part"),
                              F.to_date(id_date(F.col("id"))).alias("date_part"), "visitors"))


@register("q_f10_log_target", with_ctes(_fx("fx_visits"), normalize_sql(
    "select store_id, visit_date, ln(1 + visitors) as target, exp(ln(1 + visitors)) - 1 as back from fx_visits",
    ["store_id", "visit_date", "target", "back"])))
def q_f10_log_target(spark, sf):
    """log1p target and its expm1 inverse (F-10)."""
    v = FX.visits(spark, sf)
    t = F.log1p("visitors")
    return normalize(v.select("store_id", "visit_date", t.alias("target"), F.expm1(t).alias("back")))


# fixed values: status letters mapped to classes; unlisted letters map to NULL
STATUS_CODES = {"F": 0, "O": 1}


@register("q_f15_label_map", "select o_orderkey, cast(case o_orderstatus when 'F' then 0 when 'O' then 1 end as bigint) "
                             "as status_code from orders")
def q_f15_label_map(spark, sf):
    """Dictionary map of a label column; values outside the map become NULL (F-15)."""
    m = F.create_map(*[x for k, v in STATUS_CODES.items() for x in (F.lit(k), F.lit(v))])
    o = FX.table(spark, sf, "orders")
    return normalize(o.select("o_orderkey", m[F.col("o_orderstatus")].alias("status_code")))


@register("q_f16_abs_round", normalize_sql(
    "select l_orderkey, l_linenumber, l_partkey, cast(round_even(cast(cast(abs(l_extendedprice * l_discount "
    "- l_tax * 1000) as varchar) as decimal(38, 20)), 2) as double) as gap from lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "gap"], {"l_orderkey", "l_linenumber", "l_partkey"}))
def q_f16_abs_round(spark, sf):
    """Absolute value, rounded to 2 decimals, half-to-even on the value's
    shortest decimal form (F-16)."""
    li = FX.table(spark, sf, "lineitem")
    gap = F.bround(F.abs(F.col("l_extendedprice") * F.col("l_discount") - F.col("l_tax") * 1000), 2)
    return normalize(li.select("l_orderkey", "l_linenumber", "l_partkey", gap.alias("gap")))


# fixed values: comparable-day rule of the original (targets 3 days from
# 05-03 and the day before, against 04-29 / 05-13 and the days before them),
# placed in the fixture year
_Y = 2001
ADJUST_START, ADJUST_D1, ADJUST_D2 = date(_Y, 5, 3), date(_Y, 4, 29), date(_Y, 5, 13)
ADJUST_RULES = ([(ADJUST_START + timedelta(days=i), ADJUST_D1, ADJUST_D2) for i in range(3)]
                + [(ADJUST_START - timedelta(days=1), ADJUST_D1 - timedelta(days=1), ADJUST_D2 - timedelta(days=1))])


def _rules_sql() -> str:
    rows = ", ".join(f"(date '{t}', date '{a}', date '{b}')" for t, a, b in ADJUST_RULES)
    return f"select * from (values {rows}) r(target_date, d1, d2)"


@register("q_f17_day_adjust", with_ctes(_fx("fx_visits") | {"rules": _rules_sql()}, normalize_sql("""
    select p.store_id, p.visit_date,
           case when r.target_date is not null then sqrt(a.visitors * b.visitors) else p.visitors end as visitors
    from fx_visits p left join rules r on p.visit_date = r.target_date
    left join fx_visits a on a.store_id = p.store_id and a.visit_date = r.d1
    left join fx_visits b on b.store_id = p.store_id and b.visit_date = r.d2""",
    ["store_id", "visit_date", "visitors"])))
def q_f17_day_adjust(spark, sf):
    """Geometric mean of two comparable days replaces the target days (F-17)."""
    out = comparable_day_adjust(FX.visits(spark, sf), rules_frame(spark, ADJUST_RULES))
    return normalize(out)
