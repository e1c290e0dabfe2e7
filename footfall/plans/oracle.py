"""DuckDB SQL for the registered queries (the correctness oracle).

The SQL is written independently of the Spark plans: per-anchor range joins
instead of exploded arrays, DuckDB's own bias-corrected ``skewness`` /
``kurtosis`` instead of the corrected Spark moments, and ``dense_rank`` +
``lag`` per (anchor, store) for adjacent-date differences.  It reads the
driver tables, which are pre-registered as views.
"""

from __future__ import annotations

import re

from footfall import constants as K
from footfall.operators import diffs as DF
from footfall.operators import features as FE
from footfall.operators import reserve as RS
from footfall.plans.snapshot import LABEL_COLUMNS, feature_columns
from footfall.sources import fixtures as FX

# ------------------------------------------------------------ fixtures ----
FIXTURE_SQL = {
    "fx_store": """select cast(n_nationkey as varchar) as store_id, r_name as genre_name,
        r_name || ' ' || n_name as area_name
        from nation join region on n_regionkey = r_regionkey""",
    "fx_visits": """select cast(c_nationkey as varchar) as store_id, cast(o_orderdate as date) as visit_date,
        sum(l_quantity) as visitors
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
        group by c_nationkey, cast(o_orderdate as date)""",
    "fx_reserve_a": """select cast(c_nationkey as varchar) as store_id, o_orderdate as reserve_ts,
        l_shipdate as visit_ts, l_quantity as reserve_visitors
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "fx_reserve_b": """select 'h' || cast(l_suppkey as varchar) as ext_store_id, o_orderdate as reserve_ts,
        l_shipdate as visit_ts, l_quantity as reserve_visitors
        from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R'""",
    "fx_crosswalk": """select 'h' || cast(min(s_suppkey) as varchar) as ext_store_id,
        cast(s_nationkey as varchar) as store_id
        from supplier where s_suppkey % 2 = 0 group by s_nationkey""",
    "fx_station_weather": f"""select s_nationkey % {FX.FIXTURE_STATIONS} as station_id,
        cast(l_shipdate as date) as visit_date, min(l_discount) as precipitation, max(l_tax) as high_temperature
        from lineitem join supplier on l_suppkey = s_suppkey
        group by s_nationkey % {FX.FIXTURE_STATIONS}, cast(l_shipdate as date)""",
    "fx_weather": f"""select st.store_id, w.visit_date, w.precipitation, w.high_temperature
        from (select store_id, cast(store_id as integer) % {FX.FIXTURE_STATIONS} as station_id from fx_store) st
        join fx_station_weather w on st.station_id = w.station_id""",
    "fx_calendar": f"""select cast(d as date) as visit_date,
        case when day(d) in {tuple(FX.FIXTURE_HOLIDAY_DAYS)} then 1 else 0 end as holiday_flg
        from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)""",
}


# the same facts with a customer as the store: many stores
CUSTOMER_SQL = {
    "fx_store": """select cast(c_custkey as varchar) as store_id, c_mktsegment as genre_name,
        c_mktsegment || ' ' || cast(c_nationkey as varchar) as area_name from customer""",
    "fx_visits": """select cast(o_custkey as varchar) as store_id, cast(o_orderdate as date) as visit_date,
        sum(l_quantity) as visitors from lineitem join orders on l_orderkey = o_orderkey
        group by o_custkey, cast(o_orderdate as date)""",
}

FIXTURE_SQL.update({
    "fx_reg": """select o_orderkey, count(*) as n_lines, sum(l_quantity) as qty, max(l_discount) as max_disc,
        o_orderpriority, o_totalprice as y
        from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderpriority, o_totalprice""",
    "fx_clf": """select labels.doc_id, n_chars, lang, source, quality as y, toxic
        from labels join documents on labels.doc_id = documents.doc_id""",
    "fx_cat": """select p_partkey, p_brand, p_type, p_size, case when p_retailprice >= 950 then 1 else 0 end as y
        from part""",
    "fx_scores": """select doc_id, y, (n_chars % 1000) / 1000.0::double as score from fx_clf""",
    "fx_multi": """select vec_id, label as y, cast((vec_id * 7) % 10 as integer) as pred from embeddings""",
})


def md5_mod_sql(key: str, k: int) -> str:
    return f"((('0x' || substr(md5(cast({key} as varchar)), 1, 8))::bigint) % {k})"


def _anchor_values() -> str:
    rows = ", ".join(f"(date '{a.end_date.isoformat()}', {a.horizon})" for a in FX.fixture_anchors())
    return f"select * from (values {rows}) t(end_date, horizon)"


SNAPSHOT_CTES = {
    "anchors": _anchor_values(),
    "sdim": """select store_id, dense_rank() over (order by genre_name) - 1 as air_genre_name,
        area_name as air_area_name,
        dense_rank() over (order by split_part(area_name, ' ', 1)) - 1 as air_area_name0 from fx_store""",
    "cal": """select visit_date, holiday_flg,
        case when isodow(visit_date) - 1 > 4 or holiday_flg = 1 then 1 else 0 end as holiday_flg2,
        case when isodow(visit_date) - 1 = 5 then 1 else 0 end as friday_flg,
        case when isodow(visit_date) - 1 > 5 then 1 else 0 end as weekend_flg from fx_calendar""",
    "base": """select v.store_id, v.visit_date, ln(1 + v.visitors) as visitors,
        isodow(v.visit_date) - 1 as dow, month(v.visit_date) as month,
        v.store_id || '_' || strftime(v.visit_date, '%Y-%m-%d') as id,
        s.air_genre_name, s.air_area_name, s.air_area_name0,
        c.holiday_flg, c.holiday_flg2, c.friday_flg, c.weekend_flg
        from fx_visits v left join sdim s on v.store_id = s.store_id left join cal c on v.visit_date = c.visit_date""",
    "hist": f"""select a.end_date, b.*, date_diff('day', b.visit_date, a.end_date) as age
        from base b join (select distinct end_date from anchors) a
        on b.visit_date < a.end_date and b.visit_date > a.end_date - {max(K.LOOKBACKS)}""",
}


def _label_cte() -> str:
    cols = ["a.end_date", "b.store_id", "b.visit_date", "b.id", "b.visitors", "b.dow",
            "date_diff('day', a.end_date, b.visit_date) as diff_of_day",
            "month(b.visit_date) as month", "year(b.visit_date) as year",
            "b.air_genre_name", "b.air_area_name", "b.air_area_name0",
            "b.holiday_flg", "b.holiday_flg2", "b.friday_flg", "b.weekend_flg"]
    joins = []
    for j, i in enumerate(K.CALENDAR_OFFSETS):
        t = f"c{j}"
        cols += [f'{t}.holiday_flg as "ahead_holiday_{i}"', f'{t}.holiday_flg2 as "ahead_holiday2_{i}"',
                 f'{t}.friday_flg as "ahead_friday_{i}"', f'{t}.weekend_flg as "ahead_weekend_{i}"']
        joins.append(f"left join cal {t} on {t}.visit_date = b.visit_date - ({i})")
    return (f"select {', '.join(cols)} from base b join anchors a "
            f"on b.visit_date >= a.end_date and b.visit_date < a.end_date + a.horizon " + " ".join(joins))


# ------------------------------------------------------- stat snippets ----
SQL_STAT = {
    "min": "min({v})", "max": "max({v})", "mean": "avg({v})", "median": "median({v})",
    "count": "count({v})", "std": "stddev_samp({v})", "skew": "skewness({v})", "kurt": "kurtosis({v})",
    "sum": "sum({v})", "abs_mean": "avg(abs({v}))",
}


def qi(name: str) -> str:
    return '"' + name + '"'


def _stat_sql(stat: str, v: str, cond: str | None) -> str:
    expr = SQL_STAT[stat].format(v=v)
    return f"{expr} filter (where {cond})" if cond else expr


def _lookback_stats(prefix: str) -> list[str]:
    out = []
    for n in K.LOOKBACKS:
        for stat, name in FE.stat_names(prefix, n).items():
            out.append(f"{_stat_sql(stat, 'visitors', f'age < {n}')} as {qi(name)}")
    return out


def _decay(level: str, weights) -> list[str]:
    out = []
    n = K.LONG_WINDOW
    for w, mean_name, wsum_name in FE.decay_names(level, n, weights):
        wt = f"pow({w!r}, age)"
        out.append(f"sum(visitors * {wt}) filter (where age < {n}) / sum({wt}) filter (where age < {n}) as {qi(mean_name)}")
        out.append(f"sum({wt}) filter (where age < {n}) as {qi(wsum_name)}")
    return out


def _fill(cols: list[str], src: str) -> list[str]:
    return [f"coalesce({src}.{qi(c)}, 0) as {qi(c)}" for c in cols]


# ------------------------------------------------------ family blocks ----
def _family_ctes() -> dict[str, str]:
    n = K.LONG_WINDOW
    ctes = {}
    ctes["f_store"] = (f"select end_date, store_id, {', '.join(_lookback_stats('store') + _decay('store', K.DECAY_WEIGHTS))}, "
                       f"date_diff('day', min(visit_date) filter (where age < {n}), end_date) as first_time, "
                       f"date_diff('day', max(visit_date) filter (where age < {n}), end_date) as last_time "
                       f"from hist group by end_date, store_id")
    ctes["f_store_dow"] = (f"select end_date, store_id, dow, "
                           f"{', '.join(_lookback_stats('store_dow') + _decay('store_dow', K.DOW_DECAY_WEIGHTS))} "
                           f"from hist group by end_date, store_id, dow")
    for flag, prefix in (("holiday_flg", "store_holiday"), ("holiday_flg2", "store_holiday2")):
        aggs = [f"{_stat_sql(s, 'visitors', f'age < {n}')} as {qi(f'{prefix}_{s}{n}')}" for s in FE.HOLIDAY_STATS]
        ctes[f"f_{prefix}"] = (f"select end_date, store_id, {flag}, {', '.join(aggs)} from hist "
                               f"where age < {n} group by end_date, store_id, {flag}")
    ctes["f_genre"] = (f"select end_date, air_genre_name, "
                       f"{', '.join(_lookback_stats('genre') + _decay('genre', K.DECAY_WEIGHTS))} "
                       f"from hist where air_genre_name is not null group by end_date, air_genre_name")
    ctes["f_genre_dow"] = (f"select end_date, air_genre_name, dow, "
                           f"{', '.join(_lookback_stats('genre_dow') + _decay('genre_dow', K.DOW_DECAY_WEIGHTS))} "
                           f"from hist where air_genre_name is not null group by end_date, air_genre_name, dow")
    # adjacent observed dates, per anchor window (brute force)
    for w in K.DIFF_WINDOWS:
        ctes[f"dw{w}"] = f"select end_date, store_id, visit_date, visitors from hist where age < {w}"
        ctes[f"dr{w}"] = (f"select end_date, visit_date, dense_rank() over (partition by end_date order by visit_date) as rk "
                          f"from (select distinct end_date, visit_date from dw{w})")
        ctes[f"dl{w}"] = (f"select x.end_date, x.store_id, x.visitors - lag(x.visitors) over p as diff, "
                          f"r.rk - lag(r.rk) over p as gap from dw{w} x join dr{w} r "
                          f"on x.end_date = r.end_date and x.visit_date = r.visit_date "
                          f"window p as (partition by x.end_date, x.store_id order by x.visit_date)")
        stats = {"abs_mean": f"store_diff_mean_{w}", "std": f"store_diff_std_{w}", "max": f"store_diff_max_{w}",
                 "min": f"store_diff_min_{w}", "skew": f"store_diff_skew_{w}", "kurt": f"store_diff_kurtosis_{w}"}
        aggs = [f"{_stat_sql(s, 'diff', None)} as {qi(name)}" for s, name in stats.items()]
        ctes[f"f_diff{w}"] = (f"select end_date, store_id, {', '.join(aggs)} from dl{w} where gap = 1 "
                              f"group by end_date, store_id")
    # reservations
    ctes["ra"] = ("select store_id, cast(visit_ts as date) as visit_date, cast(reserve_ts as date) as reserve_date, "
                  "reserve_visitors, cast(floor(date_diff('second', reserve_ts, visit_ts) / 86400.0) as double) as diff_time "
                  "from fx_reserve_a where store_id in (select store_id from fx_store)")
    ctes["rb"] = ("select coalesce(cw.store_id, r.ext_store_id) as store_id, cast(visit_ts as date) as visit_date, "
                  "cast(reserve_ts as date) as reserve_date, reserve_visitors, "
                  "cast(floor(date_diff('second', reserve_ts, visit_ts) / 86400.0) as double) as diff_time "
                  "from fx_reserve_b r left join fx_crosswalk cw on r.ext_store_id = cw.ext_store_id")
    for ch, src in (("air", "ra"), ("hpg", "rb")):
        ctes[f"v{ch}"] = (f"select a.end_date, x.* from {src} x join anchors a on x.visit_date >= a.end_date "
                          f"and x.visit_date < a.end_date + a.horizon and x.reserve_date < a.end_date")
        for level, keys in (("store", "end_date, store_id, visit_date"), ("date", "end_date, visit_date")):
            aggs = [f"{_stat_sql(s, 'reserve_visitors', None)} as {qi(nm)}" for s, nm in RS.VISITOR_NAMES[(ch, level)].items()]
            aggs += [f"{_stat_sql(s, 'diff_time', None)} as {qi(nm)}" for s, nm in RS.LEAD_NAMES[(ch, level)].items()]
            ctes[f"f_{ch}_{level}"] = f"select {keys}, {', '.join(aggs)} from v{ch} group by {keys}"
    return ctes


def _snapshot_select(families) -> tuple[str, list[str]]:
    """(FROM clause with joins, select expressions) for the wanted families."""
    n = K.LONG_WINDOW
    sel = [f"l.{qi(c)}" for c in LABEL_COLUMNS]
    joins = ["label l"]
    fam = set(families)
    if "weather" in fam:
        sel += [f"{K.WEATHER_FILL} as {qi(m)}" for m in ("precipitation", "high_temperature")]
    if "store" in fam:
        joins.append("left join f_store fs on fs.end_date = l.end_date and fs.store_id = l.store_id")
        sel += _fill(FE.store_columns(), "fs")
        for prefix in ("store_holiday", "store_holiday2"):
            flag = "holiday_flg" if prefix == "store_holiday" else "holiday_flg2"
            t = "fh1" if prefix == "store_holiday" else "fh2"
            joins.append(f"left join f_{prefix} {t} on {t}.end_date = l.end_date and {t}.store_id = l.store_id "
                         f"and {t}.{flag} = l.{flag}")
            sel += _fill([f"{prefix}_{s}{n}" for s in FE.HOLIDAY_STATS], t)
        sel += _fill(FE.FIRST_LAST_COLUMNS, "fs")
    if "store_dow" in fam:
        joins.append("left join f_store_dow fd on fd.end_date = l.end_date and fd.store_id = l.store_id and fd.dow = l.dow")
        sel += _fill(FE.store_dow_columns(), "fd")
        for i in FE.DOW_VALUES:
            t = f"p{i}"
            joins.append(f"left join f_store_dow {t} on {t}.end_date = l.end_date and {t}.store_id = l.store_id and {t}.dow = {i}")
            sel += [f"coalesce({t}.{qi(f'store_dow_{s}{n}')}, 0) as {qi(f'{i}store_dow_{s}{n}')}" for s in FE.DOW_PIVOT_STATS]
            sel.append(f"case when {t}.dow is not null then {i} else 0 end as {qi(f'{i}dow')}")
    if "diff" in fam:
        for w in K.DIFF_WINDOWS:
            t = f"dd{w}"
            joins.append(f"left join f_diff{w} {t} on {t}.end_date = l.end_date and {t}.store_id = l.store_id")
            sel += _fill([c for c in DF.diff_columns([w])], t)
    if "reserve" in fam:
        for ch in ("air", "hpg"):
            t = f"rs_{ch}"
            joins.append(f"left join f_{ch}_store {t} on {t}.end_date = l.end_date and {t}.store_id = l.store_id "
                         f"and {t}.visit_date = l.visit_date")
            sel += _fill(RS.feature_columns(ch, "store"), t)
        for ch in ("air", "hpg"):
            t = f"rd_{ch}"
            joins.append(f"left join f_{ch}_date {t} on {t}.end_date = l.end_date and {t}.visit_date = l.visit_date")
            sel += _fill(RS.feature_columns(ch, "date"), t)
    if "genre" in fam:
        joins.append("left join f_genre fg on fg.end_date = l.end_date and fg.air_genre_name = l.air_genre_name")
        sel += _fill(FE.genre_columns(), "fg")
        joins.append("left join f_genre_dow fgd on fgd.end_date = l.end_date and fgd.air_genre_name = l.air_genre_name "
                     "and fgd.dow = l.dow")
        sel += _fill(FE.genre_dow_columns(), "fgd")
    return " ".join(joins), sel


INT_NAME = re.compile(r"(count\d*$|^\d?dow$|^first_time$|^last_time$|^diff_of_day$|^month$|^year$|"
                      r"^air_genre_name$|^air_area_name0$|_flg2?$|^ahead_)")
TEXT_NAMES = {"store_id", "id", "air_area_name", "ext_store_id"}
DATE_NAMES = {"end_date", "visit_date"}


def normalize_sql(inner: str, columns: list[str], int_cols=None, text_cols=(), date_cols=(),
                  keep_cols=(), digits: int = 6) -> str:
    """Cast integers to BIGINT and round doubles to 6 decimals (-0.0 -> 0.0);
    ``keep_cols`` (e.g. timestamps) pass through."""
    out = []
    for c in columns:
        if c in keep_cols:
            out.append(qi(c))
        elif c in TEXT_NAMES or c in text_cols:
            out.append(f"cast({qi(c)} as varchar) as {qi(c)}")
        elif c in DATE_NAMES or c in date_cols:
            out.append(f"cast({qi(c)} as date) as {qi(c)}")
        elif (int_cols is not None and c in int_cols) or (int_cols is None and INT_NAME.search(c)):
            out.append(f"cast({qi(c)} as bigint) as {qi(c)}")
        else:
            out.append(f"round(cast({qi(c)} as double), {digits}) + 0.0 as {qi(c)}")
    return f"select {', '.join(out)} from ({inner}) q"


def with_ctes(ctes: dict[str, str], body: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n" + body


def snapshot_sql(families, columns: list[str], fixtures: dict[str, str] | None = None) -> str:
    """Snapshot SQL restricted to ``columns`` (label keys + family features);
    ``fixtures`` replaces input relations."""
    fam = set(families)
    need = set(fam)
    if "ratios" in fam:
        need |= {"store", "genre"}
    ctes = {**FIXTURE_SQL, **(fixtures or {})}
    ctes.update(SNAPSHOT_CTES)
    ctes["label"] = _label_cte()
    ctes.update(_family_ctes())
    frm, sel = _snapshot_select(need)
    body = f"select {', '.join(sel)} from {frm}"
    if "ratios" in fam:
        ratio = [f"{qi(a)} / ({qi(b)} + {K.RATIO_EPS}) as {qi(nm)}" for nm, a, b in K.RATIOS]
        body = f"select *, {', '.join(ratio)} from ({body}) s"
    return with_ctes(ctes, normalize_sql(body, columns))


def snapshot_columns(families) -> list[str]:
    return LABEL_COLUMNS + feature_columns(families, ("precipitation", "high_temperature"))


def weather_observed_sql() -> str:
    """Label rows left-joined to their own day's weather; no match -> -1."""
    ctes = dict(FIXTURE_SQL)
    ctes.update(SNAPSHOT_CTES)
    ctes["label"] = _label_cte()
    body = (f"select l.end_date, l.store_id, l.visit_date, "
            f"coalesce(w.precipitation, {K.WEATHER_FILL}) as precipitation, "
            f"coalesce(w.high_temperature, {K.WEATHER_FILL}) as high_temperature "
            f"from label l left join fx_weather w on w.store_id = l.store_id and w.visit_date = l.visit_date")
    return with_ctes(ctes, normalize_sql(body, ["end_date", "store_id", "visit_date", "precipitation",
                                                "high_temperature"]))
