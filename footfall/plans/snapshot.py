"""Point-in-time feature snapshots for many anchors in one Spark job.

Plan shape (all anchors at once; the original loops 64 times):

    base ─┬─ explode(horizon anchors) ─ labels ─┐
          └─ explode(lookback anchors) ─ history ┤ groupBy families ──┐
    reservations ─ explode(anchors) ─ groupBy ───┤                    │
                                                 └─ left joins on (end_date, store_id) ─ ratios

History rows are shuffled once, by store, before the anchors multiply them, so
what a store family shuffles does not grow with the anchors: its aggregates run
where the rows are, and one row an anchor and store goes on to the label rows.
The label table is hash-partitioned once by (end_date, store_id).  Genre and per-day reservation totals are
small blocks with a checked or proven size and are broadcast.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.operators import diffs, features as FE, reserve as RS, weather as WX
from footfall.operators.anchors import Anchor, horizon_bounds
from footfall.session import materialize
from footfall.operators.snapshot import base_fact, calendar_dim, history, label_rows, store_dim

ALL_FAMILIES = ("store", "store_dow", "diff", "genre", "reserve", "weather", "ratios")
KEY = ["end_date", "store_id"]

LABEL_COLUMNS = [
    "end_date", "store_id", "visit_date", "id", "visitors", "dow", "diff_of_day", "month", "year",
    "air_genre_name", "air_area_name", "air_area_name0",
    "holiday_flg", "holiday_flg2", "friday_flg", "weekend_flg",
] + [f"ahead_{k}_{i}" for i in K.CALENDAR_OFFSETS for k in ("holiday", "holiday2", "friday", "weekend")]


@dataclass
class ForecastInputs:
    visits: DataFrame            # store_id, visit_date, visitors
    stores: DataFrame            # store_id, genre_name, area_name
    calendar: DataFrame          # visit_date, holiday_flg
    reserve_a: DataFrame | None = None    # store_id, reserve_ts, visit_ts, reserve_visitors
    reserve_b: DataFrame | None = None    # ext_store_id, reserve_ts, visit_ts, reserve_visitors
    crosswalk: DataFrame | None = None    # ext_store_id, store_id
    weather: DataFrame | None = None      # store_id, visit_date, measures...
    weather_measures: list[str] = field(default_factory=list)
    submission: DataFrame | None = None   # id = <store>_<date>
    store_extra: list[str] = field(default_factory=list)   # store attributes kept on label rows


def create_snapshots(inp: ForecastInputs, anchors: list[Anchor], families=ALL_FAMILIES,
                     weather_mode: str = "as_reference", median_mode: str = "exact",
                     lookbacks=K.LOOKBACKS, materialize_base: bool = True) -> DataFrame:
    """One wide row per (anchor, store, horizon day): labels + features.

    The base fact feeds labels, history and differences (about eight
    branches); it is restricted to the dates any anchor can read and written
    once to the checkpoint folder, so no branch recomputes its inputs."""
    per_date = Counter(a.end_date for a in set(anchors))
    if max(per_date.values(), default=0) > 1:
        raise ValueError("two horizons of one end date in a call: rows are keyed by end date; "
                         "make one call a horizon (write_snapshots_incremental does)")
    families = set(families)
    sdim = store_dim(inp.stores, extra=inp.store_extra)
    cal = calendar_dim(inp.calendar)
    base = base_fact(inp.visits, sdim, cal, inp.submission)
    if materialize_base:
        lo = min(a.end_date for a in anchors) - timedelta(days=max(max(lookbacks), max(K.DIFF_WINDOWS)))
        _, hi = horizon_bounds(anchors)
        base = materialize(base.where((F.col("visit_date") > F.lit(lo)) & (F.col("visit_date") < F.lit(hi))))
    label_cols = LABEL_COLUMNS + list(inp.store_extra)
    labels = label_rows(base, anchors, cal).select(*label_cols)
    # the end dates of a store's label rows: no more than the anchors
    ends = labels.groupBy("store_id").agg(F.collect_set("end_date").alias("_ends"))
    out_cols = [F.col(c) for c in label_cols]

    # weather first: it joins on (store_id, visit_date) while labels are narrow
    if "weather" in families and inp.weather_measures:
        labels = WX.weather_features(labels, inp.weather, inp.weather_measures, weather_mode)
        out_cols += [F.col(m) for m in inp.weather_measures]

    # one row a store and day: the rows of one store are as many as the windows
    # have days, so all of them can meet in one task before the anchors multiply
    # them there; each store family then aggregates without another exchange
    hist = history(base, anchors, max(lookbacks))
    # only what a label row asks for
    store_hist = history(base.repartition("store_id").join(ends, "store_id"), anchors, max(lookbacks))
    store_hist = store_hist.where(F.array_contains("_ends", F.col("end_date"))).drop("_ends")
    out = labels
    # ratios read the store and genre means, so those blocks join for them too;
    # their columns are output only when the family itself was asked for
    if "store" in families or "ratios" in families:
        out = out.join(FE.store_block(store_hist, lookbacks, median_mode), KEY, "left")
        if "store" in families:
            out_cols += FE.select_store_features(lookbacks)
    if "store_dow" in families:
        out = out.join(FE.store_dow_pack(store_hist, lookbacks, median_mode), KEY, "left")
        out_cols += FE.select_store_dow_features(lookbacks)
    if "diff" in families:
        out = out.join(diffs.diff_block(base, anchors), KEY, "left")
        out_cols += [FE.fill0(FE.q(c)).alias(c) for c in diffs.diff_columns()]
    if "reserve" in families and inp.reserve_a is not None:
        blocks = RS.reservation_blocks(inp.reserve_a, inp.reserve_b, inp.crosswalk, sdim, anchors)
        out = out.join(blocks["air_pack"], KEY, "left").join(blocks["hpg_pack"], KEY, "left")
        # per-day totals: at most sum(horizons) rows -> broadcast
        dkey = ["end_date", "visit_date"]
        out = out.join(F.broadcast(blocks["air_date"]), dkey, "left")
        out = out.join(F.broadcast(blocks["hpg_date"]), dkey, "left")
        for ch in ("air", "hpg"):
            mine = FE.pick(f"{ch}_pack", "visit_date", F.col("visit_date"))
            out_cols += [FE.fill0(mine[c]).alias(c) for c in RS.feature_columns(ch, "store")]
        for ch in ("air", "hpg"):
            out_cols += [FE.fill0(FE.q(c)).alias(c) for c in RS.feature_columns(ch, "date")]
    if "genre" in families or "ratios" in families:
        out = out.join(FE.genre_block(hist, lookbacks, median_mode), ["end_date", "air_genre_name"], "left")
        if "genre" in families:
            out_cols += FE.select_genre_features(lookbacks)

    if "ratios" in families:
        # the raw means are columns of ``out``; fill and divide in the same projection
        mean = lambda name: FE.fill0(FE.q(name))
        out_cols += [(mean(a) / (mean(b) + F.lit(K.RATIO_EPS))).alias(name) for name, a, b in K.RATIOS]
    return out.select(*out_cols)


def feature_columns(families=ALL_FAMILIES, weather_measures=(), lookbacks=K.LOOKBACKS) -> list[str]:
    """Output feature names (without label columns), in output order."""
    cols: list[str] = []
    families = set(families)
    if "weather" in families:
        cols += list(weather_measures)
    if "store" in families:
        cols += FE.store_columns(lookbacks) + FE.holiday_columns() + FE.FIRST_LAST_COLUMNS
    if "store_dow" in families:
        cols += FE.store_dow_columns(lookbacks) + FE.dow_pivot_columns()
    if "diff" in families:
        cols += diffs.diff_columns()
    if "reserve" in families:
        cols += RS.feature_columns("air", "store") + RS.feature_columns("hpg", "store")
        cols += RS.feature_columns("air", "date") + RS.feature_columns("hpg", "date")
    if "genre" in families:
        cols += FE.genre_columns(lookbacks) + FE.genre_dow_columns(lookbacks)
    if "ratios" in families:
        cols += [n for n, _, _ in K.RATIOS]
    return cols


def write_snapshots_incremental(inputs: ForecastInputs, anchors: list[Anchor], path: str,
                                batch_anchors: int = 8, **kwargs) -> list[Anchor]:
    """Write snapshots in batches of anchors to Parquet partitioned by
    ``horizon`` and ``end_date``; anchors (both) already present under
    ``path`` are skipped.

    Each batch is one job whose exploded history covers only its anchors, and
    a finished batch is durable: a run interrupted by a lost driver or
    executors resumes with the missing anchors only.  Returns the anchors
    written by this call."""
    from footfall.sources.files import path_exists, write_snapshots
    spark = inputs.visits.sparkSession
    done: set = set()
    if path_exists(spark, path):
        done = {Anchor(r["end_date"], int(r["horizon"])) for r in
                spark.read.parquet(path).select("end_date", "horizon").distinct().collect()}
    todo = sorted(set(anchors) - done)
    for horizon in sorted({a.horizon for a in todo}):
        same = [a for a in todo if a.horizon == horizon]
        for i in range(0, len(same), batch_anchors):
            rows = create_snapshots(inputs, same[i:i + batch_anchors], **kwargs)
            write_snapshots(rows.withColumn("horizon", F.lit(horizon)), path, mode="overwrite",
                            partition_cols=("horizon", "end_date"))
    return todo
