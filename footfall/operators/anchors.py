"""Snapshot anchors (end_date, horizon) and their range join with dated rows.

Anchors are a small driver-side list (one entry per snapshot the caller asks
for, 64 in the original training run).  Instead of a nested-loop range join,
every dated row carries the anchors whose window covers it: the anchor list is
a literal array, the covering anchors are picked with ``filter`` and
``explode``d.  That stays inside whole-stage codegen and never shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import constants as K


@dataclass(frozen=True, order=True)
class Anchor:
    end_date: date
    horizon: int


def training_anchors(start: date) -> tuple[list[Anchor], Anchor]:
    """Weekly training anchors back from ``start`` plus forward ones, and the
    test anchor (V-08)."""
    back = [Anchor(start + timedelta(days=-7 * i), K.TRAIN_HORIZON) for i in range(K.TRAIN_BACK_WEEKS)]
    fwd = [Anchor(start + timedelta(days=7 * i), K.FORWARD_HORIZON_BASE - 7 * i)
           for i in range(1, K.FORWARD_WEEKS + 1)]
    test = Anchor(start + timedelta(days=K.TEST_OFFSET_DAYS), K.TRAIN_HORIZON)
    return back + fwd, test


def anchors_frame(spark: SparkSession, anchors: Iterable[Anchor]) -> DataFrame:
    """Anchors as a tiny DataFrame (S-07)."""
    rows = [(a.end_date, int(a.horizon)) for a in anchors]
    return spark.createDataFrame(rows, "end_date date, horizon int")


def _anchor_array(anchors: Iterable[Anchor]) -> Column:
    return F.array(*[F.struct(F.lit(a.end_date).alias("end_date"), F.lit(int(a.horizon)).alias("horizon"))
                     for a in sorted(set(anchors))])


def explode_anchors(df: DataFrame, anchors: Iterable[Anchor],
                    covers: Callable[[Column], Column]) -> DataFrame:
    """Attach ``end_date``/``horizon`` for every anchor ``a`` with ``covers(a)``.

    ``covers`` receives the anchor struct (fields end_date, horizon) and
    returns a boolean expression over it and the row's columns.
    """
    arr = F.filter(_anchor_array(anchors), covers)
    return (df.withColumn("_anchor", F.explode(arr))
              .withColumn("end_date", F.col("_anchor.end_date"))
              .withColumn("horizon", F.col("_anchor.horizon"))
              .drop("_anchor"))


def in_horizon(d: Column) -> Callable[[Column], Column]:
    """Half-open horizon [end, end + horizon) (P-05)."""
    return lambda a: (a["end_date"] <= d) & (d < F.date_add(a["end_date"], a["horizon"]))


def in_lookback(d: Column, n_days: int) -> Callable[[Column], Column]:
    """Lookback exclusive at both ends: end - n < d < end (P-04)."""
    return lambda a: (d < a["end_date"]) & (d > F.date_sub(a["end_date"], n_days))


def horizon_bounds(anchors: Iterable[Anchor]) -> tuple[date, date]:
    """Smallest first day and largest last day (exclusive) of all horizons."""
    anchors = list(anchors)
    lo = min(a.end_date for a in anchors)
    hi = max(a.end_date + timedelta(days=a.horizon) for a in anchors)
    return lo, hi


def lookback_bounds(anchors: Iterable[Anchor], n_days: int) -> tuple[date, date]:
    """Exclusive global bounds of all lookback windows; used as a plain
    ``where`` so the range reaches the Parquet scan as pushed filters."""
    anchors = list(anchors)
    lo = min(a.end_date for a in anchors) - timedelta(days=n_days)
    hi = max(a.end_date for a in anchors)
    return lo, hi
