"""Platt scaling, the dense grid, level codes and the empty histogram."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import encode as EN
from footfall.operators import profile as PR
from footfall.operators.models.platt import Platt, fit_platt


def test_platt_has_no_gradient_left_and_bounded_separable_fits(spark):
    rng = np.random.default_rng(2)
    f = rng.normal(size=400) * 3
    y = (rng.random(400) < 1 / (1 + np.exp(-1.5 * f + 0.4))).astype(int)
    rows = [(float(a), int(b)) for a, b in zip(f, y)] + [(None, 1), (2.0, None)]
    fit = fit_platt(spark.createDataFrame(rows, "f double, y int"), "f", "y")
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
    p = 1 / (1 + np.exp(fit.a * f + fit.b))
    assert abs(((t - p) * f).sum()) < 1e-5 and abs((t - p).sum()) < 1e-5 and fit.a < -1
    apart = spark.createDataFrame([(float(k), int(k > 0)) for k in (-3, -2, -1, 1, 2, 3)], "f double, y int")
    fit = fit_platt(apart, "f", "y")
    got = [r[0] for r in apart.orderBy("f").select(fit.probability(F.col("f"))).collect()]
    assert got == sorted(got) and 0 < got[1] < 0.4 < 0.6 < got[4] < 1     # smoothed targets: no infinite slope
    assert spark.range(1).select(fit.probability(F.lit(1e300))).first()[0] == 1.0
    assert fit_platt(apart.limit(0), "f", "y") == Platt(0.0, 0.0)


def test_densify_fills_the_grid(spark):
    d = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(5)]
    rows = [("a", d[0], 1.0), ("a", d[4], 2.0), ("a", d[4], 3.0), ("b", d[2], 7.0), ("c", d[0], None), (None, d[1], 9.0), ("b", None, 9.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = {(r.k, r.d): r.v for r in PR.densify(df, "k", "d", "v").collect()}
    dates = [d[0], d[2], d[4]]
    want = {(k, x): 0.0 for k in "abc" for x in dates} | {("a", d[0]): 1.0, ("a", d[4]): 5.0, ("b", d[2]): 7.0}
    assert got == want
    assert PR.densify(df.limit(0), "k", "d", "v").count() == 0


def test_codes_of_many_levels_with_one_prefix_spread_evenly(spark):
    n = 6000
    df = spark.range(n).select(F.format_string("the same long prefix %06d", (F.col("id") * 7919) % n).alias("c"))
    codes = {r.c: r.code for r in EN.level_codes(df, "c").collect()}
    assert [c for c, _ in sorted(codes.items())] == [c for c, _ in sorted(codes.items(), key=lambda kv: kv[1])]
    assert sorted(codes.values()) == list(range(n))
    levels, drawn = EN._drawn_levels(df, "c")
    sizes = [r["count"] for r in levels.groupBy(EN._range_of(F.col("c"), drawn, df.schema["c"].dataType)).count().collect()]
    assert len(drawn) == EN.SAMPLED and max(sizes) < 20 * n / EN.SAMPLED
    for value in (0.5, -3.0, float("inf")):
        few = spark.createDataFrame([(value,), (1.0,), (None,)], "c double")
        assert sorted(r.code for r in EN.level_codes(few, "c").collect()) == [0, 1]


def test_one_hot_levels_are_bounded(spark):
    df = spark.range(50).select((F.col("id") % 20).cast("string").alias("c"))
    assert EN.one_hot_levels(df, "c") == sorted(str(k) for k in range(20))
    with pytest.raises(ValueError):
        EN.one_hot_levels(df, "c", most=19)


def test_histogram_of_no_groups(spark):
    df = spark.createDataFrame([], "k string")
    assert PR.group_size_histogram(df, "k").count() == 0
