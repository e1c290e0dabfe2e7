"""Distributed ranking and evaluation tables against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators import metrics as M
from footfall.operators.folds import stratified_kfold, time_series_folds
from footfall.operators.ranking import exact_row_number, md5_prefix, running_totals_desc


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 1), round(rnd.random(), 2)) for i in range(600)]   # many score ties
    return spark.createDataFrame(rows, "k long, y int, s double"), rows


def test_exact_row_number_equals_global_window(spark, scored):
    df, _ = scored
    order = [F.md5(F.col("k").cast("string")), F.col("k")]
    got = exact_row_number(df, ["y"], order, md5_prefix(F.col("k"), 1), "rn")
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("y").orderBy(*order)) - 1)
    joined = got.join(ref, ["k", "y", "s"])
    assert joined.where(F.col("rn") != F.col("rn2")).count() == 0
    assert joined.count() == 600


def test_stratified_folds_are_balanced(spark, scored):
    df, rows = scored
    folds = stratified_kfold(df, "k", "y", 3).groupBy("y", "fold").count().collect()
    by_label = {}
    for r in folds:
        by_label.setdefault(r["y"], []).append(r["count"])
    for counts in by_label.values():
        assert max(counts) - min(counts) <= 1


def test_time_series_folds_shape(spark):
    import datetime as dt
    rows = [(f"s{i % 5}", dt.date(2017, 1, 1) + dt.timedelta(days=i // 5)) for i in range(61)]
    df = spark.createDataFrame(rows, "store_id string, visit_date date")
    got = time_series_folds(df, "visit_date", "store_id", 5).groupBy("test_fold").count().collect()
    sizes = {r["test_fold"]: r["count"] for r in got}
    assert sizes == {None: 11, 0: 10, 1: 10, 2: 10, 3: 10, 4: 10}


def test_running_totals_match_cumsum(spark, scored):
    df, rows = scored
    base = df.select("s", F.col("y").cast("long").alias("pos"))
    got = {r["s"]: r["cum_pos"] for r in running_totals_desc(base, "s", ["pos"], n_buckets=7).collect()}
    for s in sorted({r[2] for r in rows}):
        assert got[s] == sum(r[1] for r in rows if r[2] >= s)


def test_auc_equals_pairwise_probability(spark, scored):
    df, rows = scored
    pos = [r[2] for r in rows if r[1] == 1]
    neg = [r[2] for r in rows if r[1] == 0]
    brute = np.mean([1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg])
    got = M.roc_auc(df, "y", "s", n_buckets=5).first()["auc"]
    assert got == pytest.approx(brute, abs=1e-12)


def test_cost_sweep_first_minimum(spark, scored):
    df, rows = scored
    sweep = {r["threshold"]: r["cost"] for r in M.cost_sweep(df, "y", "s").collect()}
    ts = np.linspace(0, 1.0, num=21)
    costs = []
    for t in ts:
        fp = sum(1 for r in rows if r[1] == 0 and r[2] > t)
        fn = sum(1 for r in rows if r[1] == 1 and r[2] <= t)
        costs.append(fp * 1 + fn * 10)
        assert sweep[float(t)] == costs[-1]
    best = M.best_threshold(M.cost_sweep(df, "y", "s")).first()
    assert best["threshold"] == float(ts[int(np.argmin(costs))])


def test_classification_report_macro_and_weighted(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (2, 2)]
    df = spark.createDataFrame(rows, "y int, p int")
    rep = {r["label"]: r for r in M.classification_report(df, "y", "p").collect()}
    # class 1: tp 2, predicted 4 times, support 2
    assert rep["1"]["precision"] == pytest.approx(2 / 4) and rep["1"]["recall"] == 1.0
    f1s = [rep[c]["f1"] for c in ("0", "1", "2")]
    assert rep["macro avg"]["f1"] == pytest.approx(sum(f1s) / 3)
    assert rep["accuracy"]["f1"] == pytest.approx(4 / 6)


def test_exact_quantiles_match_numpy_with_ties(spark):
    from footfall.operators.ranking import exact_quantiles
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=1500), np.full(1000, 1.5), rng.integers(0, 5, 500).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    # few buckets force several refinement levels
    got = exact_quantiles(df, "v", probs, n_buckets=10)
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), abs=1e-12)


def test_exact_quantiles_with_infinities_and_extremes(spark):
    from footfall.operators.ranking import exact_quantiles
    vals = [-math.inf, -1.7e308, -2.0, 0.0, 5e-324, 1.0, 3.0, 1.7e308, math.inf, math.inf]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (math.nan,)], "v double")
    got = exact_quantiles(df, "v", [k / 9 for k in range(10)], n_buckets=4)
    assert [got[k / 9] for k in range(10)] == vals
    only = spark.createDataFrame([(math.inf,)] * 21, "v double")
    assert exact_quantiles(only, "v", [0.0, 0.3, 1.0]) == {0.0: math.inf, 0.3: math.inf, 1.0: math.inf}


def test_level_codes_are_ranks_for_text_numbers_and_dates(spark):
    from datetime import date, timedelta

    from footfall.operators import encode as EN
    rows = [(f"lvl{(i * 7919) % 997:04d}", ((i * 31) % 500 - 250) / 3, date(1999, 1, 1) + timedelta(days=i * 37 % 3000 - 900))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, x double, d date")
    for k, col in enumerate("sxd"):
        want = {v: n for n, v in enumerate(sorted({r[k] for r in rows}))}
        assert {r[col]: r["code"] for r in EN.level_codes(df, col).collect()} == want


def test_ordinal_encoder_is_fitted_and_unseen_is_an_error(spark):
    from pyspark.errors import PySparkException

    from footfall.operators import encode as EN
    enc = EN.OrdinalEncoder(["v"]).fit(spark.createDataFrame([("b",), ("c",)], "v string"))
    out = enc.transform(spark.createDataFrame([("c",), (None,)], "v string")).collect()
    assert {r["v"]: r["v_code"] for r in out} == {"c": 1, None: None}
    with pytest.raises(PySparkException, match="unseen level of v: d"):
        enc.transform(spark.createDataFrame([("c",), ("d",)], "v string")).collect()


def test_standardize_keeps_null_of_a_constant_column(spark):
    from footfall.operators import encode as EN
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    assert [r["x"] for r in EN.standardize(df, ["x"]).collect()] == [0.0, 0.0, None]


def test_exact_size_holdout_and_kfold(spark, scored):
    from footfall.operators.folds import holdout_exact, kfold_exact
    df, rows = scored
    n = len(rows)
    assert holdout_exact(df, "k", 0.2).where("is_test = 1").count() == -(-n * 2 // 10)
    sizes = sorted(r["count"] for r in kfold_exact(df, "k", 3).groupBy("fold").count().collect())
    assert sizes == [n // 3, n // 3, n // 3] if n % 3 == 0 else max(sizes) - min(sizes) == 1


def test_time_series_date_folds_keep_dates_whole(spark):
    from footfall.operators.folds import time_series_date_folds
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.randrange(40), k) for k in range(1200)], "d int, k int")
    rows = time_series_date_folds(df, "d", 5).collect()
    fold = {}
    for r in rows:
        assert fold.setdefault(r["d"], r["test_fold"]) == r["test_fold"]
    order = [fold[d] for d in sorted(fold)]
    assert len(rows) == 1200 and order[0] is None and [f for f in order if f is not None] == sorted(f for f in order if f is not None)
    sizes = [sum(r["test_fold"] == f for r in rows) for f in range(5)]
    assert min(sizes) > 120 and max(sizes) < 280
