"""Toy golden values for the semantic traps (FIXTURES Part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions import floor_day_diff, id_date, id_store, split_part, weekday
from footfall.functions.stats import stat_aggs
from footfall.operators.folds import md5_bucket


def _stats(spark, values, names):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return df.agg(*stat_aggs(F.col("v"), names)).first()


def test_corrected_skew_and_kurtosis(spark):
    r = _stats(spark, [1, 2, 2, 5, 9, 4], {"skew": "s", "kurt": "k"})
    assert r["s"] == pytest.approx(1.249651, abs=1e-6)
    assert r["k"] == pytest.approx(1.394874, abs=1e-6)


def test_skew_three_values(spark):
    assert _stats(spark, [1, 2, 7], {"skew": "s"})["s"] == pytest.approx(1.545393, abs=1e-6)


def test_skew_constant_and_short_groups_are_null(spark):
    assert _stats(spark, [3, 3, 3, 3], {"skew": "s"})["s"] is None
    assert _stats(spark, [1, 2], {"skew": "s"})["s"] is None
    assert _stats(spark, [1, 2, 3], {"kurt": "k"})["k"] is None


def test_median_and_sample_std_match_pandas(spark):
    r = _stats(spark, [1, 2, 2, 5, 9, 4], {"median": "m", "std": "sd"})
    assert r["m"] == 3.0
    assert r["sd"] == pytest.approx(2.9268868558020253)


def test_floor_day_difference(spark):
    base = dt.datetime(2017, 1, 10, 12, 0)
    df = spark.createDataFrame([(base + dt.timedelta(hours=14), base), (base - dt.timedelta(hours=14), base)],
                               "late timestamp_ntz, early timestamp_ntz")
    got = [r[0] for r in df.select(floor_day_diff(F.col("late"), F.col("early"))).collect()]
    assert got == [0, -1]


def test_weekday_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 2),), (dt.date(2017, 1, 1),)], "d date")
    assert [r[0] for r in df.select(weekday(F.col("d"))).collect()] == [0, 6]


def test_id_split(spark):
    r = spark.createDataFrame([("air_ab_2017-04-23",)], "id string").select(
        id_date(F.col("id")).alias("d"), id_store(F.col("id")).alias("s")).first()
    assert (r["d"], r["s"]) == ("2017-04-23", "air_ab")


def test_split_past_end_is_null(spark):
    r = spark.createDataFrame([("a b",)], "s string").select(split_part(F.col("s"), 2).alias("p")).first()
    assert r["p"] is None


def test_md5_fold_matches_golden(spark):
    df = spark.range(8).select(md5_bucket(F.col("id"), 3).alias("f"))
    assert [r[0] for r in df.collect()] == [0, 1, 2, 0, 2, 2, 0, 0]


def test_floor_day_difference_ignores_daylight_saving(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2017, 3, 13), dt.datetime(2017, 3, 11))],
                                   "late timestamp_ntz, early timestamp_ntz")
        assert df.select(floor_day_diff(F.col("late"), F.col("early"))).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
