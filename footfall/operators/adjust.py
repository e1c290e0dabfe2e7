"""Prediction post-processing: comparable-day adjustment (F-17).

A target day's prediction becomes the geometric mean of the same store's
predictions on two comparable days: sqrt(v(d1) * v(d2)).  The rule table
(target, d1, d2) is a handful of rows and is broadcast.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rules_frame(spark: SparkSession, rules: list[tuple[date, date, date]]) -> DataFrame:
    return spark.createDataFrame(rules, "target_date date, d1 date, d2 date")


def comparable_day_adjust(pred: DataFrame, rules: DataFrame, value: str = "visitors") -> DataFrame:
    """(store_id, visit_date, value) with target days replaced by sqrt(v(d1) v(d2))."""
    p = pred.select("store_id", "visit_date", value)
    a = p.select("store_id", F.col("visit_date").alias("d1"), F.col(value).alias("__v1"))
    b = p.select("store_id", F.col("visit_date").alias("d2"), F.col(value).alias("__v2"))
    r = F.broadcast(rules)
    adj = (p.join(r, p.visit_date == r.target_date, "left")
             .join(a, ["store_id", "d1"], "left").join(b, ["store_id", "d2"], "left"))
    new = F.when(F.col("target_date").isNotNull(), F.sqrt(F.col("__v1") * F.col("__v2"))).otherwise(F.col(value))
    return adj.select("store_id", "visit_date", new.alias(value))
