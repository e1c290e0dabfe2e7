"""Forecasting inputs expressed over the driver's TPC-H-like tables.

Each function maps driver tables onto one input relation of the feature
pipeline (store info, daily visits, two reservation channels, id crosswalk,
station weather, calendar).  The same relations are written in SQL for the
DuckDB oracle in ``footfall.plans.oracle``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.anchors import Anchor

# --- fixed values -----------------------------------------------------------
# fixture anchors: 8 weekly anchors back from 2001-06-17, horizon 39 days
FIXTURE_LAST_ANCHOR = date(2001, 6, 17)
FIXTURE_N_ANCHORS = 8
FIXTURE_HORIZON = 39
# days of month flagged as holidays in the fixture calendar
FIXTURE_HOLIDAY_DAYS = (1, 15)
# number of weather stations; station of a store = store_id % 5
FIXTURE_STATIONS = 5
# -----------------------------------------------------------------------------


def fixture_anchors() -> list[Anchor]:
    return [Anchor(FIXTURE_LAST_ANCHOR - timedelta(days=7 * i), FIXTURE_HORIZON)
            for i in range(FIXTURE_N_ANCHORS)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id, genre_name, area_name (nation joined to its region)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("n_nationkey").cast("string").alias("store_id"),
                     F.col("r_name").alias("genre_name"),
                     F.concat(F.col("r_name"), F.lit(" "), F.col("n_name")).alias("area_name")))


def _order_lines(spark: SparkSession, sf_dir: str, line_cols: list[str], with_customer: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", *line_cols)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    df = li.join(o, li.l_orderkey == o.o_orderkey)
    if with_customer:
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        df = df.join(c, df.o_custkey == c.c_custkey)
    return df


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id, visit_date, visitors: daily quantity per customer nation."""
    df = _order_lines(spark, sf_dir, ["l_quantity"], with_customer=True)
    return (df.groupBy(F.col("c_nationkey").cast("string").alias("store_id"),
                       F.col("o_orderdate").cast("date").alias("visit_date"))
              .agg(F.sum("l_quantity").alias("visitors")))


def customer_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id, genre_name, area_name with a customer as the store."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("store_id"), F.col("c_mktsegment").alias("genre_name"),
                    F.concat("c_mktsegment", F.lit(" "), F.col("c_nationkey").cast("string")).alias("area_name"))


def customer_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id, visit_date, visitors: daily quantity per customer."""
    df = _order_lines(spark, sf_dir, ["l_quantity"], with_customer=False)
    return (df.groupBy(F.col("o_custkey").cast("string").alias("store_id"), F.col("o_orderdate").cast("date").alias("visit_date"))
              .agg(F.sum("l_quantity").alias("visitors")))


def reserve_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First reservation channel: store_id, reserve_ts, visit_ts, reserve_visitors."""
    df = _order_lines(spark, sf_dir, ["l_quantity", "l_shipdate"], with_customer=True)
    return df.select(F.col("c_nationkey").cast("string").alias("store_id"),
                     F.col("o_orderdate").alias("reserve_ts"),
                     F.col("l_shipdate").alias("visit_ts"),
                     F.col("l_quantity").alias("reserve_visitors"))


def reserve_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second channel with its own ids: ext_store_id, reserve_ts, visit_ts, reserve_visitors."""
    df = _order_lines(spark, sf_dir, ["l_quantity", "l_shipdate", "l_suppkey", "l_returnflag"],
                      with_customer=False)
    return (df.where(F.col("l_returnflag") == "R")
              .select(F.concat(F.lit("h"), F.col("l_suppkey").cast("string")).alias("ext_store_id"),
                      F.col("o_orderdate").alias("reserve_ts"),
                      F.col("l_shipdate").alias("visit_ts"),
                      F.col("l_quantity").alias("reserve_visitors")))


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial id map ext_store_id -> store_id (unique ext ids)."""
    s = table(spark, sf_dir, "supplier")
    return (s.where(F.col("s_suppkey") % 2 == 0)
             .groupBy("s_nationkey")
             .agg(F.min("s_suppkey").alias("k"))
             .select(F.concat(F.lit("h"), F.col("k").cast("string")).alias("ext_store_id"),
                     F.col("s_nationkey").cast("string").alias("store_id")))


def station_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """station_id, visit_date, precipitation, high_temperature."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_discount", "l_tax")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
              .groupBy((F.col("s_nationkey") % FIXTURE_STATIONS).alias("station_id"),
                       F.col("l_shipdate").cast("date").alias("visit_date"))
              .agg(F.min("l_discount").alias("precipitation"),
                   F.max("l_tax").alias("high_temperature")))


def station_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store_id -> station_id."""
    return stores(spark, sf_dir).select(
        "store_id", (F.col("store_id").cast("int") % FIXTURE_STATIONS).alias("station_id"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free calendar over the order dates: visit_date, holiday_flg.

    The date range is derived from ``orders`` (one aggregate row, then a
    ``sequence`` of at most a few thousand days).
    """
    o = table(spark, sf_dir, "orders")
    bounds = o.agg(F.min("o_orderdate").cast("date").alias("lo"),
                   F.max("o_orderdate").cast("date").alias("hi"))
    cal = bounds.select(F.explode(F.sequence("lo", "hi")).alias("visit_date"))
    return cal.select("visit_date",
                      F.dayofmonth("visit_date").isin(*FIXTURE_HOLIDAY_DAYS).cast("int").alias("holiday_flg"))


# ----------------------------------------------- model-selection inputs ----
def regression_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: o_orderkey, n_lines, qty, max_disc, o_orderpriority, y (total price)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return (o.join(li, o.o_orderkey == li.l_orderkey)
             .groupBy("o_orderkey", "o_orderpriority", "o_totalprice")
             .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"),
                  F.max("l_discount").alias("max_disc"))
             .select("o_orderkey", "n_lines", "qty", "max_disc", "o_orderpriority",
                     F.col("o_totalprice").alias("y")))


def classification_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents (imbalanced): doc_id, n_chars, lang, source, y (quality), toxic."""
    lb = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return lb.join(d, "doc_id").select("doc_id", "n_chars", "lang", "source",
                                       F.col("quality").alias("y"), "toxic")


def categorical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with categorical features: p_partkey, p_brand, p_type, p_size, y (price >= 950)."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_brand", "p_type", "p_size",
                    (F.col("p_retailprice") >= 950).cast("int").alias("y"))


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score per labelled document: doc_id, y, score in [0, 1)."""
    return classification_rows(spark, sf_dir).select(
        "doc_id", "y", ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("score"))


def multiclass_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic 10-class prediction per vector: vec_id, y, pred."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").alias("y"), ((F.col("vec_id") * 7) % 10).cast("int").alias("pred"))
