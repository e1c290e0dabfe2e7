"""File sources and sinks (S-01 ... S-06)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from footfall.sources import (read_csv_headered, read_csv_named, read_snapshots, read_station_files,
                              write_csv, write_snapshots, write_submission_csv)
from footfall.sources import fixtures as FX
from tests.conftest import SF_SMALL


def test_station_files_keyed_by_file_name(spark, tmp_path):
    weather = FX.station_weather(spark, SF_SMALL)
    folder = tmp_path / "stations"
    folder.mkdir()
    # one CSV file per station, written from the driver table (test setup only)
    for row in weather.select("station_id").distinct().collect():
        sid = row["station_id"]
        pdf = weather.where(F.col("station_id") == sid).drop("station_id").toPandas()
        pdf.to_csv(folder / f"st{sid}.csv", index=False)
    back = read_station_files(spark, str(folder), "visit_date date, precipitation double, high_temperature double")
    assert back.count() == weather.count()
    assert {r[0] for r in back.select("station_id").distinct().collect()} == \
        {f"st{r[0]}" for r in weather.select("station_id").distinct().collect()}


def test_csv_round_trip_headered_and_named(spark, tmp_path):
    df = FX.stores(spark, SF_SMALL)
    path = str(tmp_path / "stores_csv")
    write_csv(df, path)
    back = read_csv_headered(spark, path, "store_id string, genre_name string, area_name string",
                             rename={"store_id": "id"})
    assert back.count() == df.count() and "id" in back.columns
    named = read_csv_named(spark, path, "a string, b string, c string")
    # headerless read keeps each file's header line as a data row
    n_files = len([f for f in os.listdir(path) if f.endswith(".csv")])
    assert named.count() == df.count() + n_files


def test_submission_csv_four_decimals(spark, tmp_path):
    df = spark.createDataFrame([("s_2017-04-23", 1.23456)], "id string, visitors double")
    path = write_submission_csv(df, str(tmp_path), ["visitors"], dt.datetime(2020, 1, 2, 3, 4, 5))
    assert path.endswith("sub20200102_030405")
    back = spark.read.option("header", True).csv(path).first()
    assert back["visitors"] == "1.2346"


def test_snapshot_parquet_prunes_by_anchor(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2017, 1, 1), 1), (dt.date(2017, 1, 8), 2)], "end_date date, x int")
    path = str(tmp_path / "snaps")
    write_snapshots(df, path)
    assert {"end_date=2017-01-01", "end_date=2017-01-08"} <= set(os.listdir(path))
    back = read_snapshots(spark, path, [dt.date(2017, 1, 8)])
    assert [r["x"] for r in back.collect()] == [2]


def test_snapshot_reload_prunes_partitions_at_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2017, 1, 1) + dt.timedelta(days=7 * i), i) for i in range(6)],
                               "end_date date, x int")
    path = str(tmp_path / "snaps")
    write_snapshots(df, path)
    back = read_snapshots(spark, path, [dt.date(2017, 1, 8), dt.date(2017, 1, 15)])
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "end_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r["x"] for r in back.collect()) == [1, 2]
