"""Readers for the original CSV file layout (one folder of files plus the
prepared weather file), mapped onto ``ForecastInputs``.

Schemas are declared, never inferred; ids stay strings, datetimes are read
as wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import constants as K
from footfall.plans.snapshot import ForecastInputs
from footfall.sources.files import read_csv_headered

# --- fixed values: file names and column layouts of the input files -------
FILES = {
    "air_reserve": ("air_reserve.csv",
                    "air_store_id string, visit_datetime timestamp_ntz, reserve_datetime timestamp_ntz, "
                    "reserve_visitors double"),
    "hpg_reserve": ("hpg_reserve.csv",
                    "hpg_store_id string, visit_datetime timestamp_ntz, reserve_datetime timestamp_ntz, "
                    "reserve_visitors double"),
    "air_store": ("air_store_info.csv",
                  "air_store_id string, air_genre_name string, air_area_name string, latitude double, "
                  "longitude double"),
    "hpg_store": ("hpg_store_info.csv",
                  "hpg_store_id string, hpg_genre_name string, hpg_area_name string, latitude double, "
                  "longitude double"),
    "air_visit": ("air_visit_data.csv", "air_store_id string, visit_date date, visitors double"),
    "relation": ("store_id_relation.csv", "air_store_id string, hpg_store_id string"),
    "date_info": ("date_info.csv", "calendar_date date, day_of_week string, holiday_flg int"),
    "submission": ("sample_submission.csv", "id string, visitors double"),
}
WEATHER_FILE = "weather_ready_to_use.csv"
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    fname, schema = FILES[name]
    return read_csv_headered(spark, os.path.join(folder, fname), schema)


def competition_inputs(spark: SparkSession, folder: str, weather_folder: str | None = None) -> ForecastInputs:
    """ForecastInputs from the original file layout (S-01)."""
    t = lambda name: read_table(spark, folder, name)
    weather = None
    measures: list[str] = []
    if weather_folder is not None:      # a named folder without the file is an error, raised by the reader
        schema = "store_id string, visit_date date, " + ", ".join(f"{m} double" for m in K.WEATHER_MEASURES)
        weather = read_csv_headered(spark, os.path.join(weather_folder, WEATHER_FILE), schema)
        measures = list(K.WEATHER_MEASURES)
    return ForecastInputs(
        visits=t("air_visit").withColumnRenamed("air_store_id", "store_id"),
        stores=t("air_store").select(F.col("air_store_id").alias("store_id"),
                                     F.col("air_genre_name").alias("genre_name"),
                                     F.col("air_area_name").alias("area_name"), "latitude", "longitude"),
        store_extra=["latitude", "longitude"],
        calendar=t("date_info").select(F.col("calendar_date").alias("visit_date"), "holiday_flg"),
        reserve_a=t("air_reserve").select(F.col("air_store_id").alias("store_id"),
                                          F.col("reserve_datetime").alias("reserve_ts"),
                                          F.col("visit_datetime").alias("visit_ts"), "reserve_visitors"),
        reserve_b=t("hpg_reserve").select(F.col("hpg_store_id").alias("ext_store_id"),
                                          F.col("reserve_datetime").alias("reserve_ts"),
                                          F.col("visit_datetime").alias("visit_ts"), "reserve_visitors"),
        crosswalk=t("relation").select(F.col("hpg_store_id").alias("ext_store_id"),
                                       F.col("air_store_id").alias("store_id")),
        weather=weather,
        weather_measures=measures,
        submission=t("submission").select("id"),
    )


# --- fixed values: per-station weather files and the store -> station map ----
STATION_COLUMNS = ["calendar_date"] + list(K.WEATHER_MEASURES)
STATION_MAP_COLUMNS = ("air_store_id", "station_id")
# ---------------------------------------------------------------------------


def prepare_weather(spark: SparkSession, station_dir: str, station_map_csv: str, out_dir: str) -> DataFrame:
    """One job: every station file in ``station_dir`` (file name = station
    id) joined to the stores that use that station, written as the
    ready-to-use weather table (S-03, J-08, S-04).  Returns the table."""
    from footfall.sources.files import read_station_files, write_csv
    schema = "calendar_date date, " + ", ".join(f"{m} double" for m in K.WEATHER_MEASURES)
    stations = read_station_files(spark, station_dir, schema, key_name="station_id")
    smap = (spark.read.option("header", True).csv(station_map_csv)
                 .select(F.col(STATION_MAP_COLUMNS[0]).alias("store_id"),
                         F.col(STATION_MAP_COLUMNS[1]).alias("station_id")))
    weather = (smap.join(stations, "station_id")
                   .select("store_id", F.col("calendar_date").alias("visit_date"), *K.WEATHER_MEASURES))
    write_csv(weather, out_dir)
    return weather
