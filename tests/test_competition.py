"""The original file layout runs end to end through the command line."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from footfall.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _write(df, path):
    df.toPandas().to_csv(path, index=False)


def _layout(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    test_anchor = dt.date(2001, 6, 17)
    v = FX.visits(spark, SF_SMALL)
    _write(v.where(F.col("visit_date") < F.lit(test_anchor))
            .select(F.col("store_id").alias("air_store_id"), "visit_date", "visitors"), data / "air_visit_data.csv")
    st = FX.stores(spark, SF_SMALL)
    _write(st.select(F.col("store_id").alias("air_store_id"), F.col("genre_name").alias("air_genre_name"),
                     F.col("area_name").alias("air_area_name"), (F.col("store_id").cast("double") / 10).alias("latitude"),
                     F.lit(135.5).alias("longitude")), data / "air_store_info.csv")
    _write(st.select(F.lit("h0").alias("hpg_store_id"), F.lit("x").alias("hpg_genre_name"),
                     F.lit("y").alias("hpg_area_name"), F.lit(0.0).alias("latitude"),
                     F.lit(0.0).alias("longitude")).limit(1), data / "hpg_store_info.csv")
    ra = FX.reserve_a(spark, SF_SMALL)
    _write(ra.select(F.col("store_id").alias("air_store_id"), F.col("visit_ts").alias("visit_datetime"),
                     F.col("reserve_ts").alias("reserve_datetime"), "reserve_visitors"), data / "air_reserve.csv")
    rb = FX.reserve_b(spark, SF_SMALL)
    _write(rb.select(F.col("ext_store_id").alias("hpg_store_id"), F.col("visit_ts").alias("visit_datetime"),
                     F.col("reserve_ts").alias("reserve_datetime"), "reserve_visitors"), data / "hpg_reserve.csv")
    _write(FX.crosswalk(spark, SF_SMALL).select(F.col("store_id").alias("air_store_id"),
                                                F.col("ext_store_id").alias("hpg_store_id")),
           data / "store_id_relation.csv")
    _write(FX.calendar(spark, SF_SMALL).select(F.col("visit_date").alias("calendar_date"),
                                               F.date_format("visit_date", "EEEE").alias("day_of_week"),
                                               "holiday_flg"), data / "date_info.csv")
    # ids to forecast: every store on every day of the test horizon
    sub = st.select("store_id", F.explode(F.sequence(F.lit(test_anchor), F.lit(test_anchor + dt.timedelta(days=38))))
                    .alias("d"))
    _write(sub.select(F.concat("store_id", F.lit("_"), F.date_format("d", "yyyy-MM-dd")).alias("id"),
                      F.lit(0.0).alias("visitors")), data / "sample_submission.csv")
    return data, test_anchor, sub


def test_cli_on_original_file_layout(spark, tmp_path, capsys):
    data, test_anchor, sub = _layout(spark, tmp_path)
    from footfall.__main__ import main
    out = tmp_path / "out"
    main(["--data", str(data), "--start", str(test_anchor - dt.timedelta(days=42)), "--out", str(out),
          "--rounds", "3"])
    printed = capsys.readouterr().out.strip().splitlines()[0]
    assert os.path.isdir(printed)
    got = spark.read.option("header", True).csv(printed)
    assert got.count() == sub.count()
    assert got.where(F.col("visitors").isNull()).count() == 0
    snaps = spark.read.parquet(str(out / "snapshots"))
    assert snaps.select("end_date").distinct().count() == 64
    assert {"latitude", "longitude"} <= set(snaps.columns)


def test_prepare_weather_from_station_files(spark, tmp_path):
    from footfall import constants as K
    from footfall.sources.competition import prepare_weather
    st_dir = tmp_path / "stations"
    st_dir.mkdir()
    w = FX.station_weather(spark, SF_SMALL)
    cols = [F.col("visit_date").alias("calendar_date")] + [
        (F.col(m) if m in ("precipitation", "high_temperature") else F.lit(None).cast("double")).alias(m)
        for m in K.WEATHER_MEASURES]
    for sid in [r[0] for r in w.select("station_id").distinct().collect()]:
        _write(w.where(F.col("station_id") == sid).select(*cols), st_dir / f"st{sid}.csv")
    smap = FX.station_map(spark, SF_SMALL).select(F.col("store_id").alias("air_store_id"),
                                                  F.concat(F.lit("st"), F.col("station_id").cast("string"))
                                                  .alias("station_id"))
    _write(smap, tmp_path / "map.csv")
    out = prepare_weather(spark, str(st_dir), str(tmp_path / "map.csv"), str(tmp_path / "weather_out"))
    want = FX.station_map(spark, SF_SMALL).join(w, "station_id").count()
    assert out.count() == want
    back = spark.read.option("header", True).csv(str(tmp_path / "weather_out"))
    assert back.count() == want and "visit_date" in back.columns


def test_profile_tables_on_original_layout(spark, tmp_path):
    from footfall.plans.profiling import profile_tables
    data, _, _ = _layout(spark, tmp_path)
    prof = profile_tables(spark, str(data))
    counts = {name: df.count() for name, df in prof.items()}      # every frame runs
    # single-token areas have no ward/area parts: those tables are empty, the rest are not
    assert all(n >= 1 for name, n in counts.items() if not name.startswith("hpg_area_")), counts
    nulls = {r["column_name"]: r["null_count"] for r in prof["nulls_air_store"].collect()}
    assert nulls["air_store_id"] == 0
    assert prof["hpg_reservations_per_store_histogram"].count() == 100


def test_weather_is_read_by_spark_or_missed_loudly(spark, tmp_path):
    from footfall import constants as K
    from footfall.sources.competition import WEATHER_FILE, competition_inputs
    header = ",".join(["store_id", "visit_date", *K.WEATHER_MEASURES])
    (tmp_path / WEATHER_FILE).write_text(header + "\n" + ",".join(["s1", "2017-01-01"] + ["1.5"] * len(K.WEATHER_MEASURES)) + "\n")
    data = str(_layout(spark, tmp_path)[0])
    for folder in (str(tmp_path), tmp_path.as_uri()):
        inp = competition_inputs(spark, data, folder)
        assert inp.weather_measures == list(K.WEATHER_MEASURES) and inp.weather.count() == 1
    assert competition_inputs(spark, data).weather is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        competition_inputs(spark, data, str(tmp_path / "nowhere")).weather.count()
