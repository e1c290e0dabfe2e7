"""Forecast inputs built from the driver tables (see ``sources.fixtures``)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.operators.weather import store_weather
from footfall.plans.snapshot import ForecastInputs
from footfall.sources import fixtures as FX

FIXTURE_WEATHER_MEASURES = ["precipitation", "high_temperature"]


def customer_inputs(spark: SparkSession, sf_dir: str) -> ForecastInputs:
    """Visits with a customer as the store: thousands of stores, few days each."""
    return ForecastInputs(visits=FX.customer_visits(spark, sf_dir), stores=FX.customer_stores(spark, sf_dir),
                          calendar=FX.calendar(spark, sf_dir))


def fixture_inputs(spark: SparkSession, sf_dir: str) -> ForecastInputs:
    return ForecastInputs(
        visits=FX.visits(spark, sf_dir),
        stores=FX.stores(spark, sf_dir),
        calendar=FX.calendar(spark, sf_dir),
        reserve_a=FX.reserve_a(spark, sf_dir),
        reserve_b=FX.reserve_b(spark, sf_dir),
        crosswalk=FX.crosswalk(spark, sf_dir),
        weather=store_weather(FX.station_map(spark, sf_dir), FX.station_weather(spark, sf_dir)),
        weather_measures=FIXTURE_WEATHER_MEASURES,
    )
