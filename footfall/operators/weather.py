"""Station weather joined to stores and to label rows (S-03, J-08).

``store_weather``: stores x their station's daily weather (1:N inner join).
``weather_features`` has two modes:

* ``as_reference`` -- the original filters weather to days *before* the
  anchor but joins on label days, which are all on or after it; no row can
  ever match, so every measure is the fill value -1.  The disjoint date
  ranges make that a constant, and no join is planned.
* ``observed`` -- joins the weather of the label day itself (known only in
  hindsight; for backtests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall import constants as K


def store_weather(station_map: DataFrame, station_weather: DataFrame) -> DataFrame:
    """store_id, visit_date, measures... (weather of each store's station)."""
    return station_map.join(station_weather, "station_id").drop("station_id")


def weather_features(labels: DataFrame, weather: DataFrame | None, measures: list[str],
                     mode: str = "as_reference") -> DataFrame:
    if mode == "as_reference" or weather is None:
        return labels.select("*", *[F.lit(K.WEATHER_FILL).alias(m) for m in measures])
    if mode != "observed":
        raise ValueError(f"unknown weather mode {mode!r}")
    w = weather.select("store_id", "visit_date", *measures)
    joined = labels.join(w, ["store_id", "visit_date"], "left")
    return joined.select(*labels.columns,
                         *[F.coalesce(F.col(m).cast("double"), F.lit(K.WEATHER_FILL)).alias(m)
                           for m in measures])
