"""Forecasts from landed weather answers (M7, M8, and the quarter-hour heat forecast).

The weather of the days to come arrives as payloads (S4).  Its rows are put on the
model's stamps (T5, T6), get the model's features, and are written once; forecast
and features are two readings of that table.
Without a model the forecast is NULL and the features are the same.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.functions import calendar, solar
from plantframe.operators import series
from plantframe.plans import forecast as fc
from plantframe.session import scratch_path

# Steps of the forecasts (a week of hours, a week of quarter hours, the hours of a day).
WEEK_HOURS, WEEK_QUARTERS, DAY_HOURS = 168, 672, 24


@dataclass
class Scored:
    forecast: DataFrame   # site_id, ts and the prediction
    features: DataFrame   # site_id, ts and the model's features, in its order


def consumption_features(weather: DataFrame, starts: DataFrame, holidays: DataFrame, *, hours: int = WEEK_HOURS, start: str = "start") -> DataFrame:
    """The ``hours`` hours from each site's ``start`` on with the consumption model's features.

    Gaps of the weather are interpolated (T5); each stamp takes the nearest hour's weather (T6).
    """
    hourly = series.upsample_linear(weather.select("site_id", "ts", "temperature"), "1 hour", "temperature")
    grid = series.time_grid_periods(starts, hours, "1 hour", start=start).drop("step")
    f = calendar.calendar_features(series.align_nearest(grid, hourly, "temperature").drop("matched_ts"))
    f = calendar.holiday_flag(f, holidays, out="Holiday")
    f = f.withColumns({"day": calendar.iso_day_number("ts"), "day_time": calendar.day_part(F.col("hour")), "temp_category_int": calendar.temp_category_code("temperature")})
    return calendar.feature_frame(f, calendar.CONSUMPTION_FEATURES, keep=("site_id", "ts"))


def pv_features(weather: DataFrame, latitude: Column, longitude: Column, *, first: int = DAY_HOURS, hours: int = DAY_HOURS) -> DataFrame:
    """Hours ``first`` to ``first + hours`` of each site's weather (the second day) with the PV model's features."""
    f = series.slice_rows(weather.select("site_id", "ts", "direct_radiation", "cloud_cover"), first, hours).drop("pos")
    f = solar.sun_position(f, latitude, longitude)
    return calendar.feature_frame(f.withColumns({"week": calendar.iso_week("ts"), "hour": F.hour("ts")}), calendar.PV_FEATURES, keep=("site_id", "ts"))


def heat_features(weather: DataFrame, *, every: str = "15 minutes", steps: int = WEEK_QUARTERS) -> DataFrame:
    """The first ``steps`` quarter hours of each site's weather with the heat model's features."""
    fine = series.upsample_linear(weather, every, ["temperature", "humidity", "wind_speed"])
    f = calendar.calendar_features(series.first_n(fine, steps).drop("pos"))
    return calendar.feature_frame(f, calendar.HEAT_FEATURES, keep=("site_id", "ts"))


def scored(model: PipelineModel | None, features: DataFrame, prediction: str) -> Scored:
    """Forecast and features of a feature frame, written once."""
    rows = fc.binned(model, features)
    path = scratch_path(features.sparkSession, f"scored-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    stored = features.sparkSession.read.schema(rows.schema).parquet(path)
    forecast = fc.score_each(model, stored).select("site_id", "ts", F.col("prediction").cast("double").alias(prediction))
    return Scored(forecast, stored.select(*features.columns))
