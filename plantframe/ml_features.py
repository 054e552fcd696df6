"""Model-ready feature frames over the test tables (shared by the M* queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import calendar, plant, profiles, solar


def consumption_frame(spark: SparkSession, d: str) -> DataFrame:
    """P10 consumption features + kwh target, NULL rows dropped."""
    from plantframe.queries.q_projections import consumption_features
    return calendar.feature_frame(consumption_features(spark, d), calendar.CONSUMPTION_FEATURES,
                                  keep=("site_id", "ts"), target="kwh")


def pv_frame(spark: SparkSession, d: str) -> DataFrame:
    """P10 PV features (sun position, ISO week, hour, radiation, cloud cover) + PV output target."""
    h = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    lat = F.lit(47.0) + F.pmod("site_id", F.lit(8))
    lon = F.lit(6.0) + F.pmod("site_id", F.lit(9))
    f = solar.sun_position(h, lat, lon)
    cloud = F.pmod(F.col("kwh"), F.lit(100.0))
    radiation = profiles.weather_irradiance(F.hour("ts")) * (F.lit(1.0) - cloud / F.lit(100.0))
    f = f.withColumns({"week": calendar.iso_week("ts"), "hour": F.hour("ts"), "cloud_cover": cloud,
                       "direct_radiation": radiation})
    # a measured output: the physical one times what the features don't hold (soiling, inverter; 0.8 to 1.2 by a hash of the step)
    other = F.lit(0.8) + F.pmod(F.xxhash64("site_id", "ts"), F.lit(1000)) / F.lit(2500.0)
    f = f.withColumn("pv_kw", plant.pv_physical(F.col("direct_radiation"), profiles.weather_temperature(F.col("hour"))) * other)
    return calendar.feature_frame(f, calendar.PV_FEATURES, keep=("site_id", "ts"), target="pv_kw")


def heat_frame(spark: SparkSession, d: str) -> DataFrame:
    """P10 heat features (weather, hour, day of week) + heat demand target."""
    from plantframe.queries.q_projections import site_temperature
    h = cat.hourly(spark, d).select("site_id", "ts", (F.lit(100.0) + F.col("kwh")).alias("heat_demand"))
    f = calendar.calendar_features(h).withColumns({
        "temperature": site_temperature("site_id", "ts"), "humidity": F.lit(50.0) + F.hour("ts"),
        "wind_speed": F.lit(3.0) + F.pmod("site_id", F.lit(5)) + F.hour("ts") / 10.0})
    return calendar.feature_frame(f, calendar.HEAT_FEATURES, keep=("site_id", "ts"), target="heat_demand")
