"""The batch run of the reference as one Spark plan.

meter readings -> T2 hourly grid -> P1–P6 features -> M1 model (fit once or
loaded, S10) -> M7 forecast of the next ``horizon`` hours -> P20 dispatch ->
J1 + plan columns -> A5 / A7 KPIs -> S9 sinks.

Everything between the model fit and the sinks is lazy; the forecast feeds
the plan directly through joins on (site, ts), so nothing is collected
and every step is partitioned by site (and chunked where it is ordered).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantframe.functions import calendar, dispatch, profiles
from plantframe.functions.plant import DEFAULT, Params
from plantframe.functions.tariff import ct_to_eur
from plantframe.operators import joins, metrics, series
from plantframe.plans import forecast as fc
from plantframe.plans.plan import plan_columns
from plantframe.sources import sinks

FEATURES = calendar.CONSUMPTION_FEATURES


@dataclass
class PipelineResult:
    model: PipelineModel
    forecast: DataFrame      # site_id, ts, heat_demand (forecast)
    plan: DataFrame          # plan columns per site and step
    summary: DataFrame       # A7 per site
    kpis: DataFrame          # A5 per site and day


def hourly_features(readings: DataFrame, holidays: DataFrame, *, value: str = "kwh",
                    temperature: DataFrame | None = None) -> DataFrame:
    """T2 hourly grid + calendar, holiday, day-part and temperature features."""
    h = series.resample_mean_dense(readings.select("site_id", "ts", value), "1 hour", value)
    return _features(h, holidays, temperature)


def _features(grid: DataFrame, holidays: DataFrame, temperature: DataFrame | None) -> DataFrame:
    f = calendar.calendar_features(grid)
    f = calendar.holiday_flag(f, holidays, out="Holiday")
    if temperature is not None:
        f = f.join(temperature.select("site_id", "ts", "temperature"), ["site_id", "ts"], "left")
        f = f.withColumn("temperature", F.coalesce("temperature", profiles.weather_temperature(F.col("hour"))))
    else:
        f = f.withColumn("temperature", profiles.weather_temperature(F.col("hour")))
    return f.withColumns({"day": calendar.iso_day_number("ts"), "day_time": calendar.day_part(F.col("hour"))}) \
        .withColumn("temp_category_int", calendar.temp_category_code("temperature"))


def run(readings: DataFrame, holidays: DataFrame, *, horizon: int = 24, model: PipelineModel | None = None,
        rounds: int = fc.GBT_ROUNDS, p: Params = DEFAULT, price: DataFrame | None = None,
        sink_path: str | None = None) -> PipelineResult:
    """Forecast each site's next ``horizon`` hours of heat demand, dispatch and summarise.

    ``readings``: (site_id, ts, kwh) meter data.  ``price``: optional
    (site_id, ts, electricity_price in €/kWh); the default profile otherwise.
    ``sink_path``: when given (shared storage), the forecast and plan are
    written as CSV and the summary as JSON under it, partitioned by site.
    """
    train = calendar.feature_frame(hourly_features(readings, holidays), FEATURES, keep=("site_id", "ts"), target="kwh")
    model = model or fc.fit_gbt(train, FEATURES, "kwh", rounds=rounds)
    last = readings.groupBy("site_id").agg(F.max("ts").alias("last"))
    starts = last.select("site_id", F.window("last", "1 hour").start.alias("start"))
    future = series.time_grid_periods(starts, horizon + 1, "1 hour").filter(F.col("step") > 0).drop("step")
    scored = fc.score(model, _features(future, holidays, None))
    forecast = scored.select("site_id", "ts", F.col("prediction").alias("heat_demand"))
    if price is None:
        price = forecast.select("site_id", "ts", ct_to_eur(profiles.default_price_ct(F.hour("ts"))).alias("electricity_price"))
    plan = dispatch.rule_dispatch(forecast.join(price, ["site_id", "ts"]))
    control = plan.select("site_id", "ts", "chp_power", "boiler_heat",
                          F.lit(0.0).alias("heat_pump_heat"), F.lit(0.0).alias("electric_heater_heat"),
                          F.lit(0.0).alias("battery_charge"), F.lit(0.0).alias("battery_discharge"))
    steps = plan_columns(joins.join_plan_inputs(forecast, price, None, control), p)
    result = PipelineResult(model=model, forecast=forecast, plan=steps,
                            summary=metrics.plan_summary(steps, p),
                            kpis=metrics.plant_kpis(steps.withColumn("date", F.to_date("ts")), by=("site_id", "date")))
    if sink_path:
        base = sink_path.rstrip("/")
        sinks.sink_series(result.forecast, f"{base}/forecast", "csv")
        sinks.sink_series(result.plan, f"{base}/plan", "csv")
        sinks.sink_series(result.summary, f"{base}/summary", "json", cluster_by=None)
    return result
