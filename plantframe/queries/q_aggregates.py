"""A1–A5 and A10 over the test tables (A6–A8 are in ``q_ledger``, A9 in ``q_sources``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import calendar, dispatch
from plantframe.operators import metrics, series
from plantframe.queries.common import R4, register, round_doubles
from plantframe.queries.q_sources import _holiday_payload, sql_holiday_values
from plantframe.sources import payloads

RD, HR, PI = cat.SQL_READINGS, cat.SQL_HOURLY, cat.SQL_PLAN_INPUTS
W = cat.with_sql


# ---------------------------------------------------------------------- A1
@register("daily_average", W(HR) + f"SELECT site_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, {R4('avg(kwh)')} AS avg_kwh FROM hourly "
          "WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' GROUP BY site_id, CAST(ts AS DATE)")
def q_daily_average(spark, d):
    # the day-aligned bound is applied to the raw readings (pushed into the Parquet scan);
    # it selects exactly the hourly bins on/after that day
    readings = calendar.horizon_filter(cat.readings(spark, d), "2024-01-02")
    hourly = series.resample_mean(readings, "1 hour", ["kwh"])
    return round_doubles(metrics.daily_average(hourly, "kwh"))


# ---------------------------------------------------------------------- A2
@register("series_summary", W(RD) + "SELECT site_id, CAST(count(*) AS BIGINT) AS n, min(ts) AS ts_min, max(ts) AS ts_max, "
          f"{R4('min(kwh)')} AS v_min, {R4('max(kwh)')} AS v_max, {R4('avg(kwh)')} AS v_mean FROM readings GROUP BY site_id")
def q_series_summary(spark, d):
    return round_doubles(metrics.series_summary(cat.readings(spark, d), "kwh"))


# ---------------------------------------------------------------------- A3
_A3 = ("CAST(count(*) AS BIGINT) AS n, " + R4("avg(abs(actual - predicted))") + " AS mae, "
       + R4("sqrt(avg((actual - predicted) * (actual - predicted)))") + " AS rmse, "
       + R4("avg(abs((actual - predicted) / CASE WHEN actual <> 0 THEN actual END)) * 100.0::DOUBLE") + " AS mape, "
       "CAST(sum(CASE WHEN actual = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_zero_actual")


@register("forecast_errors", W(cat.SQL_PREDICTIONS) + f"SELECT model, {_A3} FROM predictions "
          "WHERE actual IS NOT NULL AND predicted IS NOT NULL GROUP BY model")
def q_forecast_errors(spark, d):
    return round_doubles(metrics.forecast_errors(cat.predictions(spark, d), "actual", "predicted", ["model"]))


# ---------------------------------------------------------------------- A4
_LB_SRC = ("lb AS (SELECT l_returnflag AS segment, l_extendedprice AS actual, l_quantity * p_retailprice AS list_price, "
           "l_extendedprice * (1 - l_discount) AS discounted, l_extendedprice * (1 + l_tax) AS taxed "
           "FROM lineitem JOIN part ON l_partkey = p_partkey)")


@register("model_leaderboard", W(_LB_SRC, "lg AS (SELECT segment, actual, 'list_price' AS model, list_price AS predicted FROM lb "
                                 "UNION ALL SELECT segment, actual, 'discounted', discounted FROM lb "
                                 "UNION ALL SELECT segment, actual, 'taxed', taxed FROM lb)",
                                 f"sc AS (SELECT segment, model, avg(abs(actual - predicted)) AS mae_raw, "
                                 "sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse_raw, " + _A3 +
                                 " FROM lg WHERE actual IS NOT NULL AND predicted IS NOT NULL GROUP BY segment, model)")
          + "SELECT segment, model, n, mae, rmse, mape, n_zero_actual, "
          "CAST(rank() OVER (PARTITION BY segment ORDER BY rmse_raw, model) AS BIGINT) AS rank FROM sc")
def q_leaderboard(spark, d):
    li = cat.table(spark, d, "lineitem")
    pa = cat.table(spark, d, "part")
    wide = li.join(pa, li.l_partkey == pa.p_partkey).select(
        F.col("l_returnflag").alias("segment"), F.col("l_extendedprice").alias("actual"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("list_price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("discounted"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("taxed"))
    out = metrics.model_leaderboard(wide, "actual", ["list_price", "discounted", "taxed"], by=["segment"])
    return round_doubles(out)


# ---------------------------------------------------------------------- A5
_A5_PLAN = ("ru AS (SELECT site_id, ts, heat_demand, electricity_price, "
            "least(200.0::DOUBLE, greatest(0.0::DOUBLE, 0.7::DOUBLE * heat_demand)) AS chp_power FROM plan_inputs), "
            "ru2 AS (SELECT *, least(300.0::DOUBLE, 0.5::DOUBLE * chp_power) AS chp_heat FROM ru), "
            "ru3 AS (SELECT *, greatest(0.0::DOUBLE, heat_demand - chp_heat) AS boiler_heat FROM ru2)")


@register("plant_kpis", W(PI, _A5_PLAN) + "SELECT site_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, "
          f"{R4('sum(chp_power * electricity_price)')} AS total_revenue, {R4('sum(chp_power * 0.03::DOUBLE)')} AS total_cost, "
          f"{R4('sum(chp_power * electricity_price) - sum(chp_power * 0.03::DOUBLE)')} AS net_profit, "
          f"{R4('CASE WHEN sum(chp_heat) + sum(boiler_heat) > 0 THEN sum(heat_demand) / (sum(chp_heat) + sum(boiler_heat)) * 100.0::DOUBLE ELSE 0.0::DOUBLE END')} AS efficiency, "
          f"{R4('sum(chp_power) / 0.85::DOUBLE + sum(boiler_heat) / 0.9::DOUBLE')} AS fuel_consumption, "
          f"{R4('(sum(chp_power) / 0.85::DOUBLE + sum(boiler_heat) / 0.9::DOUBLE) * 0.2::DOUBLE')} AS co2_emissions "
          "FROM ru3 GROUP BY site_id, CAST(ts AS DATE)")
def q_plant_kpis(spark, d):
    plan = dispatch.rule_dispatch(cat.plan_inputs(spark, d)).withColumn("date", F.to_date("ts"))
    return round_doubles(metrics.plant_kpis(plan, by=("site_id", "date")))


# --------------------------------------------------------------------- A10
@register("holiday_year_union", W(RD) + "SELECT DISTINCT CAST(make_date(y.y, t.m, t.d) AS VARCHAR) AS date FROM "
          "(SELECT DISTINCT year(ts) AS y FROM readings UNION SELECT DISTINCT year(ts) + 1 FROM readings) y CROSS JOIN "
          + sql_holiday_values() + " WHERE t.g OR list_contains(coalesce(t.counties, []::VARCHAR[]), 'DE-SH')")
def q_holiday_union(spark, d):
    years = cat.readings(spark, d).select(F.year("ts").alias("year")).distinct()
    this_year = payloads.holiday_dates(years.select(_holiday_payload(F.col("year")).alias("payload")))
    next_year = payloads.holiday_dates(years.select(_holiday_payload(F.col("year") + 1).alias("payload")))
    return round_doubles(metrics.holiday_year_union(this_year, next_year))
