"""J1–J4, J6, J7 over the test tables (J5 is in ``q_series``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import profiles
from plantframe.operators import joins
from plantframe.queries.common import R4, register, round_doubles
from plantframe.queries.q_sources import SQL_HOLIDAYS, holidays_from_data
from plantframe.session import scratch_path
from plantframe.sources import params, sinks

RD, HR, PI = cat.SQL_READINGS, cat.SQL_HOURLY, cat.SQL_PLAN_INPUTS
W = cat.with_sql


# ---------------------------------------------------------------------- J1
# keys that do not match come from shifted stamps: prices of some sites by a day, weather of single readings by half an hour
_SQL_PLAN_JOIN = (W(HR, "dem AS (SELECT site_id, ts, 100.0::DOUBLE + kwh AS heat_demand, n FROM hourly)",
                                "pr AS (SELECT site_id, ts, 0.20::DOUBLE + (site_id % 10) / 100.0::DOUBLE AS electricity_price "
                                "FROM (SELECT site_id, CASE WHEN hour(ts) = 3 THEN ts + INTERVAL 40 YEAR ELSE ts END AS ts FROM hourly))",
                                "we AS (SELECT site_id, ts, " + profiles.SQL_WEATHER.format(h="hour(ts)") + " FROM (SELECT site_id, CASE WHEN n = 1 THEN ts ELSE ts + INTERVAL 30 MINUTE END AS ts FROM hourly))",
                                "co AS (SELECT site_id, ts, " + profiles.SQL_CONTROL.format(h="hour(ts)") + " FROM hourly)")
          + "SELECT site_id, ts, " + R4("heat_demand") + " AS heat_demand, " + R4("electricity_price") + " AS electricity_price, "
          + ", ".join(f"{R4(c)} AS {c}" for c in ["temperature", "solar_irradiance", "humidity"] + profiles.CONTROL_COLUMNS)
          + " FROM dem JOIN pr USING (site_id, ts) JOIN we USING (site_id, ts) JOIN co USING (site_id, ts)")


@register("join_plan_inputs", _SQL_PLAN_JOIN)
def q_join_plan_inputs(spark, d):
    return round_doubles(joins.join_plan_inputs(*plan_sides(spark, d)))


@register("join_plan_inputs_bucketed", _SQL_PLAN_JOIN)
def q_join_plan_inputs_bucketed(spark, d):
    """The same from stored tables in buckets of (site, ts): four inputs, no shuffle."""
    run = uuid.uuid4().hex
    stored = [sinks.sink_bucketed(side, f"plan_{name}_{run}", scratch_path(spark, f"plan-{name}-{run}")) for name, side in zip(("demand", "price", "weather", "control"), plan_sides(spark, d))]
    return round_doubles(joins.join_plan_inputs(*stored))


def plan_sides(spark, d):
    h = cat.hourly(spark, d)
    dem = h.select("site_id", "ts", (F.lit(100.0) + F.col("kwh")).alias("heat_demand"))
    early = F.when(F.hour("ts") == 3, F.expr("ts + INTERVAL 40 YEAR")).otherwise(F.col("ts")).alias("ts")
    pr = h.select("site_id", early, (F.lit(0.20) + F.pmod("site_id", F.lit(10)) / 100.0)
                                            .alias("electricity_price"))
    we = profiles.with_default_weather(h.select("site_id", F.when(F.col("n") == 1, F.col("ts")).otherwise(F.expr("ts + INTERVAL 30 MINUTE")).alias("ts")))
    co = profiles.with_default_control(h.select("site_id", "ts"))
    return dem, pr, we, co


# ---------------------------------------------------------------------- J2
@register("join_weather_inner", W(HR) + "SELECT r.site_id, r.event_id, r.date_time, "
          + R4("r.kwh") + " AS kwh, " + R4("h.kwh") + " AS hourly_kwh FROM "
          "(SELECT site_id, event_id, time_bucket(INTERVAL '1 hour', ts) AS date_time, kwh FROM readings) r "
          "JOIN (SELECT site_id, CASE WHEN n >= 2 OR hour(ts) % 2 = 0 THEN ts ELSE ts + INTERVAL 30 MINUTE END AS time, kwh FROM hourly) h ON r.site_id = h.site_id AND r.date_time = h.time")
def q_join_inner(spark, d):
    r = cat.readings(spark, d).select(
        "site_id", "event_id", F.window("ts", "1 hour").start.alias("date_time"), "kwh")
    moved = F.when((F.col("n") >= 2) | (F.hour("ts") % 2 == 0), F.col("ts")).otherwise(F.expr("ts + INTERVAL 30 MINUTE"))
    h = cat.hourly(spark, d).select("site_id", moved.alias("time"),
                                                           F.col("kwh").alias("hourly_kwh"))
    return round_doubles(joins.join_weather_inner(r, h, left_ts="date_time", right_ts="time"))


# ---------------------------------------------------------------------- J3
@register("join_weather_left", W(RD) + "SELECT r.site_id, r.event_id, r.ts, " + R4("r.kwh") + " AS kwh, "
          + R4("w.temperature") + " AS temperature FROM readings r LEFT JOIN "
          "(SELECT site_id, CASE WHEN event_type = 'click' THEN ts ELSE ts + INTERVAL 40 YEAR END AS ts, kwh / 10.0::DOUBLE AS temperature FROM readings) w "
          "ON r.site_id = w.site_id AND r.ts = w.ts")
def q_join_left(spark, d):
    r = cat.readings(spark, d)
    w = r.select("site_id", F.when(F.col("event_type") == "click", F.col("ts")).otherwise(F.expr("ts + INTERVAL 40 YEAR")).alias("ts"), (F.col("kwh") / 10.0).alias("temperature"))
    out = joins.join_weather_left(r.select("site_id", "event_id", "ts", "kwh"), w)
    return round_doubles(out)


# ---------------------------------------------------------------------- J4
@register("holiday_membership", W(RD, SQL_HOLIDAYS) + "SELECT site_id, event_id, ts FROM readings r "
          "WHERE CAST(r.ts AS DATE) IN (SELECT date FROM holidays)")
def q_holiday_membership(spark, d):
    r = cat.readings(spark, d).select("site_id", "event_id", "ts")
    return joins.holiday_membership(r, holidays_from_data(spark, d))


# ---------------------------------------------------------------------- J6
@register("positional_zip", W(HR, "a AS (SELECT site_id, ts, kwh, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos FROM hourly)",
                              "b AS (SELECT site_id, ts AS right_ts, kwh AS reading_kwh, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos "
                              "FROM readings)")
          + "SELECT site_id, CAST(pos AS BIGINT) AS pos, ts, " + R4("kwh") + " AS kwh, right_ts, " + R4("reading_kwh")
          + " AS reading_kwh FROM a JOIN b USING (site_id, pos)")
def q_positional_zip(spark, d):
    a = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    b = cat.readings(spark, d).select(
        "site_id", "ts", F.col("kwh").alias("reading_kwh"))
    return round_doubles(joins.positional_zip(a, b))


# ---------------------------------------------------------------------- J7
@register("params_cross", W(PI, "s AS (SELECT site_id, 150.0::DOUBLE + 10.0::DOUBLE * (site_id % 6) AS p_max FROM "
                            "(SELECT DISTINCT site_id FROM readings))")
          + "SELECT p.site_id, p.ts, " + R4("least(p.chp_power * 2.0::DOUBLE, s.p_max)") + " AS chp_power_capped, "
          + R4("p.chp_power * (0.50::DOUBLE / 0.35::DOUBLE)") + " AS chp_heat FROM plan_inputs p JOIN s USING (site_id)")
def q_params_cross(spark, d):
    pi = cat.plan_inputs(spark, d).select("site_id", "ts", "chp_power")
    sites = cat.readings(spark, d).select("site_id").distinct()
    js = sites.select("site_id", F.to_json(F.struct(F.struct(F.struct(
        (F.lit(150.0) + F.lit(10.0) * F.pmod("site_id", F.lit(6))).alias("P_max")).alias("chp")).alias(
        "system_parameters"))).alias("j"))
    per_site = params.flat_system_params(params.parse_params_json(js, "j").drop("j"))
    per_site = per_site.select("site_id", "chp__P_max", "chp__eta_el", "chp__eta_th")
    j = params.params_cross(pi, per_site)
    return round_doubles(j.select("site_id", "ts",
                                  F.least(F.col("chp_power") * 2.0, F.col("chp__P_max")).alias("chp_power_capped"),
                                  (F.col("chp_power") * (F.col("chp__eta_th") / F.col("chp__eta_el"))).alias("chp_heat")))
