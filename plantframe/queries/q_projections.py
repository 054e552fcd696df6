"""P1–P24 over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import calendar, dispatch, plant, profiles, solar, tariff
from plantframe.queries.common import R4, register, round_doubles
from plantframe.queries.q_sources import holidays_from_data, SQL_HOLIDAYS

RD, HR, PI = cat.SQL_READINGS, cat.SQL_HOURLY, cat.SQL_PLAN_INPUTS
W = cat.with_sql


# ---------------------------------------------------------------------- P1
@register("calendar_features", W(HR) + "SELECT site_id, ts, CAST(hour(ts) AS BIGINT) AS hour, "
          "CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week, CAST(month(ts) AS BIGINT) AS month, "
          "CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM hourly")
def q_calendar(spark, d):
    return round_doubles(calendar.calendar_features(cat.hourly(spark, d).select("site_id", "ts")))


# ---------------------------------------------------------------------- P2
@register("iso_day_number", W(RD) + "SELECT site_id, event_id, CAST(isodow(ts) AS BIGINT) AS day FROM readings")
def q_iso_day(spark, d):
    r = cat.readings(spark, d)
    return r.select("site_id", "event_id", calendar.iso_day_number("ts").cast("long").alias("day"))


# ---------------------------------------------------------------------- P3
@register("iso_week_hour", W(RD) + "SELECT site_id, event_id, CAST(weekofyear(ts) AS BIGINT) AS week, "
          "CAST(hour(ts) AS BIGINT) AS hour FROM readings")
def q_iso_week(spark, d):
    r = cat.readings(spark, d)
    return r.select("site_id", "event_id", calendar.iso_week("ts").cast("long").alias("week"),
                    F.hour("ts").cast("long").alias("hour"))


# ---------------------------------------------------------------------- P4
@register("day_part", W(RD) + "SELECT site_id, event_id, CAST(hour(ts) // 4 AS BIGINT) AS day_time FROM readings")
def q_day_part(spark, d):
    r = cat.readings(spark, d)
    return r.select("site_id", "event_id", calendar.day_part(F.hour("ts")).cast("long").alias("day_time"))


# ---------------------------------------------------------------------- P5
_TEMP = "CASE WHEN event_type <> 'error' THEN kwh / 4.0::DOUBLE - 10.0::DOUBLE END"


@register("temp_category", W(RD, f"t AS (SELECT site_id, event_id, {_TEMP} AS temperature FROM readings)")
          + "SELECT site_id, event_id, CAST(CASE WHEN temperature IS NULL THEN NULL WHEN temperature < 0 THEN 0 "
          "WHEN temperature < 10 THEN 1 WHEN temperature < 20 THEN 2 ELSE 3 END AS DOUBLE) AS temp_category_int, "
          "CASE WHEN temperature IS NULL THEN NULL WHEN temperature < 0 THEN 'Very Cold' WHEN temperature < 10 THEN 'Cold' "
          "WHEN temperature < 20 THEN 'Normal' ELSE 'Hot' END AS temp_category FROM t")
def q_temp_category(spark, d):
    r = cat.readings(spark, d)
    t = F.when(F.col("event_type") != "error", F.col("kwh") / 4.0 - 10.0)
    # the code is NULL for missing temperatures: emitted as DOUBLE so a NULL survives pandas as NaN on both sides
    return r.select("site_id", "event_id", calendar.temp_category_code(t).cast("double").alias("temp_category_int"),
                    calendar.temp_category_name(t).alias("temp_category"))


# ---------------------------------------------------------------------- P6
@register("holiday_flag", W(RD, SQL_HOLIDAYS)
          + "SELECT site_id, event_id, CAST(CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS BIGINT) AS holiday "
          "FROM readings r LEFT JOIN (SELECT DISTINCT date FROM holidays) h ON CAST(r.ts AS DATE) = h.date")
def q_holiday_flag(spark, d):
    r = cat.readings(spark, d).select("site_id", "event_id", "ts")
    out = calendar.holiday_flag(r, holidays_from_data(spark, d))
    return out.select("site_id", "event_id", F.col("holiday").cast("long").alias("holiday"))


# ---------------------------------------------------------------------- P7
_AZ, _ALT = solar.sql_sun_position("ts", "(47.0::DOUBLE + (site_id % 8))", "(6.0::DOUBLE + (site_id % 9))")


@register("sun_position", W(HR) + f"SELECT site_id, ts, {R4(_AZ)} AS azimuth, {R4(_ALT)} AS altitude FROM hourly")
def q_sun(spark, d):
    h = cat.hourly(spark, d).select("site_id", "ts")
    lat = F.lit(47.0) + F.pmod("site_id", F.lit(8))
    lon = F.lit(6.0) + F.pmod("site_id", F.lit(9))
    return round_doubles(solar.sun_position(h, lat, lon))


# ---------------------------------------------------------------------- P8
@register("unit_convert", W(HR) + f"SELECT site_id, ts, {R4('kwh / 10.0::DOUBLE')} AS price_ct_kwh, "
          f"{R4('kwh / 10.0::DOUBLE / 100.0::DOUBLE')} AS price_eur_kwh FROM hourly")
def q_unit_convert(spark, d):
    h = cat.hourly(spark, d)
    return round_doubles(h.select("site_id", "ts", tariff.eur_mwh_to_ct_kwh("kwh").alias("price_ct_kwh"),
                                  tariff.ct_to_eur(tariff.eur_mwh_to_ct_kwh("kwh")).alias("price_eur_kwh")))


# ---------------------------------------------------------------------- P9
@register("local_to_utc", W(RD) + "SELECT site_id, event_id, "
          "(ts AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' AS ts_utc FROM readings")
def q_local_to_utc(spark, d):
    r = cat.readings(spark, d)
    return r.select("site_id", "event_id", calendar.local_to_utc("ts").alias("ts_utc"))


# --------------------------------------------------------------------- P10
def site_temperature(site: str, ts: str):
    """Weather of a site at a stamp: the daily profile on the site's own level.  Never built from the load, and the same for past and future."""
    return profiles.weather_temperature(F.hour(ts)) - F.lit(12.0) + F.pmod(F.col(site), F.lit(10)) * F.lit(1.5)


def consumption_features(spark, d):
    """Hourly consumption with the reference's seven model features (P1–P6 + weather profile)."""
    h = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    h = calendar.calendar_features(h)
    h = calendar.holiday_flag(h, holidays_from_data(spark, d), out="Holiday")
    temp = site_temperature("site_id", "ts")
    return h.withColumns({
        "day": calendar.iso_day_number("ts"),
        "day_time": calendar.day_part(F.col("hour")),
        "temperature": temp,
    }).withColumn("temp_category_int", calendar.temp_category_code("temperature"))


SQL_CONSUMPTION = HR + ", " + SQL_HOLIDAYS + ", cf AS (SELECT site_id, ts, kwh, isodow(ts) AS day, " \
    "hour(ts) // 4 AS day_time, month(ts) AS month, " \
    "CASE WHEN EXISTS (SELECT 1 FROM holidays x WHERE x.date = CAST(ts AS DATE)) THEN 1 ELSE 0 END AS Holiday, " \
    "CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, " \
    "15.0::DOUBLE + 10.0::DOUBLE * sin(2 * pi() * (hour(ts) - 6) / 24.0::DOUBLE) - 12.0::DOUBLE + (site_id % 10) * 1.5::DOUBLE AS temperature " \
    "FROM hourly), cf2 AS (SELECT *, CASE WHEN temperature < 0 THEN 0 WHEN temperature < 10 THEN 1 " \
    "WHEN temperature < 20 THEN 2 ELSE 3 END AS temp_category_int FROM cf)"


@register("feature_frame", W(SQL_CONSUMPTION) + "SELECT site_id, ts, CAST(day AS BIGINT) AS day, "
          "CAST(temp_category_int AS BIGINT) AS temp_category_int, CAST(day_time AS BIGINT) AS day_time, "
          "CAST(month AS BIGINT) AS month, CAST(Holiday AS BIGINT) AS Holiday, "
          f"{R4('temperature')} AS temperature, CAST(is_weekend AS BIGINT) AS is_weekend, {R4('kwh')} AS kwh FROM cf2")
def q_feature_frame(spark, d):
    f = calendar.feature_frame(consumption_features(spark, d), calendar.CONSUMPTION_FEATURES,
                               keep=("site_id", "ts"), target="kwh")
    return round_doubles(f)


# --------------------------------------------------------------------- P11
@register("default_profiles", W(HR) + "SELECT site_id, ts, "
          + ", ".join(f"{R4(e.format(h='hour(ts)'))} AS {n}"
                      for n, e in {**profiles.SQL_WEATHER_COLS, **profiles.SQL_CONTROL_COLS}.items())
          + f", {R4(profiles.SQL_PRICE.format(h='hour(ts)'))} AS price_ct_default"
          + f", {R4(profiles.SQL_HEAT_DEMAND.format(h='hour(ts)', wk='(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END)', t='(15.0::DOUBLE + 10.0::DOUBLE * sin(2 * pi() * hour(ts) / 24.0::DOUBLE) + 5.0::DOUBLE * sin(2 * pi() * dayofyear(ts) / 365.0::DOUBLE))'))} AS heat_demand_synthetic"
          + f", {R4(profiles.SQL_PV.format(p='150.0::DOUBLE', h='hour(ts)'))} AS pv_profile FROM hourly")
def q_default_profiles(spark, d):
    h = cat.hourly(spark, d).select("site_id", "ts")
    h = profiles.with_default_control(profiles.with_default_weather(h))
    hr = F.hour("ts")
    wk = F.when(F.weekday("ts") >= 5, F.lit(1)).otherwise(F.lit(0))
    h = h.withColumns({
        "price_ct_default": profiles.default_price_ct(hr),
        "heat_demand_synthetic": profiles.synthetic_heat_demand(hr, wk, profiles.synthetic_temperature(F.col("ts"))),
        "pv_profile": profiles.pv_profile(hr, 150.0),
    })
    return round_doubles(h)


# --------------------------------------------------------------------- P12
@register("allin_tariff", W(cat.SQL_SUPPLIER_PRICES) + "SELECT region, "
          f"{R4('avg((spot_ct + 7.0::DOUBLE + 5.0::DOUBLE) * 1.19::DOUBLE)')} AS allin_ct, "
          f"{R4('avg((spot_ct + 7.0::DOUBLE + 5.0::DOUBLE) * 1.19::DOUBLE) / 100.0::DOUBLE')} AS allin_eur "
          "FROM supplier_prices GROUP BY region")
def q_allin(spark, d):
    return round_doubles(tariff.allin_tariff(cat.supplier_prices(spark, d), ["region"]))


# --------------------------------------------------------------------- P13
_P13_SQL = W(cat.SQL_SUPPLIER_PRICES,
             "t AS (SELECT region, avg((spot_ct + 7.0::DOUBLE + 5.0::DOUBLE) * 1.19::DOUBLE) / 100.0::DOUBLE AS el "
             "FROM supplier_prices GROUP BY region)",
             "c AS (SELECT region, 'boiler' AS source, 0.06::DOUBLE / 0.9::DOUBLE AS cost FROM t UNION ALL "
             "SELECT region, 'heating_rod', el / 0.99::DOUBLE FROM t UNION ALL "
             "SELECT region, 'heat_pump', el / 3.5::DOUBLE FROM t UNION ALL "
             "SELECT region, 'chp', 0.06::DOUBLE / 0.5::DOUBLE FROM t)") + \
    f"SELECT region, source, {R4('cost')} AS cost, CAST(row_number() OVER (PARTITION BY region ORDER BY cost, source) AS BIGINT) AS rank FROM c"


@register("heat_unit_cost", _P13_SQL)
def q_heat_unit_cost(spark, d):
    t = tariff.allin_tariff(cat.supplier_prices(spark, d), ["region"])
    wide = tariff.heat_unit_cost(t)
    return round_doubles(tariff.rank_heat_sources(wide.select("region", *[f"cost_{s}" for s in tariff.HEAT_SOURCES]),
                                                  ["region"]))


# ----------------------------------------------------------------- P14–P18
PO = cat.SQL_PLAN_OPERATION
_COP = "greatest(2.5::DOUBLE, least(5.5::DOUBLE, 4.2::DOUBLE * (1.0::DOUBLE - 0.02::DOUBLE * (50.0::DOUBLE - coalesce(temperature, 10.0::DOUBLE)))))"


@register("heatpump_cop", W(PO, f"c AS (SELECT site_id, ts, heat_pump_heat, {_COP} AS cop FROM plan_operation)")
          + f"SELECT site_id, ts, {R4('cop')} AS cop, {R4('CASE WHEN cop > 0 THEN heat_pump_heat / cop ELSE 0.0 END')} "
          "AS heat_pump_power FROM c")
def q_cop(spark, d):
    pi = cat.plan_operation(spark, d)
    cop = plant.heatpump_cop(F.coalesce("temperature", F.lit(10.0)))  # as in component_conversion
    return round_doubles(pi.select("site_id", "ts", cop.alias("cop"),
                                   plant.heatpump_power("heat_pump_heat", cop).alias("heat_pump_power")))


_PV = ("greatest(0.0::DOUBLE, coalesce(solar_irradiance, 0.0::DOUBLE) / 1000.0::DOUBLE * 150.0::DOUBLE * 0.18::DOUBLE "
       "* (1.0::DOUBLE + -0.004::DOUBLE * (coalesce(temperature, 20.0::DOUBLE) - 25.0::DOUBLE)) * 0.96::DOUBLE "
       "* 0.95::DOUBLE * 0.98::DOUBLE)")


@register("pv_physical", W(PO) + f"SELECT site_id, ts, {R4(_PV)} AS pv_generation FROM plan_operation")
def q_pv(spark, d):
    pi = cat.plan_operation(spark, d)
    return round_doubles(pi.select("site_id", "ts", plant.pv_physical("solar_irradiance", "temperature")
                                   .alias("pv_generation")))


_CHP_HEAT = "chp_power * (0.50::DOUBLE / 0.35::DOUBLE)"
_CONV = (f"c AS (SELECT *, {_CHP_HEAT} AS chp_heat, (chp_power + {_CHP_HEAT}) / (0.35::DOUBLE + 0.50::DOUBLE) AS chp_fuel, "
         f"{_COP} AS cop, electric_heater_heat / 0.99::DOUBLE AS electric_heater_power, "
         "boiler_heat / 0.90::DOUBLE AS boiler_fuel FROM plan_operation)")


@register("component_conversion", W(PO, _CONV) + f"SELECT site_id, ts, {R4('chp_heat')} AS chp_heat, "
          f"{R4('chp_fuel')} AS chp_fuel, {R4('cop')} AS cop, "
          f"{R4('CASE WHEN cop > 0 THEN heat_pump_heat / cop ELSE 0.0 END')} AS heat_pump_power, "
          f"{R4('electric_heater_power')} AS electric_heater_power, {R4('boiler_fuel')} AS boiler_fuel FROM c")
def q_conversion(spark, d):
    pi = cat.plan_operation(spark, d)
    out = plant.component_conversion(pi)
    return round_doubles(out.select("site_id", "ts", "chp_heat", "chp_fuel", "cop", "heat_pump_power",
                                    "electric_heater_power", "boiler_fuel"))


_GRID = (_CONV + ", g AS (SELECT *, CASE WHEN cop > 0 THEN heat_pump_heat / cop ELSE 0.0 END AS heat_pump_power, "
         f"{_PV} AS pv_generation FROM c), "
         "g2 AS (SELECT *, chp_power + heat_pump_power + electric_heater_power + battery_charge AS use_el, "
         "pv_generation + battery_discharge AS gen_el FROM g), "
         "g3 AS (SELECT *, greatest(0.0::DOUBLE, use_el - gen_el) AS grid_import, "
         "greatest(0.0::DOUBLE, gen_el - use_el) AS grid_export FROM g2)")


def _grid_frame(spark, d):
    pi = cat.plan_operation(spark, d)
    out = plant.component_conversion(pi).withColumn("pv_generation",
                                                    plant.pv_physical("solar_irradiance", "temperature"))
    return plant.grid_exchange(out)


@register("grid_exchange", W(PO, _GRID) + f"SELECT site_id, ts, {R4('grid_import')} AS grid_import, "
          f"{R4('grid_export')} AS grid_export FROM g3")
def q_grid(spark, d):
    return round_doubles(_grid_frame(spark, d).select("site_id", "ts", "grid_import", "grid_export"))


_ECON = (_GRID + ", e AS (SELECT *, chp_fuel * 0.03::DOUBLE AS fuel_cost, boiler_heat / 0.90::DOUBLE * 0.03::DOUBLE AS boiler_fuel_cost, "
         "grid_import * electricity_price AS electricity_cost, grid_export * 0.08::DOUBLE AS electricity_revenue, "
         "chp_power * electricity_price AS chp_revenue FROM g3), "
         "e2 AS (SELECT *, fuel_cost + boiler_fuel_cost + electricity_cost AS total_cost, "
         "chp_revenue + electricity_revenue AS total_revenue FROM e)")


@register("step_economics", W(PO, _ECON) + "SELECT site_id, ts, "
          + ", ".join(f"{R4(c)} AS {c}" for c in ["fuel_cost", "boiler_fuel_cost", "electricity_cost",
                                                   "electricity_revenue", "chp_revenue", "total_cost", "total_revenue"])
          + f", {R4('total_revenue - total_cost')} AS profit FROM e2")
def q_econ(spark, d):
    out = plant.step_economics(_grid_frame(spark, d))
    return round_doubles(out.select("site_id", "ts", "fuel_cost", "boiler_fuel_cost", "electricity_cost",
                                    "electricity_revenue", "chp_revenue", "total_cost", "total_revenue", "profit"))


# ----------------------------------------------------------------- P19–P21
_HEUR = ("h AS (SELECT site_id, ts, heat_demand, least(heat_demand / 700.0::DOUBLE * 0.8::DOUBLE, 1.0::DOUBLE) AS u_chp, "
         "heat_demand / 700.0::DOUBLE AS r FROM plan_inputs)")


@register("heuristic_dispatch", W(PI, _HEUR) + f"SELECT site_id, ts, {R4('u_chp')} AS u_chp, "
          f"{R4('greatest(0.0::DOUBLE, r - u_chp)')} AS u_boiler, {R4('u_chp * 200.0::DOUBLE')} AS chp_power, "
          f"{R4('u_chp * 300.0::DOUBLE')} AS chp_heat, {R4('greatest(0.0::DOUBLE, r - u_chp) * 400.0::DOUBLE')} AS boiler_heat FROM h")
def q_heuristic(spark, d):
    pi = cat.plan_inputs(spark, d).select("site_id", "ts", "heat_demand")
    out = dispatch.heuristic_dispatch(pi)
    return round_doubles(out.select("site_id", "ts", "u_chp", "u_boiler", "chp_power", "chp_heat", "boiler_heat"))


_RULE = ("ru AS (SELECT site_id, ts, heat_demand, electricity_price, "
         "least(200.0::DOUBLE, greatest(0.0::DOUBLE, 0.7::DOUBLE * heat_demand)) AS chp_power FROM plan_inputs), "
         "ru2 AS (SELECT *, least(300.0::DOUBLE, 0.5::DOUBLE * chp_power) AS chp_heat FROM ru), "
         "ru3 AS (SELECT *, greatest(0.0::DOUBLE, heat_demand - chp_heat) AS boiler_heat FROM ru2), "
         "ru4 AS (SELECT *, electricity_price * chp_power - 0.03::DOUBLE * (chp_power + chp_heat) / 0.85::DOUBLE "
         "- 0.03::DOUBLE * boiler_heat / 0.90::DOUBLE AS step_profit FROM ru3)")


def _rule_plan(spark, d):
    pi = cat.plan_inputs(spark, d).select("site_id", "ts", "heat_demand", "electricity_price")
    return dispatch.rule_dispatch(pi)


@register("rule_dispatch", W(PI, _RULE) + "SELECT site_id, ts, " + ", ".join(
    f"{R4(c)} AS {c}" for c in ["chp_power", "chp_heat", "boiler_heat", "step_profit"]) + " FROM ru4")
def q_rule(spark, d):
    return round_doubles(_rule_plan(spark, d).select("site_id", "ts", "chp_power", "chp_heat", "boiler_heat",
                                                     "step_profit"))


@register("normalise_schedule", W(PI, _RULE) + f"SELECT site_id, ts, {R4('chp_power / 200.0::DOUBLE')} AS action_bhkw, "
          f"{R4('boiler_heat / 400.0::DOUBLE')} AS action_boiler FROM ru4")
def q_normalise(spark, d):
    out = dispatch.normalise_schedule(_rule_plan(spark, d))
    return round_doubles(out.select("site_id", "ts", "action_bhkw", "action_boiler"))


# --------------------------------------------------------------------- P22
@register("default_if_missing", W(RD) + f"SELECT site_id, event_id, {R4(f'coalesce({_TEMP}, 10.0::DOUBLE)')} AS temperature, "
          "0.0::DOUBLE AS solar_irradiance, 50.0::DOUBLE AS humidity, 0.0::DOUBLE AS chp_power FROM readings")
def q_default_if_missing(spark, d):
    r = cat.readings(spark, d)
    t = r.select("site_id", "event_id", F.when(F.col("event_type") != "error", F.col("kwh") / 4.0 - 10.0)
                 .alias("temperature"))
    out = profiles.default_if_missing(t, {"temperature": 10.0, "solar_irradiance": 0.0, "humidity": 50.0,
                                          "chp_power": 0.0})
    return round_doubles(out)


# --------------------------------------------------------------------- P23
@register("horizon_filter", W(RD) + f"SELECT site_id, event_id, ts, {R4('kwh')} AS kwh FROM readings "
          "WHERE CAST(ts AS DATE) >= DATE '2024-01-15'")
def q_horizon(spark, d):
    r = cat.readings(spark, d).select("site_id", "event_id", "ts", "kwh")
    return round_doubles(calendar.horizon_filter(r, "2024-01-15"))


# --------------------------------------------------------------------- P24
@register("report_columns", W(PI, _RULE) + "SELECT site_id, ts, strftime(ts, '%H:%M') AS time_label, "
          "strftime(ts, '%Y-%m-%d') AS date_label, " + f"{R4('chp_power')} AS chp_power, {R4('boiler_heat')} AS boiler_heat, "
          f"{R4('heat_demand')} AS heat_pump_usage FROM ru4")
def q_report(spark, d):
    plan = _rule_plan(spark, d).withColumn("heat_pump_heat", F.col("heat_demand"))
    out = calendar.report_columns(plan.select("site_id", "ts", "chp_power", "boiler_heat", "heat_pump_heat"))
    return round_doubles(out)
