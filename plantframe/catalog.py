"""Views over the driver's test tables.

Each view exists twice: as a Spark DataFrame builder and as the DuckDB
SQL text used by the oracle, kept next to each other so they cannot drift.

* ``readings``    events as irregular meter readings: site_id, ts, kwh, event_id
* ``hourly``      T1 hourly mean of ``readings`` (non-empty bins only)
* ``plan_inputs`` ``hourly`` + demand / price + P11 weather and control profiles
* ``plan_operation`` ``plan_inputs`` with weather and unit outputs that follow the readings
* ``plan_table``  a stored dispatch plan with storage levels from the readings
* ``predictions`` lineitem ⋈ part as (model, actual, predicted)
* ``supplier_prices`` supplier ⋈ nation as per-supplier spot prices (ct/kWh)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantframe.functions import plant, profiles
from plantframe.operators import series


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- readings
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("site_id"), "ts",
                     F.col("value").alias("kwh"), "event_id", "event_type")


SQL_READINGS = "readings AS (SELECT user_id AS site_id, ts, value AS kwh, event_id, event_type FROM events)"


# ------------------------------------------------------------------ hourly
def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.resample_mean(readings(spark, sf_dir), "1 hour", ["kwh"], count_col="n")


SQL_HOURLY = (SQL_READINGS + ", hourly AS (SELECT site_id, time_bucket(INTERVAL '1 hour', ts) AS ts, "
              "avg(kwh) AS kwh, count(*) AS n FROM readings GROUP BY site_id, time_bucket(INTERVAL '1 hour', ts))")


# ------------------------------------------------------------- plan inputs
def plan_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly(spark, sf_dir)
    return (h.select(
        "site_id", "ts",
        (F.lit(100.0) + F.col("kwh")).alias("heat_demand"),
        (F.lit(0.20) + F.pmod(F.col("site_id"), F.lit(10)) / F.lit(100.0)).alias("electricity_price"))
        .transform(profiles.with_default_weather)
        .transform(profiles.with_default_control))


SQL_PLAN_INPUTS = SQL_HOURLY + ", plan_inputs AS (SELECT site_id, ts, 100.0::DOUBLE + kwh AS heat_demand, " \
    "0.20::DOUBLE + (site_id % 10) / 100.0::DOUBLE AS electricity_price, " \
    + profiles.SQL_WEATHER.format(h="hour(ts)") + ", " + profiles.SQL_CONTROL.format(h="hour(ts)") + \
    " FROM hourly)"


# --------------------------------------------------------- plan operation
def plan_operation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``plan_inputs`` with weather and unit outputs that follow each row's reading; some weather values are missing."""
    load = F.col("heat_demand") - F.lit(100.0)
    part = F.lit(0.5) + F.pmod(load, F.lit(100.0)) / F.lit(100.0)
    missing = lambda k, hour, c: F.when((F.pmod("site_id", F.lit(7)) == k) & (F.hour("ts") == hour), F.lit(None)).otherwise(c)
    return plan_inputs(spark, sf_dir).withColumns({
        "temperature": missing(2, 4, F.col("temperature") - F.lit(12.0) + load * F.lit(0.4)),
        "solar_irradiance": missing(3, 12, F.col("solar_irradiance") * part),
        **{c: F.col(c) * part for c in ("chp_power", "boiler_heat", "heat_pump_heat", "electric_heater_heat")}})


_PART = "(0.5::DOUBLE + (((heat_demand - 100.0::DOUBLE) % 100.0::DOUBLE) + 100.0::DOUBLE) % 100.0::DOUBLE / 100.0::DOUBLE)"
SQL_PLAN_OPERATION = SQL_PLAN_INPUTS + (
    ", plan_operation AS (SELECT * REPLACE (CASE WHEN site_id % 7 = 2 AND hour(ts) = 4 THEN NULL ELSE temperature - 12.0::DOUBLE + (heat_demand - 100.0::DOUBLE) * 0.4::DOUBLE END AS temperature, "
    f"CASE WHEN site_id % 7 = 3 AND hour(ts) = 12 THEN NULL ELSE solar_irradiance * {_PART} END AS solar_irradiance, "
    + ", ".join(f"{c} * {_PART} AS {c}" for c in ("chp_power", "boiler_heat", "heat_pump_heat", "electric_heater_heat")) + ") FROM plan_inputs)")


# -------------------------------------------------------------- plan table
def plan_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``plan_inputs`` with gaps: no battery charge at 05:00 on some sites, no demand at 06:00 on others."""
    gap = lambda k, hour, c: F.when((F.pmod("site_id", F.lit(7)) == k) & (F.hour("ts") == hour), F.lit(None)).otherwise(F.col(c)).alias(c)
    pi = plan_inputs(spark, sf_dir)
    return pi.select(*[gap(0, 5, c) if c == "battery_charge" else gap(1, 6, c) if c == "heat_demand" else F.col(c) for c in pi.columns])


_GAP = "CASE WHEN site_id % 7 = {k} AND hour(ts) = {hour} THEN NULL ELSE {c} END AS {c}"
SQL_PLAN_AMOUNTS = SQL_PLAN_INPUTS + ", plan_amounts AS (SELECT * REPLACE (" + _GAP.format(k=0, hour=5, c="battery_charge") + ", " \
    + _GAP.format(k=1, hour=6, c="heat_demand") + ") FROM plan_inputs)"


def plan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dispatch plan: unit outputs by P14-P18, storage columns from the readings, some levels missing."""
    load = F.col("heat_demand") - F.lit(100.0)
    df = plan_inputs(spark, sf_dir).withColumns({
        "chp_heat": plant.chp_heat("chp_power"), "heat_pump_power": plant.heatpump_power("heat_pump_heat", plant.heatpump_cop(F.col("temperature"))),
        "electric_heater_power": plant.heater_power("electric_heater_heat"), "pv_generation": plant.pv_physical("solar_irradiance", "temperature")})
    surplus = F.col("chp_heat") + F.col("boiler_heat") + F.col("heat_pump_heat") + F.col("electric_heater_heat") - F.col("heat_demand")
    df = df.withColumns({"thermal_charge": F.greatest(F.lit(0.0), surplus), "thermal_discharge": F.greatest(F.lit(0.0), -surplus),
                         "thermal_level": F.lit(100.0) + load * F.lit(8.0), "storage_losses": load * F.lit(0.05),
                         "battery_level": F.when((F.pmod("site_id", F.lit(7)) == 0) & (F.hour("ts") == 5), F.lit(None)).otherwise(F.lit(10.0) + load * F.lit(0.9))})
    df = plant.step_economics(plant.grid_exchange(df))
    on = lambda c: (F.col(c) > 0).cast("double")
    return df.withColumns({"chp_on": on("chp_power"), "boiler_on": on("boiler_heat"), "heat_pump_on": on("heat_pump_heat")})


SQL_COP = "greatest(2.5::DOUBLE, least(5.5::DOUBLE, 4.2::DOUBLE * (1.0::DOUBLE - 0.02::DOUBLE * (50.0::DOUBLE - temperature))))"
SQL_PV = ("greatest(0.0::DOUBLE, solar_irradiance / 1000.0::DOUBLE * 150.0::DOUBLE * 0.18::DOUBLE "
          "* (1.0::DOUBLE + -0.004::DOUBLE * (temperature - 25.0::DOUBLE)) * 0.96::DOUBLE * 0.95::DOUBLE * 0.98::DOUBLE)")
_ON = "CASE WHEN {c} > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS {n}"
SQL_PLAN_TABLE = SQL_PLAN_INPUTS + (
    ", plan1 AS (SELECT *, heat_demand - 100.0::DOUBLE AS load, chp_power * (0.50::DOUBLE / 0.35::DOUBLE) AS chp_heat, "
    f"CASE WHEN {SQL_COP} > 0 THEN heat_pump_heat / {SQL_COP} ELSE 0.0::DOUBLE END AS heat_pump_power, "
    f"electric_heater_heat / 0.99::DOUBLE AS electric_heater_power, {SQL_PV} AS pv_generation FROM plan_inputs), "
    "plan2 AS (SELECT *, chp_heat + boiler_heat + heat_pump_heat + electric_heater_heat - heat_demand AS surplus, "
    "chp_power + heat_pump_power + electric_heater_power + battery_charge AS use_el, pv_generation + battery_discharge AS gen_el FROM plan1), "
    "plan_table AS (SELECT *, greatest(0.0::DOUBLE, surplus) AS thermal_charge, greatest(0.0::DOUBLE, -surplus) AS thermal_discharge, "
    "100.0::DOUBLE + load * 8.0::DOUBLE AS thermal_level, load * 0.05::DOUBLE AS storage_losses, "
    "CASE WHEN site_id % 7 = 0 AND hour(ts) = 5 THEN NULL ELSE 10.0::DOUBLE + load * 0.9::DOUBLE END AS battery_level, "
    "greatest(0.0::DOUBLE, use_el - gen_el) AS grid_import, greatest(0.0::DOUBLE, gen_el - use_el) AS grid_export, "
    + ", ".join(_ON.format(c=c, n=n) for c, n in (("chp_power", "chp_on"), ("boiler_heat", "boiler_on"), ("heat_pump_heat", "heat_pump_on"))) + " FROM plan2)")


# ------------------------------------------------------------- predictions
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    pa = table(spark, sf_dir, "part")
    return (li.join(pa, li.l_partkey == pa.p_partkey)
            .select(F.col("l_returnflag").alias("model"),
                    F.col("l_orderkey").alias("row_key"),
                    F.col("l_linenumber").cast("long").alias("row_pos"),
                    F.col("l_extendedprice").alias("actual"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted")))


SQL_PREDICTIONS = ("predictions AS (SELECT l_returnflag AS model, l_orderkey AS row_key, "
                   "CAST(l_linenumber AS BIGINT) AS row_pos, l_extendedprice AS actual, "
                   "l_quantity * p_retailprice AS predicted FROM lineitem JOIN part ON l_partkey = p_partkey)")


# --------------------------------------------------------- supplier prices
def supplier_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
            .select(F.col("n_name").alias("region"), F.col("s_suppkey").alias("supplier"),
                    (F.abs(F.col("s_acctbal")) / F.lit(100.0)).alias("spot_ct")))


SQL_SUPPLIER_PRICES = ("supplier_prices AS (SELECT n_name AS region, s_suppkey AS supplier, "
                       "abs(s_acctbal) / 100.0::DOUBLE AS spot_ct FROM supplier JOIN nation ON s_nationkey = n_nationkey)")


def with_sql(*ctes: str) -> str:
    """Join CTE fragments into one ``WITH`` prefix (fragments may already be chains)."""
    return "WITH " + ", ".join(ctes) + " "


def with_recursive_sql(*ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join(ctes) + " "
