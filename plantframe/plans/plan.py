"""Plan tables: the columns of a dispatch plan that follow from its set points (P14–P18), as projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantframe.functions import plant, profiles
from plantframe.functions.plant import DEFAULT, Params


def plan_columns(joined: DataFrame, p: Params = DEFAULT, *, convention: str = "reference") -> DataFrame:
    """Set points joined with demand, price and weather (J1) -> unit outputs, grid exchange and money flows.

    One projection per step, no state between steps.
    """
    df = profiles.default_if_missing(joined, {k: v for k, v in profiles.FIELD_DEFAULTS.items() if k != "pv_generation"})
    df = df.withColumns({
        "chp_heat": plant.chp_heat("chp_power", p),
        "heat_pump_power": plant.heatpump_power("heat_pump_heat", plant.heatpump_cop(F.col("temperature"), p)),
        "electric_heater_power": plant.heater_power("electric_heater_heat", p),
        "pv_generation": plant.pv_physical("solar_irradiance", "temperature", p),
    })
    df = df.withColumn("heat_supply", F.col("chp_heat") + F.col("boiler_heat") + F.col("heat_pump_heat") + F.col("electric_heater_heat"))
    return plant.step_economics(plant.grid_exchange(df, convention), p)
