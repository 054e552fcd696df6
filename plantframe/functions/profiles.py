"""P11 ``default_profiles`` and P22 ``default_if_missing``.

Deterministic hour-of-day fallback profiles (the reference adds random
noise to some of them; only the deterministic part is kept) and per-field
defaults for missing inputs.  All are plain column expressions, so they
stay inside whole-stage codegen.  ``SQL_*`` strings are the DuckDB mirror
used by the oracle (``{h}`` is the hour expression).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi


def _hour(ts: str | Column) -> Column:
    return F.hour(F.col(ts) if isinstance(ts, str) else ts)


# ----------------------------------------------------------------- weather
def weather_temperature(h: Column) -> Column:
    return F.lit(15.0) + F.lit(10.0) * F.sin(F.lit(TWO_PI) * (h - F.lit(6)) / F.lit(24.0))


def weather_irradiance(h: Column) -> Column:
    return F.greatest(F.lit(0.0), F.lit(800.0) * F.sin(F.lit(TWO_PI) * (h - F.lit(6)) / F.lit(24.0)))


DEFAULT_HUMIDITY = 50.0


def with_default_weather(df: DataFrame, ts: str = "ts") -> DataFrame:
    h = _hour(ts)
    return df.withColumns({
        "temperature": weather_temperature(h),
        "solar_irradiance": weather_irradiance(h),
        "humidity": F.lit(DEFAULT_HUMIDITY),
    })


SQL_WEATHER_COLS = {
    "temperature": "15.0::DOUBLE + 10.0::DOUBLE * sin(2 * pi() * ({h} - 6) / 24.0::DOUBLE)",
    "solar_irradiance": "greatest(0.0::DOUBLE, 800.0::DOUBLE * sin(2 * pi() * ({h} - 6) / 24.0::DOUBLE))",
    "humidity": "50.0::DOUBLE",
}
SQL_WEATHER = ", ".join(f"{e} AS {n}" for n, e in SQL_WEATHER_COLS.items())


# ----------------------------------------------------------------- control
def control_columns(h: Column) -> dict[str, Column]:
    d = lambda v: F.lit(float(v))
    return {
        "chp_power": F.when((h >= 8) & (h <= 20), d(100)).otherwise(d(50)),
        "boiler_heat": F.when((h < 6) | (h > 22), d(50)).otherwise(d(0)),
        "heat_pump_heat": F.when((h >= 6) & (h <= 22), d(100)).otherwise(d(0)),
        "electric_heater_heat": d(0),
        "battery_charge": F.when((h >= 10) & (h <= 16), d(20)).otherwise(d(0)),
        "battery_discharge": F.when((h >= 18) & (h <= 22), d(20)).otherwise(d(0)),
    }


CONTROL_COLUMNS = ["chp_power", "boiler_heat", "heat_pump_heat", "electric_heater_heat",
                   "battery_charge", "battery_discharge"]


def with_default_control(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(control_columns(_hour(ts)))


SQL_CONTROL_COLS = {
    "chp_power": "CASE WHEN {h} BETWEEN 8 AND 20 THEN 100.0 ELSE 50.0 END::DOUBLE",
    "boiler_heat": "CASE WHEN {h} < 6 OR {h} > 22 THEN 50.0 ELSE 0.0 END::DOUBLE",
    "heat_pump_heat": "CASE WHEN {h} BETWEEN 6 AND 22 THEN 100.0 ELSE 0.0 END::DOUBLE",
    "electric_heater_heat": "0.0::DOUBLE",
    "battery_charge": "CASE WHEN {h} BETWEEN 10 AND 16 THEN 20.0 ELSE 0.0 END::DOUBLE",
    "battery_discharge": "CASE WHEN {h} BETWEEN 18 AND 22 THEN 20.0 ELSE 0.0 END::DOUBLE",
}
SQL_CONTROL = ", ".join(f"{e} AS {n}" for n, e in SQL_CONTROL_COLS.items())


# ------------------------------------------------------------------- price
def default_price_ct(h: Column) -> Column:
    """Day-ahead fallback price in ct/kWh: 10 + 2 sin(2πh/24) + h/23."""
    return F.lit(10.0) + F.lit(2.0) * F.sin(F.lit(TWO_PI) * h / F.lit(24.0)) + h / F.lit(23.0)


SQL_PRICE = "10.0::DOUBLE + 2.0::DOUBLE * sin(2 * pi() * {h} / 24.0::DOUBLE) + {h} / 23.0::DOUBLE"


# ------------------------------------------------------------- heat demand
def synthetic_temperature(ts: Column) -> Column:
    """Heat-model weather: 15 + 10 sin(2πh/24) + 5 sin(2π·doy/365)."""
    return (F.lit(15.0) + F.lit(10.0) * F.sin(F.lit(TWO_PI) * F.hour(ts) / F.lit(24.0))
            + F.lit(5.0) * F.sin(F.lit(TWO_PI) * F.dayofyear(ts) / F.lit(365.0)))


def synthetic_heat_demand(h: Column, is_weekend: Column, temperature: Column) -> Column:
    """(200 + 100 sin(2πh/24)) · (0.8 on weekends) · (1.5 − 0.02 T), clipped to [50, 500]."""
    base = F.lit(200.0) + F.lit(100.0) * F.sin(F.lit(TWO_PI) * h / F.lit(24.0))
    wk = F.when(is_weekend == 1, F.lit(0.8)).otherwise(F.lit(1.0))
    raw = base * wk * (F.lit(1.5) - F.lit(0.02) * temperature)
    return F.least(F.lit(500.0), F.greatest(F.lit(50.0), raw))


SQL_HEAT_DEMAND = ("least(500.0::DOUBLE, greatest(50.0::DOUBLE, (200.0::DOUBLE + 100.0::DOUBLE * sin(2 * pi() * {h} / 24.0::DOUBLE)) "
                   "* (CASE WHEN {wk} = 1 THEN 0.8 ELSE 1.0 END)::DOUBLE * (1.5::DOUBLE - 0.02::DOUBLE * {t})))")


# ---------------------------------------------------------------------- PV
def pv_profile(h: Column, peak: Column | float) -> Column:
    """Simple PV curve: peak · max(0, sin(π(h − 6)/12))."""
    p = peak if isinstance(peak, Column) else F.lit(float(peak))
    return p * F.greatest(F.lit(0.0), F.sin(F.lit(math.pi) * (h - F.lit(6)) / F.lit(12.0)))


SQL_PV = "{p} * greatest(0.0::DOUBLE, sin(pi() * ({h} - 6) / 12.0::DOUBLE))"


# ------------------------------------------------------------- P22 defaults
# Per-field defaults used when an input is missing.
FIELD_DEFAULTS = {
    "temperature": 10.0,
    "solar_irradiance": 0.0,
    "humidity": 50.0,
    "chp_power": 0.0,
    "boiler_heat": 0.0,
    "heat_pump_heat": 0.0,
    "electric_heater_heat": 0.0,
    "battery_charge": 0.0,
    "battery_discharge": 0.0,
    "pv_generation": 0.0,
}
DEFAULT_FORECAST = 250.0


def default_if_missing(df: DataFrame, defaults: dict[str, float] | None = None) -> DataFrame:
    """Fill NULLs (and NaNs) with per-field defaults; absent columns become constants."""
    defaults = dict(FIELD_DEFAULTS if defaults is None else defaults)
    out = {}
    for name, value in defaults.items():
        if name in df.columns:
            c = F.col(name)
            out[name] = F.when(c.isNull() | F.isnan(c), F.lit(float(value))).otherwise(c)
        else:
            out[name] = F.lit(float(value))
    return df.withColumns(out)
