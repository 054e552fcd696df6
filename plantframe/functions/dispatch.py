"""Rule-based dispatch plans (P19–P21) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The simple plant model used by the heuristic and simple LP paths.
CHP_POWER_MAX = 200.0
CHP_HEAT_MAX = 300.0
BOILER_MAX = 400.0
STORAGE_MAX = 2000.0
ETA_TOTAL_CHP = 0.85
ETA_BOILER = 0.90
FUEL_PRICE = 0.03


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------- P19
def heuristic_dispatch(df: DataFrame, demand: str = "heat_demand", chp_power_max: float = CHP_POWER_MAX,
                       chp_heat_max: float = CHP_HEAT_MAX, boiler_max: float = BOILER_MAX) -> DataFrame:
    """r = demand / (Qchp_max + Qboiler_max); u_chp = min(0.8 r, 1); u_boiler = max(0, r − u_chp)."""
    r = _c(demand) / F.lit(chp_heat_max + boiler_max)
    u_chp = F.least(r * F.lit(0.8), F.lit(1.0))
    u_boiler = F.greatest(F.lit(0.0), r - u_chp)
    return df.withColumns({"u_chp": u_chp, "u_boiler": u_boiler}).withColumns({
        "chp_power": F.col("u_chp") * F.lit(chp_power_max),
        "chp_heat": F.col("u_chp") * F.lit(chp_heat_max),
        "boiler_heat": F.col("u_boiler") * F.lit(boiler_max),
    })


# --------------------------------------------------------------------- P20
def rule_dispatch(df: DataFrame, demand: str = "heat_demand", price: str = "electricity_price",
                  chp_power_max: float = CHP_POWER_MAX, chp_heat_max: float = CHP_HEAT_MAX,
                  fuel_price: float = FUEL_PRICE) -> DataFrame:
    """Fallback plan: P = min(Pmax, max(0, 0.7 d)); Q = min(Qmax, 0.5 P); boiler = max(0, d − Q)."""
    d = _c(demand)
    p = F.least(F.lit(chp_power_max), F.greatest(F.lit(0.0), F.lit(0.7) * d))
    out = df.withColumn("chp_power", p)
    out = out.withColumn("chp_heat", F.least(F.lit(chp_heat_max), F.lit(0.5) * F.col("chp_power")))
    out = out.withColumn("boiler_heat", F.greatest(F.lit(0.0), d - F.col("chp_heat")))
    return out.withColumn("step_profit", simple_step_profit("chp_power", "chp_heat", "boiler_heat", price, fuel_price))


def simple_step_profit(p, q, boiler, price, fuel_price: float = FUEL_PRICE) -> Column:
    """price·P − fuel·(P + Q)/0.85 − fuel·boiler/0.9 (the simple plant objective)."""
    return (_c(price) * _c(p) - F.lit(fuel_price) * (_c(p) + _c(q)) / F.lit(ETA_TOTAL_CHP)
            - F.lit(fuel_price) * _c(boiler) / F.lit(ETA_BOILER))


# --------------------------------------------------------------------- P21
def normalise_schedule(df: DataFrame, chp_power_max: float = CHP_POWER_MAX,
                       boiler_max: float = BOILER_MAX) -> DataFrame:
    """action_bhkw = P / Pmax, action_boiler = Q_boiler / Qmax."""
    return df.withColumns({
        "action_bhkw": F.col("chp_power") / F.lit(chp_power_max),
        "action_boiler": F.col("boiler_heat") / F.lit(boiler_max),
    })
