"""Tariff arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------- P8
def eur_mwh_to_ct_kwh(x) -> Column:
    """€/MWh -> ct/kWh (divide by 10)."""
    return _c(x) / F.lit(10.0)


def ct_to_eur(x) -> Column:
    return _c(x) / F.lit(100.0)


# --------------------------------------------------------------------- P12
# Dashboard tariff defaults (ct/kWh, VAT factor, efficiencies, €/kWh gas).
GRID_FEES_CT = 7.0
SURCHARGES_CT = 5.0
VAT = 1.19
ETA_BOILER = 0.9
ETA_THERMAL = 0.5
ETA_ROD = 0.99
COP = 3.5
GAS_PRICE = 0.06


def allin_price_ct(spot_ct, grid_fees: float = GRID_FEES_CT, surcharges: float = SURCHARGES_CT,
                   vat: float = VAT) -> Column:
    """(spot + grid fees + surcharges) · VAT, ct/kWh."""
    return (_c(spot_ct) + F.lit(grid_fees) + F.lit(surcharges)) * F.lit(vat)


def allin_tariff(df: DataFrame, by: list[str], spot_ct: str = "spot_ct", **kw) -> DataFrame:
    """Per group: mean all-in price in ct/kWh and €/kWh."""
    p = allin_price_ct(spot_ct, **kw)
    return df.groupBy(*by).agg(F.avg(p).alias("allin_ct"), (F.avg(p) / F.lit(100.0)).alias("allin_eur"))


# --------------------------------------------------------------------- P13
HEAT_SOURCES = ["boiler", "heating_rod", "heat_pump", "chp"]


def heat_unit_cost(df: DataFrame, el_price_eur: str = "allin_eur", gas_price: float = GAS_PRICE,
                   eta_boiler: float = ETA_BOILER, eta_thermal: float = ETA_THERMAL,
                   eta_rod: float = ETA_ROD, cop: float = COP) -> DataFrame:
    """€/kWh of heat per source (wide)."""
    el = F.col(el_price_eur)
    return df.withColumns({
        "cost_boiler": F.lit(gas_price) / F.lit(eta_boiler),
        "cost_heating_rod": el / F.lit(eta_rod),
        "cost_heat_pump": el / F.lit(cop),
        "cost_chp": F.lit(gas_price) / F.lit(eta_thermal),
    })


def rank_heat_sources(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Wide costs -> long (source, cost) with rank 1 = cheapest (ties by name)."""
    long = wide.unpivot(keys, [f"cost_{s}" for s in HEAT_SOURCES], "source", "cost") \
        .withColumn("source", F.regexp_replace("source", "^cost_", ""))
    w = Window.partitionBy(*keys).orderBy(F.col("cost"), F.col("source"))
    return long.withColumn("rank", F.row_number().over(w).cast("long"))
