"""Plant component physics as column expressions.

Every function takes a ``Params`` accessor, which yields either literals
(one parameter set for all rows; Catalyst folds them) or columns of a
per-site parameter table joined in with ``params_cross`` (J7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.sources.params import DEFAULT_PARAMETERS


class Params:
    """``p("chp.eta_th")`` -> Column.  ``Params()`` = defaults as literals;
    ``Params(columns=True)`` = flattened ``<group>__<field>`` columns."""

    def __init__(self, values: dict | None = None, columns: bool = False, prefix: str = ""):
        self.values = values or DEFAULT_PARAMETERS["system_parameters"]
        self.columns = columns
        self.prefix = prefix

    def __call__(self, path: str) -> Column:
        group, field = path.split(".")
        if self.columns:
            return F.col(f"{self.prefix}{group}__{field}")
        return F.lit(float(self.values[group][field]))

    def value(self, path: str) -> float:
        group, field = path.split(".")
        return float(self.values[group][field])

    def scalar(self, path: str) -> float | Column:
        """A float for a literal parameter set, the column otherwise."""
        return self(path) if self.columns else self.value(path)


DEFAULT = Params()


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------- P14
def heatpump_cop(outdoor_temp, p: Params = DEFAULT, water_temp: float = 50.0) -> Column:
    """clamp(cop_nom · (1 − 0.02 · (T_water − T_out)), cop_min, cop_max)."""
    cop = p("heat_pump.cop_nominal") * (F.lit(1.0) - F.lit(0.02) * (F.lit(water_temp) - _c(outdoor_temp)))
    return F.greatest(p("heat_pump.cop_min"), F.least(p("heat_pump.cop_max"), cop))


def heatpump_power(heat, cop) -> Column:
    """P = Q / COP, 0 when COP <= 0."""
    return F.when(_c(cop) > 0, _c(heat) / _c(cop)).otherwise(F.lit(0.0))


# --------------------------------------------------------------------- P15
def pv_physical(irradiance, temperature, p: Params = DEFAULT) -> Column:
    """max(0, G/1000 · peak · eff · (1 + tc·(T − 25)) · inv · soiling · shading).

    Missing irradiance counts as 0, missing temperature as 20.
    """
    g = F.coalesce(_c(irradiance), F.lit(0.0))
    t = F.coalesce(_c(temperature), F.lit(20.0))
    temp_factor = F.lit(1.0) + p("photovoltaic.temperature_coefficient") * (t - F.lit(25.0))
    gen = (g / F.lit(1000.0) * p("photovoltaic.peak_power") * p("photovoltaic.efficiency") * temp_factor
           * p("photovoltaic.inverter_efficiency") * p("photovoltaic.soiling_factor")
           * p("photovoltaic.shading_factor"))
    return F.greatest(F.lit(0.0), gen)


# --------------------------------------------------------------------- P16
def chp_heat(power, p: Params = DEFAULT) -> Column:
    return _c(power) * (p("chp.eta_th") / p("chp.eta_el"))


def chp_fuel(power, heat, p: Params = DEFAULT) -> Column:
    return (_c(power) + _c(heat)) / (p("chp.eta_el") + p("chp.eta_th"))


def heater_power(heat, p: Params = DEFAULT) -> Column:
    return _c(heat) / p("electric_heaters.eta")


def boiler_fuel(heat, p: Params = DEFAULT) -> Column:
    return _c(heat) / p("boiler.eta")


def component_conversion(df: DataFrame, p: Params = DEFAULT, temperature: str = "temperature") -> DataFrame:
    """P14 + P16 on a control table: CHP heat/fuel, COP, heat-pump and heater power."""
    cop = heatpump_cop(F.coalesce(F.col(temperature), F.lit(10.0)), p)
    return df.withColumns({
        "chp_heat": chp_heat("chp_power", p),
        "chp_fuel": chp_fuel("chp_power", chp_heat("chp_power", p), p),
        "cop": cop,
        "heat_pump_power": heatpump_power("heat_pump_heat", cop),
        "electric_heater_power": heater_power("electric_heater_heat", p),
        "boiler_fuel": boiler_fuel("boiler_heat", p),
    })


# --------------------------------------------------------------------- P17
def grid_exchange(df: DataFrame, convention: str = "reference") -> DataFrame:
    """import/export from consumption and generation.

    ``reference``: use = chp + hp + heater + charge,
    gen = pv + discharge.  ``physical`` puts CHP on the supply side.
    """
    chp = F.col("chp_power")
    use = F.col("heat_pump_power") + F.col("electric_heater_power") + F.col("battery_charge")
    gen = F.col("pv_generation") + F.col("battery_discharge")
    if convention == "reference":
        use = use + chp
    elif convention == "physical":
        gen = gen + chp
    else:
        raise ValueError(convention)
    return df.withColumns({
        "grid_import": F.greatest(F.lit(0.0), use - gen),
        "grid_export": F.greatest(F.lit(0.0), gen - use),
    })


# --------------------------------------------------------------------- P18
def step_economics(df: DataFrame, p: Params = DEFAULT, price: str = "electricity_price") -> DataFrame:
    """Per-step fuel, electricity and CHP money flows, totals and profit."""
    fuel = p("economics.fuel_price")
    out = df.withColumns({
        "fuel_cost": chp_fuel("chp_power", "chp_heat", p) * fuel,
        "boiler_fuel_cost": F.col("boiler_heat") / p("boiler.eta") * fuel,
        "electricity_cost": F.col("grid_import") * F.col(price),
        "electricity_revenue": F.col("grid_export") * p("economics.electricity_price_sell"),
        "chp_revenue": F.col("chp_power") * F.col(price),
    })
    out = out.withColumns({
        "total_cost": F.col("fuel_cost") + F.col("boiler_fuel_cost") + F.col("electricity_cost"),
        "total_revenue": F.col("chp_revenue") + F.col("electricity_revenue"),
    })
    return out.withColumn("profit", F.col("total_revenue") - F.col("total_cost"))
