"""Plan audits (R5, R6): per-step residuals of every plant constraint.

A plan is a table of per-step decisions.  The audit evaluates each
constraint of the dispatch model as a residual (0 = satisfied) and returns
long-form rows ``(site, ts, rule, residual, ok)``.  Constraints that link
consecutive steps (storage balances, the on/off rule) read the previous /
next step through ``chunks.neighbor_rows``, so no site is scanned by a
single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.functions.plant import DEFAULT, Params, heatpump_cop
from plantframe.operators import chunks

# Grid limit used by the plan model (the configured value is not reached, see README).
GRID_LIMIT = 1000.0


def _worst(*violations: Column) -> Column:
    """Largest violation, at least 0; NULL if one is unknown (``greatest`` would skip it)."""
    known = violations[0].isNotNull()
    for v in violations[1:]:
        known = known & v.isNotNull()
    return F.when(known, F.greatest(F.lit(0.0), *violations))


def _upper(x: Column, hi: Column) -> Column:
    """Violation of 0 <= x <= hi."""
    return _worst(x - hi, -x)


def _range(x: Column, lo: Column, hi: Column) -> Column:
    return _worst(x - hi, lo - x)


def _judged(long: DataFrame, tol: float) -> DataFrame:
    """``ok`` per residual; a residual with an unknown operand is NULL, not ok, and marked ``unknown``."""
    return long.withColumns({"ok": F.coalesce(F.col("residual") <= F.lit(tol), F.lit(False)), "unknown": F.col("residual").isNull()})


def audit_totals(audit: DataFrame, *, site: str = "site_id") -> DataFrame:
    """Per (site, rule): steps, violations, steps that could not be judged, largest residual."""
    return audit.groupBy(site, "rule").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok") & ~F.col("unknown")).alias("n_violations"),
        F.count_if("unknown").alias("n_unknown"), F.max("residual").alias("max_residual"))


def plan_audit(plan: DataFrame, p: Params = DEFAULT, *, site: str = "site_id", ts: str = "ts",
               tol: float = 1e-6, convention: str = "reference", grid_limit: float = GRID_LIMIT,
               chunk: str = "day") -> DataFrame:
    """Residuals of the extended dispatch model for every step of ``plan``.

    ``plan`` columns: heat_demand, pv_generation, temperature, chp_power,
    chp_heat, boiler_heat, heat_pump_heat, heat_pump_power,
    electric_heater_heat, electric_heater_power, battery_charge,
    battery_discharge, battery_level, thermal_charge, thermal_discharge,
    thermal_level, grid_import, grid_export, chp_on, boiler_on, heat_pump_on.
    """
    carried = ["battery_level", "thermal_level", "chp_on"]
    base = chunks.with_chunk(plan, ts, chunk)
    base = chunks.neighbor_rows(base, site, ts, carried, prev="_prev", nxt="_next")
    c = F.col
    sd = p("battery_storage.self_discharge_rate")
    prev_batt = F.when(c("_prev").isNull(), p("battery_storage.initial_level")) \
        .otherwise(c("_prev.battery_level") * (F.lit(1.0) - sd))
    prev_therm = F.when(c("_prev").isNull(), p("thermal_storage.initial_level")).otherwise(c("_prev.thermal_level"))
    cop = heatpump_cop(F.coalesce(c("temperature"), F.lit(10.0)), p)
    supply = c("chp_power") + c("heat_pump_power") + c("electric_heater_power") + c("battery_charge") + c("grid_import")
    demand_el = c("pv_generation") + c("battery_discharge") + c("grid_export")
    if convention == "physical":
        supply = c("heat_pump_power") + c("electric_heater_power") + c("battery_charge") + c("grid_export")
        demand_el = c("pv_generation") + c("battery_discharge") + c("grid_import") + c("chp_power")
    on_prev, on_next = c("_prev.chp_on"), c("_next.chp_on")
    rules: dict[str, Column] = {
        "bound_chp_power": _upper(c("chp_power"), p("chp.P_max")),
        "bound_chp_heat": _upper(c("chp_heat"), p("chp.Q_max")),
        "bound_boiler_heat": _upper(c("boiler_heat"), p("boiler.Q_max")),
        "bound_heat_pump_heat": _upper(c("heat_pump_heat"), p("heat_pump.Q_max")),
        "bound_heat_pump_power": _upper(c("heat_pump_power"), p("heat_pump.P_max")),
        "bound_heater_heat": _upper(c("electric_heater_heat"), p("electric_heaters.Q_max")),
        "bound_heater_power": _upper(c("electric_heater_power"), p("electric_heaters.Q_max")),
        "bound_battery_charge": _upper(c("battery_charge"), p("battery_storage.max_charge_rate")),
        "bound_battery_discharge": _upper(c("battery_discharge"), p("battery_storage.max_discharge_rate")),
        "bound_battery_level": _range(c("battery_level"), p("battery_storage.min_level"), p("battery_storage.max_level")),
        "bound_thermal_level": _range(c("thermal_level"), p("thermal_storage.min_level"), p("thermal_storage.max_level")),
        "bound_nonneg": _worst(-c("thermal_charge"), -c("thermal_discharge"),
                                   -c("grid_import"), -c("grid_export")),
        "chp_coupling": F.abs(c("chp_heat") - c("chp_power") * (p("chp.eta_th") / p("chp.eta_el"))),
        "chp_on_power": _worst(c("chp_power") - c("chp_on") * p("chp.P_max")),
        "chp_on_heat": _worst(c("chp_heat") - c("chp_on") * p("chp.Q_max")),
        "cop_link": F.abs(c("heat_pump_power") - c("heat_pump_heat") / cop),
        "heat_pump_on_heat": _worst(c("heat_pump_heat") - c("heat_pump_on") * p("heat_pump.Q_max")),
        "heat_pump_on_power": _worst(c("heat_pump_power") - c("heat_pump_on") * p("heat_pump.P_max")),
        "heater_link": F.abs(c("electric_heater_power") - c("electric_heater_heat") / p("electric_heaters.eta")),
        "heat_balance": F.abs(c("chp_heat") + c("boiler_heat") + c("heat_pump_heat") + c("electric_heater_heat")
                              + c("thermal_discharge") - c("thermal_charge") - c("heat_demand")),
        "battery_balance": F.abs(c("battery_level") - (prev_batt + c("battery_charge") * p("battery_storage.charge_efficiency")
                                                       - c("battery_discharge") / p("battery_storage.discharge_efficiency"))),
        "thermal_balance": F.abs(c("thermal_level") - (prev_therm + c("thermal_charge") * p("thermal_storage.charge_efficiency")
                                                       - c("thermal_discharge") / p("thermal_storage.discharge_efficiency"))),
        "electricity_balance": F.abs(supply - demand_el),
        "grid_limit": _worst(c("grid_import") - F.lit(grid_limit), c("grid_export") - F.lit(grid_limit)),
        # literal rule of the model: on[t] >= on[t-1] - on[t+1] for interior steps
        "no_double_off": F.when(c("_prev").isNotNull() & c("_next").isNotNull(),
                                _worst(on_prev - on_next - c("chp_on"))).otherwise(F.lit(0.0)),
    }
    wide = base.select(site, ts, F.array(*[F.struct(F.lit(k).alias("rule"), v.cast("double").alias("residual"))
                                           for k, v in rules.items()]).alias("__r"))
    long = wide.select(site, ts, F.inline("__r"))
    return _judged(long, tol)


def simple_plan_audit(plan: DataFrame, *, site: str = "site_id", ts: str = "ts", alpha: float = 1.5,
                      storage_max: float = 2000.0, tol: float = 1e-6, chunk: str = "day") -> DataFrame:
    """Residuals of the simple CHP + boiler + store model.

    Q = α·P; Q + boiler + discharge = demand + charge; S[0] = Smax/2;
    S[t] = S[t−1] + charge[t−1] − discharge[t−1].
    """
    base = chunks.with_chunk(plan, ts, chunk)
    base = chunks.neighbor_rows(base, site, ts, ["storage", "charge", "discharge"], prev="_prev", nxt="_next")
    c = F.col
    expected_s = F.when(c("_prev").isNull(), F.lit(storage_max / 2.0)) \
        .otherwise(c("_prev.storage") + c("_prev.charge") - c("_prev.discharge"))
    rules = {
        "chp_coupling": F.abs(c("chp_heat") - F.lit(alpha) * c("chp_power")),
        "heat_balance": F.abs(c("chp_heat") + c("boiler_heat") + c("discharge") - c("heat_demand") - c("charge")),
        "storage_balance": F.abs(c("storage") - expected_s),
        "storage_bounds": _range(c("storage"), F.lit(0.0), F.lit(storage_max)),
    }
    wide = base.select(site, ts, F.array(*[F.struct(F.lit(k).alias("rule"), v.cast("double").alias("residual"))
                                           for k, v in rules.items()]).alias("__r"))
    return _judged(wide.select(site, ts, F.inline("__r")), tol)
