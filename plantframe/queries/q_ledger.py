"""R1, R2 (bounded running balances), R5, R6 (audits) and the aggregates A6–A8 over a stored plan table.

The DuckDB oracle of the ledgers walks each site sequentially with a recursive
CTE, an independent formulation of what Spark computes as a chunked prefix
scan of clamp maps.  R3 and R4 of the survey step a plant model and are left
out (README).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import dispatch
from plantframe.operators import audit, ledger, metrics
from plantframe.queries.common import R4, register, round_doubles

PI = cat.SQL_PLAN_INPUTS
W = cat.with_recursive_sql

# -------------------------------------------------------------- SQL ledgers
def _battery_step(L: str, c: str, d: str) -> tuple[str, str, str]:
    """(actual charge, actual discharge, next level) as SQL, sequential form."""
    a_c = f"(CASE WHEN {c} > 0 THEN least({c}, 50.0::DOUBLE, (95.0::DOUBLE - {L}) / 0.92::DOUBLE) ELSE 0.0::DOUBLE END)"
    L1 = f"({L} + {a_c} * 0.92::DOUBLE)"
    a_d = f"(CASE WHEN {d} > 0 THEN least({d}, 50.0::DOUBLE, ({L1} - 10.0::DOUBLE) * 0.92::DOUBLE) ELSE 0.0::DOUBLE END)"
    L3 = f"(({L1} - {a_d} / 0.92::DOUBLE) * (1.0::DOUBLE - 0.001::DOUBLE))"
    return a_c, a_d, L3


def _thermal_step(S: str, b: str) -> tuple[str, str, str]:
    q_c = f"(CASE WHEN {b} > 0 THEN least({b}, (1900.0::DOUBLE - {S}) / 0.95::DOUBLE) ELSE 0.0::DOUBLE END)"
    q_d = f"(CASE WHEN {b} <= 0 THEN least(-({b}), ({S} - 100.0::DOUBLE) * 0.95::DOUBLE) ELSE 0.0::DOUBLE END)"
    S1 = f"({S} + {q_c} * 0.95::DOUBLE - {q_d} / 0.95::DOUBLE)"
    return q_c, q_d, S1


_B_STEP = _battery_step("led.bl", "s.battery_charge", "s.battery_discharge")
_T_STEP = _thermal_step("led.tl", "s.heat_balance")
_B_ROW = _battery_step("bl_in", "battery_charge", "battery_discharge")
_T_ROW = _thermal_step("tl_in", "heat_balance")

SQL_LEDGERS = cat.SQL_PLAN_AMOUNTS + (
    ", st AS (SELECT site_id, ts, battery_charge, battery_discharge, chp_power * (0.50::DOUBLE / 0.35::DOUBLE) + boiler_heat + heat_pump_heat "
    "+ electric_heater_heat - heat_demand AS heat_balance, row_number() OVER (PARTITION BY site_id ORDER BY ts) AS rn FROM plan_amounts), "
    "led AS (SELECT site_id, 0 AS rn, 50.0::DOUBLE AS bl, 1000.0::DOUBLE AS tl FROM st WHERE rn = 1 "
    f"UNION ALL SELECT s.site_id, s.rn, {_B_STEP[2]}, {_T_STEP[2]} FROM led JOIN st s "
    "ON s.site_id = led.site_id AND s.rn = led.rn + 1), "
    "rows_ AS (SELECT s.*, p.bl AS bl_in, p.tl AS tl_in, o.bl AS battery_level, o.tl AS thermal_storage_level "
    "FROM st s JOIN led p ON p.site_id = s.site_id AND p.rn = s.rn - 1 JOIN led o ON o.site_id = s.site_id AND o.rn = s.rn), "
    f"ledgers AS (SELECT *, {_B_ROW[0]} AS battery_charge_a, {_B_ROW[1]} AS battery_discharge_a, "
    f"{_T_ROW[0]} AS thermal_storage_charge, {_T_ROW[1]} AS thermal_storage_discharge FROM rows_)")


# ---------------------------------------------------------------------- R1
@register("battery_ledger", W(SQL_LEDGERS) + f"SELECT site_id, ts, {R4('battery_charge_a')} AS battery_charge_actual, "
          f"{R4('battery_discharge_a')} AS battery_discharge_actual, {R4('battery_level')} AS battery_level FROM ledgers")
def q_battery(spark, d):
    pi = cat.plan_amounts(spark, d).select("site_id", "ts", "battery_charge", "battery_discharge")
    out = ledger.battery_ledger(pi)
    return round_doubles(out.select("site_id", "ts", "battery_charge_actual", "battery_discharge_actual", "battery_level"))


# ---------------------------------------------------------------------- R2
@register("thermal_ledger", W(SQL_LEDGERS) + f"SELECT site_id, ts, {R4('thermal_storage_charge')} AS thermal_storage_charge, "
          f"{R4('thermal_storage_discharge')} AS thermal_storage_discharge, {R4('thermal_storage_level')} AS thermal_storage_level FROM ledgers")
def q_thermal(spark, d):
    pi = cat.plan_amounts(spark, d)
    sup = F.col("chp_power") * (0.50 / 0.35) + F.col("boiler_heat") + F.col("heat_pump_heat") + F.col("electric_heater_heat")
    df = pi.select("site_id", "ts", "heat_demand", sup.alias("heat_supply"))
    out = ledger.thermal_ledger(df)
    return round_doubles(out.select("site_id", "ts", "thermal_storage_charge", "thermal_storage_discharge",
                                    "thermal_storage_level"))


# ---------------------------------------------------------------------- R5
def _sql_audit_rules() -> dict[str, str]:
    cop = cat.SQL_COP
    # DuckDB's greatest skips NULLs as Spark's does, so the unknown is spelled out
    up = lambda x, hi: f"CASE WHEN {x} IS NULL THEN NULL ELSE greatest(0.0::DOUBLE, {x} - {hi}, -({x})) END"
    rng = lambda x, lo, hi: f"CASE WHEN {x} IS NULL THEN NULL ELSE greatest(0.0::DOUBLE, {x} - {hi}, {lo} - {x}) END"
    return {
        "bound_chp_power": up("chp_power", "200.0::DOUBLE"),
        "bound_chp_heat": up("chp_heat", "300.0::DOUBLE"),
        "bound_boiler_heat": up("boiler_heat", "400.0::DOUBLE"),
        "bound_heat_pump_heat": up("heat_pump_heat", "250.0::DOUBLE"),
        "bound_heat_pump_power": up("heat_pump_power", "60.0::DOUBLE"),
        "bound_heater_heat": up("electric_heater_heat", "200.0::DOUBLE"),
        "bound_heater_power": up("electric_heater_power", "200.0::DOUBLE"),
        "bound_battery_charge": up("battery_charge", "50.0::DOUBLE"),
        "bound_battery_discharge": up("battery_discharge", "50.0::DOUBLE"),
        "bound_battery_level": rng("battery_level", "10.0::DOUBLE", "95.0::DOUBLE"),
        "bound_thermal_level": rng("thermal_level", "100.0::DOUBLE", "1900.0::DOUBLE"),
        "bound_nonneg": "greatest(0.0::DOUBLE, -thermal_charge, -thermal_discharge, -grid_import, -grid_export)",
        "chp_coupling": "abs(chp_heat - chp_power * (0.50::DOUBLE / 0.35::DOUBLE))",
        "chp_on_power": "greatest(0.0::DOUBLE, chp_power - chp_on * 200.0::DOUBLE)",
        "chp_on_heat": "greatest(0.0::DOUBLE, chp_heat - chp_on * 300.0::DOUBLE)",
        "cop_link": f"abs(heat_pump_power - heat_pump_heat / {cop})",
        "heat_pump_on_heat": "greatest(0.0::DOUBLE, heat_pump_heat - heat_pump_on * 250.0::DOUBLE)",
        "heat_pump_on_power": "greatest(0.0::DOUBLE, heat_pump_power - heat_pump_on * 60.0::DOUBLE)",
        "heater_link": "abs(electric_heater_power - electric_heater_heat / 0.99::DOUBLE)",
        "heat_balance": "abs(chp_heat + boiler_heat + heat_pump_heat + electric_heater_heat + thermal_discharge "
                        "- thermal_charge - heat_demand)",
        "battery_balance": "abs(battery_level - (CASE WHEN rn = 1 THEN 50.0::DOUBLE ELSE prev_bl * (1.0::DOUBLE - 0.001::DOUBLE) END "
                           "+ battery_charge * 0.92::DOUBLE - battery_discharge / 0.92::DOUBLE))",
        "thermal_balance": "abs(thermal_level - (CASE WHEN rn = 1 THEN 1000.0::DOUBLE ELSE prev_tl END + thermal_charge * 0.95::DOUBLE "
                           "- thermal_discharge / 0.95::DOUBLE))",
        "electricity_balance": "abs(chp_power + heat_pump_power + electric_heater_power + battery_charge + grid_import "
                               "- (pv_generation + battery_discharge + grid_export))",
        "grid_limit": "greatest(0.0::DOUBLE, grid_import - 1000.0::DOUBLE, grid_export - 1000.0::DOUBLE)",
        "no_double_off": "CASE WHEN prev_on IS NOT NULL AND next_on IS NOT NULL THEN greatest(0.0::DOUBLE, prev_on - next_on - chp_on) "
                         "ELSE 0.0::DOUBLE END",
    }


_JUDGED = f"SELECT site_id, ts, rule, {R4('residual')} AS residual, coalesce(residual <= 0.000001, false) AS ok, residual IS NULL AS \"unknown\" FROM res"
_AUDIT_SQL = W(cat.SQL_PLAN_TABLE,
               "a1 AS (SELECT *, row_number() OVER w AS rn, lag(battery_level) OVER w AS prev_bl, lag(thermal_level) OVER w AS prev_tl, "
               "lag(chp_on) OVER w AS prev_on, lead(chp_on) OVER w AS next_on FROM plan_table "
               "WINDOW w AS (PARTITION BY site_id ORDER BY ts))",
               "res AS (" + " UNION ALL ".join(f"SELECT site_id, ts, '{k}' AS rule, {v} AS residual FROM a1"
                                               for k, v in _sql_audit_rules().items()) + ") ") + _JUDGED


@register("plan_audit", _AUDIT_SQL)
def q_audit(spark, d):
    return round_doubles(audit.plan_audit(cat.plan_table(spark, d)))


# ---------------------------------------------------------------------- R6
_R6_SQL = W(PI, "ru AS (SELECT site_id, ts, heat_demand, heat_demand - 100.0::DOUBLE AS load, least(200.0::DOUBLE, greatest(0.0::DOUBLE, 0.7::DOUBLE * heat_demand)) "
            "AS chp_power FROM plan_inputs)",
            "ru2 AS (SELECT *, least(300.0::DOUBLE, 0.5::DOUBLE * chp_power) AS chp_heat FROM ru)",
            "ru3 AS (SELECT *, greatest(0.0::DOUBLE, heat_demand - chp_heat) AS boiler_heat, "
            "CASE WHEN site_id % 7 = 0 AND hour(ts) = 5 THEN NULL ELSE 1000.0::DOUBLE + load * 12.0::DOUBLE END AS storage, "
            "CASE WHEN hour(ts) BETWEEN 10 AND 16 THEN load * 0.3::DOUBLE ELSE 0.0::DOUBLE END AS charge, "
            "CASE WHEN hour(ts) BETWEEN 18 AND 22 THEN load * 0.2::DOUBLE ELSE 0.0::DOUBLE END AS discharge FROM ru2)",
            "ru4 AS (SELECT *, row_number() OVER w AS rn, lag(storage + charge - discharge) OVER w AS exp_s FROM ru3 WINDOW w AS (PARTITION BY site_id ORDER BY ts))",
            "res AS (SELECT site_id, ts, 'chp_coupling' AS rule, abs(chp_heat - 1.5::DOUBLE * chp_power) AS residual FROM ru4 "
            "UNION ALL SELECT site_id, ts, 'heat_balance', abs(chp_heat + boiler_heat + discharge - heat_demand - charge) FROM ru4 "
            "UNION ALL SELECT site_id, ts, 'storage_balance', abs(storage - CASE WHEN rn = 1 THEN 1000.0::DOUBLE ELSE exp_s END) FROM ru4 "
            "UNION ALL SELECT site_id, ts, 'storage_bounds', CASE WHEN storage IS NULL THEN NULL ELSE greatest(0.0::DOUBLE, storage - 2000.0::DOUBLE, 0.0::DOUBLE - storage) END FROM ru4) ") + _JUDGED


@register("simple_plan_audit", _R6_SQL)
def q_simple_audit(spark, d):
    plan = dispatch.rule_dispatch(cat.plan_inputs(spark, d).select("site_id", "ts", "heat_demand", "electricity_price"))
    load, hour = F.col("heat_demand") - F.lit(100.0), F.hour("ts")
    plan = plan.withColumns({
        "storage": F.when((F.pmod("site_id", F.lit(7)) == 0) & (hour == 5), F.lit(None)).otherwise(F.lit(1000.0) + load * F.lit(12.0)),
        "charge": F.when(hour.between(10, 16), load * F.lit(0.3)).otherwise(F.lit(0.0)),
        "discharge": F.when(hour.between(18, 22), load * F.lit(0.2)).otherwise(F.lit(0.0))})
    return round_doubles(audit.simple_plan_audit(plan))


# ------------------------------------------------------------------- A6–A8
@register("component_kpis", W(cat.SQL_PLAN_TABLE) + "SELECT site_id, "
          f"{R4('sum(chp_power * electricity_price)')} AS total_revenue, {R4('sum(chp_power * 0.03::DOUBLE)')} AS total_cost, "
          f"{R4('sum(chp_power * electricity_price) - sum(chp_power * 0.03::DOUBLE)')} AS net_profit, "
          f"{R4('CASE WHEN sum(chp_heat) + sum(boiler_heat) > 0 THEN sum(heat_demand) / (sum(chp_heat) + sum(boiler_heat)) * 100.0::DOUBLE ELSE 0.0::DOUBLE END')} AS efficiency, "
          f"{R4('sum(chp_power) / 0.85::DOUBLE + sum(boiler_heat) / 0.9::DOUBLE')} AS fuel_consumption, "
          f"{R4('(sum(chp_power) / 0.85::DOUBLE + sum(boiler_heat) / 0.9::DOUBLE) * 0.2::DOUBLE')} AS co2_emissions, "
          f"{R4('sum(pv_generation)')} AS pv_generation, {R4('avg(battery_level)')} AS battery_avg, "
          f"{R4('sum(heat_pump_heat)')} AS heat_pump_usage, {R4('sum(electric_heater_heat)')} AS electric_heater_usage, "
          f"{R4('sum(storage_losses)')} AS storage_losses, "
          f"{R4('sum(chp_power * electricity_price) * 0.05::DOUBLE')} AS revenue_delta, "
          f"{R4('-(sum(chp_power * 0.03::DOUBLE)) * 0.03::DOUBLE')} AS cost_delta, "
          f"{R4('(sum(chp_power * electricity_price) - sum(chp_power * 0.03::DOUBLE)) * 0.08::DOUBLE')} AS profit_delta, "
          "2.5::DOUBLE AS efficiency_delta FROM plan_table GROUP BY site_id")
def q_component_kpis(spark, d):
    r = cat.plan_table(spark, d).withColumnsRenamed({"heat_pump_heat": "heat_pump_usage",
                                              "electric_heater_heat": "electric_heater_usage"})
    return round_doubles(metrics.component_kpis(r))


@register("plan_summary", W(cat.SQL_PLAN_TABLE) + "SELECT site_id, "
          f"{R4('sum(chp_power * electricity_price + grid_export * 0.08::DOUBLE)')} AS total_revenue, "
          f"{R4('sum((chp_power + chp_heat) / (0.35::DOUBLE + 0.50::DOUBLE) * 0.03::DOUBLE + boiler_heat / 0.90::DOUBLE * 0.03::DOUBLE + grid_import * electricity_price)')} AS total_cost, "
          f"{R4('sum(chp_power * electricity_price + grid_export * 0.08::DOUBLE) - sum((chp_power + chp_heat) / (0.35::DOUBLE + 0.50::DOUBLE) * 0.03::DOUBLE + boiler_heat / 0.90::DOUBLE * 0.03::DOUBLE + grid_import * electricity_price)')} AS total_profit, "
          f"{R4('sum(chp_heat + boiler_heat + heat_pump_heat + electric_heater_heat)')} AS total_heat_supplied, "
          f"{R4('sum(pv_generation)')} AS total_pv_used, {R4('sum(grid_import)')} AS total_grid_import, "
          f"{R4('sum(grid_export)')} AS total_grid_export FROM plan_table GROUP BY site_id")
def q_plan_summary(spark, d):
    return round_doubles(metrics.plan_summary(cat.plan_table(spark, d)))


@register("plan_objective", W(cat.SQL_PLAN_TABLE)
          + "SELECT site_id, " + R4(
              "sum(chp_power * electricity_price + grid_export * 0.08::DOUBLE - (chp_power + chp_heat) / (0.35::DOUBLE + 0.50::DOUBLE) * 0.03::DOUBLE "
              "- boiler_heat / 0.90::DOUBLE * 0.03::DOUBLE - grid_import * electricity_price - chp_on * 0.005::DOUBLE "
              "- boiler_on * 0.002::DOUBLE - heat_pump_on * 0.003::DOUBLE)") + " AS objective_value, "
          + R4("sum(chp_on * 0.005::DOUBLE + boiler_on * 0.002::DOUBLE + heat_pump_on * 0.003::DOUBLE)")
          + " AS maintenance_cost, "
          + R4("sum(electricity_price * chp_power - 0.03::DOUBLE * (chp_power + chp_heat) / 0.85::DOUBLE "
               "- 0.03::DOUBLE * boiler_heat / 0.9::DOUBLE)")
          + " AS simple_profit FROM plan_table GROUP BY site_id")
def q_plan_objective(spark, d):
    return round_doubles(metrics.plan_objective(cat.plan_table(spark, d)))
