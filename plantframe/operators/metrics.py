"""Aggregations (A1–A10).  All are ``groupBy().agg()`` with partial
(map-side) aggregation, so a hot site or model only costs one partial row
per task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantframe.functions.plant import DEFAULT, Params


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------- A1
def daily_average(df: DataFrame, col: str, from_date: str | None = None, *, site: str = "site_id",
                  ts: str = "ts", out: str | None = None) -> DataFrame:
    """Mean of ``col`` per site and date, from ``from_date`` on (range filter on the raw stamp)."""
    if from_date is not None:
        df = df.filter(F.col(ts) >= F.lit(from_date).cast("date").cast("timestamp_ntz"))
    return df.groupBy(site, F.to_date(ts).alias("date")).agg(F.avg(col).alias(out or f"avg_{col}"))


# ---------------------------------------------------------------------- A2
def series_summary(df: DataFrame, col: str, *, by: Sequence[str] = ("site_id",), ts: str = "ts",
                   require_range: bool = False) -> DataFrame:
    """count, first/last stamp, min/max/mean value.

    ``require_range``: fail the job (``raise_error``) for a group without
    stamps — the bounds feed a weather request and must exist.
    """
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
        F.min(col).alias("v_min"), F.max(col).alias("v_max"), F.avg(col).alias("v_mean"))
    if require_range:
        bad = F.col("ts_min").isNull() | F.col("ts_max").isNull()
        out = out.withColumn("ts_min", F.when(bad, F.raise_error(F.lit("series has no valid timestamps")))
                             .otherwise(F.col("ts_min")))
    return out


# ---------------------------------------------------------------------- A3
def error_aggs(actual: str | Column, predicted: str | Column) -> list[Column]:
    a, p = _c(actual), _c(predicted)
    err = a - p
    ape = F.abs(F.try_divide(err, F.when(a != 0, a)))
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(ape) * F.lit(100.0)).alias("mape"),
        F.sum(F.when(a == 0, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("n_zero_actual"),
    ]


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, MAPE% (zero actuals are skipped in MAPE and counted)."""
    pairs = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return pairs.groupBy(*by).agg(*error_aggs(actual, predicted))


# ---------------------------------------------------------------------- A4
def model_leaderboard(df: DataFrame, actual: str, predictions: Sequence[str] | None = None, *,
                      model_col: str | None = None, predicted: str | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """A3 for many models, ranked by RMSE (1 = best).

    Either ``predictions`` (wide: one column per model, unpivoted) or
    ``model_col`` + ``predicted`` (long form).
    """
    if predictions is not None:
        keep = list(by) + [actual]
        long = df.select(*keep, *predictions).unpivot(keep, list(predictions), "model", "predicted")
        model_col, predicted = "model", "predicted"
    else:
        long = df
    scores = forecast_errors(long, actual, predicted, list(by) + [model_col])
    w = Window.partitionBy(*by).orderBy(F.col("rmse"), F.col(model_col))
    return scores.withColumn("rank", F.rank().over(w).cast("long"))


# ---------------------------------------------------------------------- A5
def kpi_aggs(p_col: str = "chp_power", price: str = "electricity_price", q_chp: str = "chp_heat",
             boiler: str = "boiler_heat", demand: str = "heat_demand", cost_per_kwh: float = 0.03) -> list[Column]:
    P, pr = F.col(p_col), F.col(price)
    produced = F.sum(F.col(q_chp)) + F.sum(F.col(boiler))
    revenue = F.sum(P * pr)
    cost = F.sum(P * F.lit(cost_per_kwh))
    fuel = F.sum(P) / F.lit(0.85) + F.sum(F.col(boiler)) / F.lit(0.9)
    return [
        revenue.alias("total_revenue"), cost.alias("total_cost"), (revenue - cost).alias("net_profit"),
        F.when(produced > 0, F.sum(F.col(demand)) / produced * F.lit(100.0)).otherwise(F.lit(0.0)).alias("efficiency"),
        fuel.alias("fuel_consumption"), (fuel * F.lit(0.2)).alias("co2_emissions"),
    ]


def plant_kpis(plan: DataFrame, by: Sequence[str] = ("site_id",), **kw) -> DataFrame:
    """revenue Σ(P·price), cost Σ(P·0.03), net, efficiency, fuel, CO₂."""
    return plan.groupBy(*by).agg(*kpi_aggs(**kw))


# ---------------------------------------------------------------------- A6
def component_kpis(plan: DataFrame, by: Sequence[str] = ("site_id",), **kw) -> DataFrame:
    """A5 plus component sums/means and the fixed-ratio deltas shown next to them."""
    def opt(name: str) -> Column:
        return F.col(name) if name in plan.columns else F.lit(0.0)
    base = plan.groupBy(*by).agg(
        *kpi_aggs(**kw),
        F.sum(opt("pv_generation")).alias("pv_generation"),
        F.avg(opt("battery_level")).alias("battery_avg"),
        F.sum(opt("heat_pump_usage")).alias("heat_pump_usage"),
        F.sum(opt("electric_heater_usage")).alias("electric_heater_usage"),
        F.sum(opt("storage_losses")).alias("storage_losses"))
    return base.withColumns({
        "revenue_delta": F.col("total_revenue") * F.lit(0.05),
        "cost_delta": -F.col("total_cost") * F.lit(0.03),
        "profit_delta": F.col("net_profit") * F.lit(0.08),
        "efficiency_delta": F.lit(2.5),
    })


# ---------------------------------------------------------------------- A7
def plan_summary(plan: DataFrame, p: Params = DEFAULT, by: Sequence[str] = ("site_id",),
                 price: str = "electricity_price") -> DataFrame:
    """revenue, cost (no maintenance), profit, heat supplied, PV used, grid import/export."""
    fuel = p("economics.fuel_price")
    rev = F.sum(F.col("chp_power") * F.col(price) + F.col("grid_export") * p("economics.electricity_price_sell"))
    cost = F.sum((F.col("chp_power") + F.col("chp_heat")) / (p("chp.eta_el") + p("chp.eta_th")) * fuel
                 + F.col("boiler_heat") / p("boiler.eta") * fuel + F.col("grid_import") * F.col(price))
    return plan.groupBy(*by).agg(
        rev.alias("total_revenue"), cost.alias("total_cost"), (rev - cost).alias("total_profit"),
        F.sum(F.col("chp_heat") + F.col("boiler_heat") + F.col("heat_pump_heat")
              + F.col("electric_heater_heat")).alias("total_heat_supplied"),
        F.sum("pv_generation").alias("total_pv_used"),
        F.sum("grid_import").alias("total_grid_import"),
        F.sum("grid_export").alias("total_grid_export"))


# ---------------------------------------------------------------------- A8
def plan_objective(plan: DataFrame, p: Params = DEFAULT, by: Sequence[str] = ("site_id",),
                   price: str = "electricity_price") -> DataFrame:
    """Objective = revenue − cost − maintenance of running units (A7 + maintenance), plus the
    simple plant model's profit formula over the same plan."""
    fuel = p("economics.fuel_price")
    step = (F.col("chp_power") * F.col(price) + F.col("grid_export") * p("economics.electricity_price_sell")
            - (F.col("chp_power") + F.col("chp_heat")) / (p("chp.eta_el") + p("chp.eta_th")) * fuel
            - F.col("boiler_heat") / p("boiler.eta") * fuel - F.col("grid_import") * F.col(price)
            - F.col("chp_on") * p("economics.maintenance_cost_chp")
            - F.col("boiler_on") * p("economics.maintenance_cost_boiler")
            - F.col("heat_pump_on") * p("economics.maintenance_cost_heat_pump"))
    maint = (F.col("chp_on") * p("economics.maintenance_cost_chp")
             + F.col("boiler_on") * p("economics.maintenance_cost_boiler")
             + F.col("heat_pump_on") * p("economics.maintenance_cost_heat_pump"))
    # the simple plant model's profit: price·P − fuel·(P + Q)/0.85 − fuel·boiler/0.9
    simple = (F.col(price) * F.col("chp_power") - fuel * (F.col("chp_power") + F.col("chp_heat")) / F.lit(0.85)
              - fuel * F.col("boiler_heat") / F.lit(0.9))
    return plan.groupBy(*by).agg(F.sum(step).alias("objective_value"), F.sum(maint).alias("maintenance_cost"),
                                 F.sum(simple).alias("simple_profit"))


# ---------------------------------------------------------------------- A9
def available_sources(df: DataFrame, by: Sequence[str], source: str = "source") -> DataFrame:
    """Sorted distinct list of sources with data, per group (also as a text label)."""
    return df.groupBy(*by).agg(F.array_sort(F.collect_set(source)).alias("sources")) \
        .withColumn("sources_label", F.array_join("sources", ","))


# --------------------------------------------------------------------- A10
def holiday_year_union(*yearly: DataFrame, date_col: str = "date") -> DataFrame:
    """Distinct union of yearly holiday sets."""
    out = yearly[0].select(date_col)
    for y in yearly[1:]:
        out = out.unionByName(y.select(date_col))
    return out.distinct()
