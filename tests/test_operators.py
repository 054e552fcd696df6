"""Hand-made inputs with known answers for audits, dispatch rules, tariffs and joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plantframe.functions import dispatch, tariff
from plantframe.operators import audit, joins, metrics, series

D = dt.datetime


def _plan(spark, rows):
    cols = ("site_id long, ts timestamp_ntz, heat_demand double, pv_generation double, temperature double, "
            "chp_power double, chp_heat double, boiler_heat double, heat_pump_heat double, heat_pump_power double, "
            "electric_heater_heat double, electric_heater_power double, battery_charge double, battery_discharge double, "
            "battery_level double, thermal_charge double, thermal_discharge double, thermal_level double, "
            "grid_import double, grid_export double, chp_on double, boiler_on double, heat_pump_on double")
    return spark.createDataFrame(rows, cols)


def _step(h, **kw):
    base = dict(heat_demand=100.0, pv_generation=0.0, temperature=50.0, chp_power=0.0, chp_heat=0.0, boiler_heat=100.0,
                heat_pump_heat=0.0, heat_pump_power=0.0, electric_heater_heat=0.0, electric_heater_power=0.0,
                battery_charge=0.0, battery_discharge=0.0, battery_level=50.0, thermal_charge=0.0,
                thermal_discharge=0.0, thermal_level=1000.0, grid_import=0.0, grid_export=0.0, chp_on=0.0,
                boiler_on=1.0, heat_pump_on=0.0)
    base.update(kw)
    return (1, D(2024, 1, 1, h), *base.values())


def test_feasible_plan_has_no_violations(spark):
    rows = [_step(0), _step(1, battery_level=50.0 * 0.999)]
    res = audit.plan_audit(_plan(spark, rows))
    bad = res.filter(~F.col("ok")).collect()
    assert bad == []
    assert res.count() == 2 * 25


def test_audit_flags_each_broken_rule(spark):
    rows = [
        _step(0, chp_power=100.0, chp_heat=100.0, chp_on=1.0),      # coupling broken (needs 142.857)
        _step(1, boiler_heat=500.0, heat_demand=500.0),              # boiler above 400
        _step(2, thermal_level=900.0),                                # store moved without charge/discharge
        _step(3, grid_import=5.0),                                    # electricity not balanced
    ]
    res = {(r.ts.hour, r.rule): r.residual for r in audit.plan_audit(_plan(spark, rows)).collect()}
    assert res[(0, "chp_coupling")] == pytest.approx(100.0 * 0.5 / 0.35 - 100.0)
    assert res[(1, "bound_boiler_heat")] == pytest.approx(100.0)
    assert res[(2, "thermal_balance")] == pytest.approx(100.0)
    assert res[(3, "electricity_balance")] == pytest.approx(5.0)
    assert res[(0, "electricity_balance")] == pytest.approx(100.0)    # CHP power with no grid export


def test_no_double_off_rule(spark):
    on = [1.0, 0.0, 0.0, 1.0]        # on, off, off: forbidden at the middle step t=1
    rows = [_step(h, chp_on=v) for h, v in enumerate(on)]
    res = {r.ts.hour: r.residual for r in audit.plan_audit(_plan(spark, rows)).filter(F.col("rule") == "no_double_off").collect()}
    assert res == {0: 0.0, 1: 1.0, 2: 0.0, 3: 0.0}


def test_simple_plan_audit(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1, h), 100.0, 60.0, 90.0, 10.0, c, d, s)
                                for h, (c, d, s) in enumerate([(0.0, 0.0, 1000.0), (5.0, 0.0, 1000.0), (0.0, 0.0, 1005.0)])],
                               "site_id long, ts timestamp_ntz, heat_demand double, chp_power double, chp_heat double, "
                               "boiler_heat double, charge double, discharge double, storage double")
    res = {(r.ts.hour, r.rule): r.residual for r in audit.simple_plan_audit(df).collect()}
    assert res[(0, "storage_balance")] == 0.0 and res[(2, "storage_balance")] == 0.0
    assert res[(1, "heat_balance")] == pytest.approx(5.0)
    assert res[(0, "chp_coupling")] == pytest.approx(0.0)


def test_rule_and_heuristic_dispatch(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1, 0), 350.0, 0.2)], "site_id long, ts timestamp_ntz, heat_demand double, electricity_price double")
    r = dispatch.rule_dispatch(df).collect()[0]
    assert (r.chp_power, r.chp_heat, r.boiler_heat) == (200.0, 100.0, 250.0)
    assert r.step_profit == pytest.approx(0.2 * 200 - 0.03 * 300 / 0.85 - 0.03 * 250 / 0.9)
    h = dispatch.heuristic_dispatch(df).collect()[0]
    assert h.u_chp == pytest.approx(0.4) and h.u_boiler == pytest.approx(0.1)
    assert (h.chp_power, h.chp_heat, h.boiler_heat) == pytest.approx((80.0, 120.0, 40.0))


def test_heat_source_ranking(spark):
    df = spark.createDataFrame([("r", 0.30)], "region string, allin_eur double")
    ranked = tariff.rank_heat_sources(tariff.heat_unit_cost(df).drop("allin_eur"), ["region"])
    order = [r.source for r in ranked.orderBy("rank").collect()]
    assert order == ["boiler", "heat_pump", "chp", "heating_rod"]      # 0.0667, 0.0857, 0.12, 0.303


def test_positional_zip_truncates_to_shorter(spark):
    a = spark.createDataFrame([(1, D(2024, 1, 1, h), float(h)) for h in range(5)], "site_id long, ts timestamp_ntz, x double")
    b = spark.createDataFrame([(1, D(2024, 2, 1, h), float(10 * h)) for h in range(3)], "site_id long, ts timestamp_ntz, y double")
    rows = joins.positional_zip(a, b).orderBy("pos").collect()
    assert [(r.pos, r.x, r.y) for r in rows] == [(0, 0.0, 0.0), (1, 1.0, 10.0), (2, 2.0, 20.0)]


def test_forecast_errors_skip_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "a double, p double")
    r = metrics.forecast_errors(df, "a", "p").collect()[0]
    assert r.n == 3 and r.n_zero_actual == 1
    assert r.mae == pytest.approx(1.0)
    assert r.mape == pytest.approx((0.5 + 0.25) / 2 * 100)


def test_time_grid_periods_and_slice(spark):
    starts = spark.createDataFrame([(1, D(2024, 1, 1, 0))], "site_id long, start timestamp_ntz")
    g = series.time_grid_periods(starts, 72, "1 hour")
    tomorrow = series.slice_rows(g, 24, 24).orderBy("ts").collect()
    assert len(tomorrow) == 24 and tomorrow[0].ts == D(2024, 1, 2, 0) and tomorrow[-1].ts == D(2024, 1, 2, 23)


def test_series_summary_requires_range(spark):
    df = spark.createDataFrame([(1, None, 1.0)], "site_id long, ts timestamp_ntz, v double")
    assert metrics.series_summary(df, "v").collect()[0].ts_min is None
    with pytest.raises(Exception):
        metrics.series_summary(df, "v", require_range=True).collect()


def test_short_history_gets_default_forecast(spark):
    from plantframe.plans import forecast as fc
    hist = spark.createDataFrame([(1, D(2024, 1, 1, h)) for h in range(10)] + [(2, D(2024, 1, 1, 0))],
                                 "site_id long, ts timestamp_ntz")
    fcst = spark.createDataFrame([(1, 1, 5.0), (2, 1, None)], "site_id long, h int, prediction double")
    got = {r.site_id: r.prediction for r in fc.fallback_short_history(fcst, hist, 6).collect()}
    assert got == {1: 5.0, 2: 250.0}
