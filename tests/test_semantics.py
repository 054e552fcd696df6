"""Small semantic vectors (FIXTURES §4) and the golden plan and levels (FIXTURES §3)."""

import copy
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plantframe.functions import calendar, plant
from plantframe.functions.plant import Params
from plantframe.operators import ledger, samples, series
from plantframe.sources.params import DEFAULT_PARAMETERS

D = dt.datetime


def test_interpolate_vector(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1, h), v) for h, v in enumerate([None, 1.0, None, 3.0, None])],
                               "site_id long, ts timestamp_ntz, v double")
    got = [r.v for r in series.interpolate_linear(df, "v").orderBy("ts").collect()]
    assert got == [None, 1.0, 2.0, 3.0, 3.0]


def test_interpolate_is_positional_not_temporal(spark):
    # uneven spacing: pandas 'linear' ignores the index, so the midpoint row gets the mean
    df = spark.createDataFrame([(1, D(2024, 1, 1, 0), 0.0), (1, D(2024, 1, 1, 1), None), (1, D(2024, 1, 1, 10), 10.0)],
                               "site_id long, ts timestamp_ntz, v double")
    got = [r.v for r in series.interpolate_linear(df, "v").orderBy("ts").collect()]
    assert got == [0.0, 5.0, 10.0]


def test_align_nearest_vector(spark):
    s = spark.createDataFrame([(1, D(2024, 1, 1, 0), 0.0), (1, D(2024, 1, 1, 1), 4.0), (1, D(2024, 1, 1, 3), 12.0)],
                              "site_id long, ts timestamp_ntz, v double")
    t = spark.createDataFrame([(1, D(2024, 1, 1, 0, 30)), (1, D(2024, 1, 1, 2)), (1, D(2023, 12, 31)), (1, D(2024, 1, 2))],
                              "site_id long, ts timestamp_ntz")
    got = {r.ts: r.v for r in series.align_nearest(t, s, "v").collect()}
    assert [got[D(2024, 1, 1, 0, 30)], got[D(2024, 1, 1, 2)], got[D(2023, 12, 31)], got[D(2024, 1, 2)]] == [4, 12, 0, 12]


def test_upsample_vector(spark):
    s = spark.createDataFrame([(1, D(2024, 1, 1, 0), 0.0), (1, D(2024, 1, 1, 1), 4.0), (1, D(2024, 1, 1, 3), 12.0)],
                              "site_id long, ts timestamp_ntz, v double")
    got = [r.v for r in series.upsample_linear(s, "30 minutes", "v").orderBy("ts").collect()]
    assert got == [0, 2, 4, 6, 8, 10, 12]


def test_temp_category(spark):
    df = spark.createDataFrame([(x,) for x in [-1.0, 0.0, 9.99, 10.0, 20.0, None]], "t double")
    got = [r.c for r in df.select(calendar.temp_category_code("t").alias("c")).collect()]
    assert got == [0, 1, 1, 2, 3, None]
    names = [r.n for r in df.select(calendar.temp_category_name("t").alias("n")).collect()]
    assert names == ["Very Cold", "Cold", "Cold", "Normal", "Hot", None]


def test_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(D(2024, 12, 30),), (D(2021, 1, 1),)], "ts timestamp_ntz")
    rows = df.select(calendar.iso_week("ts").alias("w"), F.weekday("ts").alias("d")).collect()
    assert [r.w for r in rows] == [1, 53]
    assert rows[0].d == 0  # Monday = 0


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0)], "site_id long, x double")
    assert [r.x for r in samples.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0]


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0)], "site_id long, x double")
    stats = samples.standard_fit(df, ["x"]).collect()[0]
    assert stats["x__std"] == pytest.approx(1.0)


def test_battery_step_vector(spark):
    vals = copy.deepcopy(DEFAULT_PARAMETERS["system_parameters"])
    vals["battery_storage"]["max_charge_rate"] = 1e9
    p = Params(vals)
    df = spark.createDataFrame([(1, D(2024, 1, 1, 0), 30.0, 0.0), (1, D(2024, 1, 1, 1), 80.0, 0.0)],
                               "site_id long, ts timestamp_ntz, battery_charge double, battery_discharge double")
    got = [r.battery_level for r in ledger.battery_ledger(df, p).orderBy("ts").collect()]
    assert got == pytest.approx([77.5224, 94.905], abs=1e-9)


def _golden_inputs(spark):
    t0 = D(2025, 7, 8, 14, 16, 3, 134891)
    rows = []
    for k in range(24):
        ts = t0 + dt.timedelta(hours=k)
        h = ts.hour
        rows.append((1, ts, 200 + 50 * math.sin(2 * math.pi * h / 24), 0.25 + 0.1 * math.sin(2 * math.pi * h / 24),
                     15 + 10 * math.sin(2 * math.pi * h / 24), max(0.0, 800 * math.sin(2 * math.pi * (h - 6) / 24)), 50.0))
    return spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, heat_demand double, electricity_price double, "
                                       "temperature double, solar_irradiance double, humidity double")


def _golden_plan(spark):
    from plantframe.operators import joins
    from plantframe.plans import plan
    df = _golden_inputs(spark)
    return plan.plan_columns(joins.join_plan_inputs(
        df.select("site_id", "ts", "heat_demand"), df.select("site_id", "ts", "electricity_price"),
        df.select("site_id", "ts", "temperature", "solar_irradiance", "humidity"), None))


def test_golden_plan_columns(spark):
    sums = _golden_plan(spark).agg(*[F.sum(c).alias(c) for c in ["chp_power", "chp_heat", "boiler_heat", "heat_pump_heat", "heat_pump_power",
                                                               "pv_generation", "grid_export"]], F.count(F.lit(1)).alias("n")).collect()[0]
    expected = {"chp_power": 1850.0, "chp_heat": 2642.857143, "boiler_heat": 350.0, "heat_pump_heat": 1700.0,
                "heat_pump_power": 680.0, "pv_generation": 152.503181, "grid_export": 0.0, "n": 24}
    for k, v in expected.items():
        assert sums[k] == pytest.approx(v, abs=1e-6), k


@pytest.mark.parametrize("levels", [("day", "month"), ("hour", "day", "month"), ("minute", "hour", "day", "month")])
def test_golden_levels(spark, levels):
    steps = _golden_plan(spark)
    b = ledger.battery_ledger(steps, levels=levels).agg(F.avg("battery_level").alias("mean"), F.max_by("battery_level", "ts").alias("last")).collect()[0]
    t = ledger.thermal_ledger(steps, levels=levels).agg(F.avg("thermal_storage_level").alias("mean"), F.max_by("thermal_storage_level", "ts").alias("last")).collect()[0]
    assert (b["mean"], b["last"]) == (pytest.approx(35.441872, abs=1e-6), pytest.approx(83.257378, abs=1e-6))
    assert (t["mean"], t["last"]) == (pytest.approx(1097.555373, abs=1e-6), pytest.approx(809.806663, abs=1e-6))


def test_null_amounts_move_nothing(spark):
    rows = [(1, D(2024, 1, 1, h), s, d) for h, (s, d) in enumerate([(200.0, 100.0), (50.0, None), (200.0, 100.0)])]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, heat_supply double, heat_demand double")
    got = [r.thermal_storage_level for r in ledger.thermal_ledger(df).orderBy("ts").collect()]
    assert got == pytest.approx([1095.0, 1095.0, 1190.0])
    df = spark.createDataFrame([(1, D(2024, 1, 1, h), c, 0.0) for h, c in enumerate([10.0, None, 10.0])],
                               "site_id long, ts timestamp_ntz, battery_charge double, battery_discharge double")
    got = [r.battery_level for r in ledger.battery_ledger(df).orderBy("ts").collect()]
    assert got == pytest.approx([59.2 * 0.999, 59.2 * 0.999 ** 2, (59.2 * 0.999 ** 2 + 9.2) * 0.999])


def test_ledger_ties_have_one_order(spark):
    rows = [(1, D(2024, 1, 1, h // 2), float(c), 0.0) for h, c in enumerate([40, 5, 30, 20, 50, 10])]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, battery_charge double, battery_discharge double")
    one = sorted(r.battery_level for r in ledger.battery_ledger(df).collect())
    two = sorted(r.battery_level for r in ledger.battery_ledger(df.orderBy(F.desc("battery_charge")).repartition(3)).collect())
    assert one == two


def test_unknown_plan_steps_are_not_ok(spark):
    from plantframe.operators import audit
    plan = _golden_plan(spark).withColumns({c: F.lit(1.0) for c in ("thermal_charge", "thermal_discharge", "chp_on", "boiler_on", "heat_pump_on", "thermal_level")})
    plan = plan.withColumn("battery_level", F.lit(None).cast("double")).withColumn("grid_import", F.lit(None).cast("double"))
    got = {r.rule: r for r in audit.audit_totals(audit.plan_audit(plan)).collect()}
    for rule in ("bound_battery_level", "battery_balance", "bound_nonneg", "grid_limit", "electricity_balance"):
        assert got[rule].n_unknown == got[rule].n == 24 and got[rule].n_violations == 0
    assert got["bound_chp_power"].n_unknown == 0


@pytest.mark.parametrize("nulls,anchors", [("keep", [2, 3, 4, 5, 6, 7]), ("drop", [2, 3, 6, 7])])
def test_windows_keep_null_targets(spark, nulls, anchors):
    rows = [(1, D(2024, 1, 1, h), None if h == 3 else float(h)) for h in range(8)]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double")
    got = {r.anchor_pos: r.x for r in samples.lag_windows_next(df, "v", 2, nulls=nulls).collect()}
    assert sorted(got) == anchors and got[2] == [0.0, 1.0]
    if nulls == "keep":
        assert got[4] == [2.0, None] and got[5] == [None, 4.0]


def test_one_row_parameters_are_checked(spark):
    from plantframe.sources import params
    df = spark.range(3).withColumnRenamed("id", "x")
    assert params.params_cross(df, spark.createDataFrame([(1.0,)], "p double")).collect()[0]["p"] == 1.0
    with pytest.raises(Exception, match="exactly one row"):
        params.params_cross(df, spark.createDataFrame([(1.0,), (2.0,)], "p double")).collect()


def test_hot_site_grid_is_spread(spark):
    """With Spark's own settings (partitions are merged where small): grid and interpolation run in many tasks."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.createDataFrame([(1, D(2024, 1, 1) + dt.timedelta(hours=h), float(h)) for h in range(24 * 20)], "site_id long, ts timestamp_ntz, v double")
        grid = series.time_grid(series.bounds(df), "1 minute")
        assert grid.select(F.spark_partition_id().alias("p")).distinct().count() >= 8
        out = series.upsample_linear(df, "1 second", "v").withColumn("p", F.spark_partition_id())
        assert out.select("p").distinct().count() >= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_cop_clamped(spark):
    df = spark.createDataFrame([(-30.0,), (40.0,), (60.0,), (80.0,)], "t double")
    got = [r.c for r in df.select(plant.heatpump_cop("t").alias("c")).collect()]
    assert got == pytest.approx([2.5, 4.2 * (1 - 0.02 * 10), 4.2 * (1 + 0.02 * 10), 5.5])


def test_upsample_shuffles_the_coarse_series_only(spark):
    """Points off the grid don't count, points of one stamp stay apart; no exchange lies above the generated stamps but the summary's."""
    rows = [(1, D(2024, 1, 1, 22), 0.0), (1, D(2024, 1, 1, 23, 10), 99.0), (1, D(2024, 1, 2, 0), 4.0), (1, D(2024, 1, 2, 0), 5.0), (1, D(2024, 1, 2, 1), None),
            (1, D(2024, 1, 2, 2), 8.0), (2, D(2024, 1, 1), 1.0), (None, D(2024, 1, 1), 1.0), (3, None, 1.0)]
    s = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double")
    out = series.upsample_linear(s, "1 hour", "v")
    assert out.columns == ["site_id", "ts", "v"]
    got = sorted((r.site_id, r.ts, r.v) for r in out.collect())
    assert [x[:2] for x in got] == [(1, D(2024, 1, 1, 22)), (1, D(2024, 1, 1, 23)), (1, D(2024, 1, 2, 0)), (1, D(2024, 1, 2, 0)), (1, D(2024, 1, 2, 1)), (1, D(2024, 1, 2, 2)), (2, D(2024, 1, 1))]
    assert [x[2] for x in got if x[1] in (D(2024, 1, 1, 22), D(2024, 1, 2, 0), D(2024, 1, 2, 2), D(2024, 1, 1))] == [0.0, 4.0, 5.0, 8.0, 1.0]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning(site_id" in x and "ts#" in x)
    above = plan[:plan.index("Generate")]
    assert sum("Exchange hashpartitioning" in x and "_chunk" in x for x in above.splitlines()) == 0


def test_upsample_scans_the_coarse_series_only(spark):
    """Stamps between points are made above all windows and sorts; values, gaps and edges are as on the whole grid."""
    nan = float("nan")
    rows = [(1, D(2024, 1, 1, 22), None, 1.0), (1, D(2024, 1, 1, 23), 2.0, nan), (1, D(2024, 1, 4, 1), 10.0, 5.0), (1, D(2024, 1, 4, 1, 20), 77.0, 77.0)]
    s = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double, w double")
    out = series.upsample_linear(s, "15 minutes", ["v", "w"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Window")
    got = {r.ts: (r.v, r.w) for r in out.collect()}
    assert sorted(got) == [D(2024, 1, 1, 22) + dt.timedelta(minutes=15 * k) for k in range(4 * 51 + 2)]
    for ts, (v, w) in got.items():
        hours = (ts - D(2024, 1, 1, 23)) / dt.timedelta(hours=1)
        assert v is None if hours < 0 else v == pytest.approx(min(2.0 + 8.0 * hours / 50, 10.0))
        assert w == pytest.approx(min(1.0 + 4.0 * (hours + 1) / 51, 5.0))


def test_upsample_makes_its_input_once(spark):
    """First and last stamps come from the days' points: rows that are dear to make (parsed answers) are made once, and days without points are filled."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = [(1, D(2024, 1, 1, 22), 0.0), (1, D(2024, 1, 4, 2), 52.0), (2, D(2024, 1, 1, 5), None), (2, D(2024, 1, 1, 7), 3.0), (None, D(2024, 1, 1), 1.0), (2, None, 9.0)]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double").mapInArrow(count, "site_id long, ts timestamp_ntz, v double")
    got = sorted((r.site_id, r.ts, r.v) for r in series.upsample_linear(df, "1 hour", "v").collect())
    assert [x[:2] for x in got[:53]] == [(1, D(2024, 1, 1, 22) + dt.timedelta(hours=h)) for h in range(53)]
    assert [x[2] for x in got[:53]] == pytest.approx([float(h) for h in range(53)])
    assert [(s, t.hour) for s, t, _ in got[53:]] == [(2, 5), (2, 6), (2, 7)] and [v for _, _, v in got[53:]] == [None, None, 3.0]
    assert made.value == len(rows)


@pytest.mark.parametrize("inclusive", [True, False])
def test_fill_scan_goes_through_a_chunk_once(spark, inclusive):
    """Nearest known rows before and after, over chunks without any; no frame runs to the end of its partition, which is read again for each row."""
    from plantframe.operators import chunks
    known = {0, 3, 4, 30, 31, 55, 120}
    rows = [(s, D(2024, 1, 1) + dt.timedelta(hours=h), float(h + s) if h in known else None) for s in (1, 2) for h in range(0, 130, 1) if not 60 <= h < 90]
    df = chunks.with_chunk(spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double").repartition(3), "ts", "day")
    out = chunks.fill_scan(df, "site_id", "ts", "v", "both", inclusive=inclusive)
    assert "unboundedfollowing" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    own = [(s, t, v) for s, t, v in rows if v is not None]
    at = lambda x: None if x is None else (x.o0, x.v)
    near = lambda found, pick: pick(found) if found else None
    for r in out.collect():
        before = [(t, v) for s, t, v in own if s == r.site_id and (t < r.ts or inclusive and t == r.ts)]
        after = [(t, v) for s, t, v in own if s == r.site_id and (t > r.ts or inclusive and t == r.ts)]
        assert (at(r._prev_v), at(r._next_v)) == (near(before, max), near(after, min)), r
