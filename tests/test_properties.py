"""Property tests: chunked / distributed forms equal plain sequential ones."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantframe.functions.plant import DEFAULT
from plantframe.operators import chunks, ledger, samples, series

D = dt.datetime


def _random_series(spark, n_sites=3, n=400, seed=7, null_frac=0.3, span_days=70):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_sites):
        stamps = sorted(rnd.sample(range(span_days * 24 * 60), n))
        for m in stamps:
            v = None if rnd.random() < null_frac else round(rnd.uniform(-50, 150), 2)
            rows.append((s, D(2024, 1, 1) + dt.timedelta(minutes=m), v))
    return spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double"), rows


def _pandas_interp(vals):
    import pandas as pd
    return pd.Series(vals, dtype="float64").interpolate("linear").tolist()


def test_interpolation_matches_pandas_across_chunks(spark):
    df, rows = _random_series(spark)
    got = {(r.site_id, r.ts): r.v for r in series.interpolate_linear(df, "v").collect()}
    for s in range(3):
        srows = sorted([r for r in rows if r[0] == s], key=lambda r: r[1])
        exp = _pandas_interp([r[2] for r in srows])
        for r, e in zip(srows, exp):
            g = got[(s, r[1])]
            if np.isnan(e):
                assert g is None
            else:
                assert g == pytest.approx(e, abs=1e-9)


def test_chunk_unit_does_not_change_results(spark):
    df, _ = _random_series(spark, seed=3)
    a = series.interpolate_linear(df, "v", chunk="day")
    b = series.interpolate_linear(df, "v", chunk="none")
    c = series.fill_forward_backward(df, "v", chunk="hour")
    d = series.fill_forward_backward(df, "v", chunk="month")
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(c.collect()) == sorted(d.collect())


def test_positional_index_equals_row_number(spark):
    df, _ = _random_series(spark, seed=11)
    got = series.with_position(df, pos="pos", chunk="day")
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("site_id").orderBy("ts")) - 1)
    j = got.join(ref, ["site_id", "ts"])
    assert j.filter(F.col("pos") != F.col("rn")).count() == 0
    assert j.count() == df.count()


def test_neighbor_rows_across_chunks(spark):
    df, _ = _random_series(spark, seed=5)
    base = chunks.with_chunk(df, "ts", "day")
    got = chunks.neighbor_rows(base, "site_id", "ts", ["v"])
    w = Window.partitionBy("site_id").orderBy("ts")
    ref = df.withColumns({"pt": F.lag("ts").over(w), "nt": F.lead("ts").over(w)})
    j = got.join(ref, ["site_id", "ts"])
    bad = j.filter(~F.col("_prev.o0").eqNullSafe(F.col("pt")) | ~F.col("_next.o0").eqNullSafe(F.col("nt")))
    assert bad.count() == 0


def _sequential_battery(charges, discharges, p=DEFAULT):
    L = p.value("battery_storage.initial_level")
    out = []
    for c, d in zip(charges, discharges):
        if c > 0:
            a = min(c, p.value("battery_storage.max_charge_rate"),
                    (p.value("battery_storage.max_level") - L) / p.value("battery_storage.charge_efficiency"))
            L += a * p.value("battery_storage.charge_efficiency")
        if d > 0:
            a = min(d, p.value("battery_storage.max_discharge_rate"),
                    (L - p.value("battery_storage.min_level")) * p.value("battery_storage.discharge_efficiency"))
            L -= a / p.value("battery_storage.discharge_efficiency")
        L *= 1 - p.value("battery_storage.self_discharge_rate")
        out.append(L)
    return out


@pytest.mark.parametrize("levels", [("day", "month"), ("hour", "day", "month"), ("month",)])
def test_chunked_ledger_equals_sequential_over_months(spark, levels):
    rnd = random.Random(1)
    rows = []
    for s in range(2):
        t = D(2024, 1, 1)
        for _ in range(24 * 75):          # 75 days: crosses day and month boundaries
            t += dt.timedelta(hours=1)
            rows.append((s, t, rnd.choice([0.0, 0.0, rnd.uniform(0, 80)]), rnd.choice([0.0, rnd.uniform(0, 80)])))
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, battery_charge double, battery_discharge double")
    led = ledger.run_ledger(df, ledger.battery_map(), DEFAULT.value("battery_storage.initial_level"),
                            level_out="battery_level", levels=levels)
    got = {(r.site_id, r.ts): r.battery_level for r in led.collect()}
    for s in range(2):
        srows = [r for r in rows if r[0] == s]
        exp = _sequential_battery([r[2] for r in srows], [r[3] for r in srows])
        for r, e in zip(srows, exp):
            assert got[(s, r[1])] == pytest.approx(e, abs=1e-7)
            assert DEFAULT.value("battery_storage.min_level") * 0.99 - 1e-9 <= got[(s, r[1])] <= 95 + 1e-9


@pytest.mark.parametrize("run", [1, 4, 32])
def test_ledger_of_dense_buckets(spark, monkeypatch, run):
    """Hours of a step a second, an hour of one step, repeated stamps and NULL amounts, against the loop."""
    monkeypatch.setattr(ledger, "RUN", run)
    rnd = random.Random(4)
    rows = []
    for s, n in ((0, 3600 if run == 32 else 700), (1, 1), (2, 33)):
        t = D(2024, 1, 1, 0, 59, 59)
        for i in range(n):
            t += dt.timedelta(seconds=1)
            rows.append((s, t, rnd.choice([0.0, None, rnd.uniform(0, 30)]), rnd.choice([0.0, rnd.uniform(0, 30)])))
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, battery_charge double, battery_discharge double").repartition(3)
    got = {(r.site_id, r.ts): (r.battery_level_in, r.battery_level) for r in ledger.battery_ledger(df).collect()}
    assert len(got) == len(rows)
    for s in range(3):
        srows = [r for r in rows if r[0] == s]
        exp = _sequential_battery([r[2] or 0.0 for r in srows], [r[3] for r in srows])
        before = DEFAULT.value("battery_storage.initial_level")
        for r, e in zip(srows, exp):
            assert got[(s, r[1])] == (pytest.approx(before, abs=1e-7), pytest.approx(e, abs=1e-7))
            before = e


def test_halo_windows_independent_of_chunk_size(spark):
    df, _ = _random_series(spark, seed=9, null_frac=0.0)
    a = samples.seq_to_seq_windows(df, ["v"], "v", 5, rows_per_chunk=16)
    b = samples.seq_to_seq_windows(df, ["v"], "v", 5, rows_per_chunk=100000)
    key = ["site_id", "anchor_ts"]
    ja = a.select(*key, F.to_json("x").alias("x"), F.to_json("y").alias("y"))
    jb = b.select(*key, F.to_json("x").alias("x"), F.to_json("y").alias("y"))
    assert ja.count() == jb.count() == 3 * (400 - 2 * 5 + 1)
    assert ja.exceptAll(jb).count() == 0


def test_standard_scale_inverse_is_identity(spark):
    df, _ = _random_series(spark, seed=2, null_frac=0.0)
    split = samples.chrono_split(df)
    scaled, stats = samples.standard_scale_train(split, ["v"])
    back = samples.inverse_scale_target(scaled.withColumnRenamed("v", "z").withColumn("v", F.col("z")), stats, "v")
    j = back.join(df.withColumnRenamed("v", "orig"), ["site_id", "ts"])
    assert j.filter(F.abs(F.col("v") - F.col("orig")) > 1e-9).count() == 0


def test_repartitioning_input_does_not_change_results(spark):
    df, _ = _random_series(spark, seed=4)
    a = series.interpolate_linear(df.repartition(7), "v")
    b = series.interpolate_linear(df.coalesce(1), "v")
    assert sorted(a.collect()) == sorted(b.collect())


def test_chrono_split_counts(spark):
    df, _ = _random_series(spark, seed=6, n=100)
    counts = {(r.site_id, r.split): r["count"] for r in samples.chrono_split(df).groupBy("site_id", "split").count().collect()}
    for s in range(3):
        assert counts[(s, "train")] == 70 and counts[(s, "val")] == 15 and counts[(s, "test")] == 15


def test_ledger_with_per_site_initial_levels(spark):
    rows = [(s, D(2024, 1, 1) + dt.timedelta(hours=h), 10.0, 0.0, 20.0 + 30.0 * s) for s in range(2) for h in range(60)]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, battery_charge double, battery_discharge double, l0 double")
    led = ledger.run_ledger(df, ledger.battery_map(), F.col("l0"), level_out="battery_level")
    first = {r.site_id: r.battery_level for r in led.filter(F.col("ts") == D(2024, 1, 1)).collect()}
    assert first[0] == pytest.approx((20.0 + 9.2) * 0.999)
    assert first[1] == pytest.approx((50.0 + 9.2) * 0.999)
