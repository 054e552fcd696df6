"""R-checked model keys: each model must beat the train-mean baseline on a seasonal series."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plantframe.functions import calendar, profiles
from plantframe.operators import metrics, samples
from plantframe.plans import forecast as fc

D = dt.datetime


@pytest.fixture(scope="module")
def seasonal(spark):
    rows = []
    for s in range(2):
        for h in range(24 * 35):
            ts = D(2024, 1, 1) + dt.timedelta(hours=h)
            y = 50 + 30 * math.sin(2 * math.pi * ts.hour / 24) + (10 if ts.weekday() >= 5 else 0) + 5 * s
            rows.append((s, ts, y))
    return spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, kwh double")


def _baseline_rmse(train, test):
    mean = train.agg(F.avg("kwh")).first()[0]
    return test.select(F.sqrt(F.avg((F.col("kwh") - F.lit(mean)) ** 2))).first()[0]


def test_gbt_beats_mean(spark, seasonal):
    f = calendar.calendar_features(seasonal).withColumns({
        "day": calendar.iso_day_number("ts"), "day_time": calendar.day_part(F.col("hour")), "Holiday": F.lit(0),
        "temperature": profiles.weather_temperature(F.col("hour"))})
    f = f.withColumn("temp_category_int", calendar.temp_category_code("temperature"))
    split = samples.chrono_split(f)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    model = fc.fit_gbt(train, calendar.CONSUMPTION_FEATURES, "kwh", rounds=10)
    rmse = metrics.forecast_errors(fc.score(model, test), "kwh", "prediction").first().rmse
    assert rmse < 0.5 * _baseline_rmse(train, test)


def test_seasonal_regression_beats_mean(spark, seasonal):
    split = samples.chrono_split(seasonal)
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    scored = fc.apply_seasonal(test.join(fc.fit_seasonal(train, "kwh").drop("n"), "site_id"), out="prediction")
    rmse = metrics.forecast_errors(scored, "kwh", "prediction").first().rmse
    assert rmse < 0.5 * _baseline_rmse(train, test)


def test_seasonal_regression_is_per_site(spark):
    """Sites of different levels, waves and trends; one without readings, one with a single reading, one with gaps."""
    rows = []
    for h in range(24 * 40):
        ts = D(2024, 1, 1) + dt.timedelta(hours=h)
        wave = math.sin(2 * math.pi * ts.hour / 24)
        rows += [(1, ts, 10.0 + wave), (2, ts, 1000.0 - 100 * wave), (3, ts, 50.0 + 0.1 * max(h - 480, 0)), (4, ts, None if h % 3 else 7.0)]
    rows += [(5, D(2024, 1, 9), 33.0), (6, D(2024, 1, 9), None)]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, kwh double")
    model = fc.fit_seasonal(df, "kwh")
    starts = df.groupBy("site_id").agg(F.max("ts").alias("start"))
    got = {}
    for r in fc.forecast_seasonal(model, starts, 24, "1 hour").collect():
        got.setdefault(r.site_id, []).append((r.ts, r.forecast))
    for ts, v in got[1]:
        assert v == pytest.approx(10.0 + math.sin(2 * math.pi * ts.hour / 24), abs=0.5)
    for ts, v in got[2]:
        assert v == pytest.approx(1000.0 - 100 * math.sin(2 * math.pi * ts.hour / 24), rel=0.05)
    last = 50.0 + 0.1 * (24 * 40 - 480)
    assert all(v == pytest.approx(last, rel=0.1) for _, v in got[3])  # the trend after its bend, not the mean of 66
    assert all(v == pytest.approx(7.0, abs=0.2) for _, v in got[4])
    assert all(v == pytest.approx(33.0, rel=0.2) for _, v in got[5])
    assert all(v is None for _, v in got[6]) and len(got[6]) == 24


def test_seasonal_statistics_are_sums(spark, seasonal):
    """Two halves of a table add up to the whole, so partial sums of any split do."""
    span = fc.time_span(seasonal)
    whole = {r.site_id: r for r in fc.seasonal_statistics(seasonal, "kwh", span).collect()}
    early, late = (fc.seasonal_statistics(seasonal.where(c), "kwh", span).collect() for c in ("ts < '2024-01-20'", "ts >= '2024-01-20'"))
    terms = len(fc.seasonal_features())
    for a, b in zip(sorted(early, key=lambda r: r.site_id), sorted(late, key=lambda r: r.site_id)):
        w = whole[a.site_id]
        assert a.n + b.n == w.n and len(w.gram) == terms * (terms + 1) // 2 and len(w.moment) == terms
        assert [x + y for x, y in zip(a.gram, b.gram)] == pytest.approx(list(w.gram)) and [x + y for x, y in zip(a.moment, b.moment)] == pytest.approx(list(w.moment))


def test_best_round_and_patience():
    assert fc.best_round([5, 4, 3, 3, 4, 5], patience=3) == (3, True)
    assert fc.best_round([5, 4, 3, 3, 4], patience=3) == (3, False)
    assert fc.best_round([5, 6, 7, 1], patience=2) == (1, True)  # what comes after the stop is not seen
    assert fc.best_round([3, 2, 1], patience=1) == (3, False) and fc.best_round([], patience=1) == (0, False)


@pytest.fixture(scope="module")
def noisy(spark):
    """Noise that boosting learns by heart: the validation loss rises after a few rounds."""
    import random
    rnd = random.Random(5)
    rows = [(float(rnd.randrange(40)), float(rnd.randrange(40)), i % 4 == 0) for i in range(400)]
    rows = [(a, b, 3.0 * (a > 20) + rnd.gauss(0, 1.0), v) for a, b, v in rows]
    return spark.createDataFrame(rows, "a double, b double, y double, val boolean").coalesce(2)


def test_validated_boosting_keeps_the_best_rounds(spark, noisy, tmp_path, monkeypatch):
    monkeypatch.setattr(fc, "FIRST_ROUNDS", 8)
    train, val = noisy.where("not val"), noisy.where("val")
    model, losses = fc.fit_validated(train, val, ["a", "b"], "y", rounds=64, patience=5, depth=4, step=0.3)
    kept = model.stages[-1].getNumTrees
    assert kept == 1 + min(range(len(losses)), key=losses.__getitem__) or min(losses[kept:kept + 5]) >= losses[kept - 1]
    assert 1 <= kept < len(losses) and len(losses) in (8, 16, 32)
    # the cut model is the first rounds of the whole one, and scores as its loss says
    mse = fc.score(model, val).select(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(losses[kept - 1])
    fc.save_model(model, str(tmp_path / "m"))
    again = fc.load_model(str(tmp_path / "m"))
    assert [r.prediction for r in fc.score(again, val).collect()] == [r.prediction for r in fc.score(model, val).collect()]


def test_validated_boosting_without_validation_rows(spark, noisy):
    model, losses = fc.fit_validated(noisy, noisy.where("false"), ["a", "b"], "y", rounds=4, depth=2)
    assert model.stages[-1].getNumTrees == 4 and losses == []


def test_validated_boosting_makes_its_features_once(spark, noisy, monkeypatch):
    """Scaler, attempts and losses read kept rows: a feature is made once for each row."""
    monkeypatch.setattr(fc, "FIRST_ROUNDS", 2)
    made = spark.sparkContext.accumulator(0)

    def count(a):
        made.add(1)
        return a

    df = noisy.withColumn("a", F.udf(count, "double")("a"))
    fc.fit_validated(df.where("not val"), df.where("val"), ["a", "b"], "y", rounds=4, depth=2)
    assert made.value == 400


def test_multi_horizon_beats_mean(spark, seasonal):
    frame = fc.multi_horizon_frame(seasonal, "kwh", 24, 3, rows_per_chunk=256)
    split = samples.random_split(frame.withColumn("k", F.concat_ws("|", "site_id", "anchor_ts", "h")), ["k"])
    train, test = split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")
    model = fc.fit_gbt_vector(train, "y", rounds=10)
    rmse = metrics.forecast_errors(model.transform(test), "y", "prediction").first().rmse
    mean = train.agg(F.avg("y")).first()[0]
    base = test.select(F.sqrt(F.avg((F.col("y") - F.lit(mean)) ** 2))).first()[0]
    assert rmse < 0.5 * base


def test_a_fit_has_a_wave_of_partitions(spark, monkeypatch):
    """Partitions follow the cores, not the rows: a fit's hundreds of jobs send a result for each partition."""
    monkeypatch.setattr(fc, "TRAIN_ROWS", 10)
    cores = spark.sparkContext.defaultParallelism
    held = spark.range(0, 2000, 1, 40)
    assert fc.packed(held).rdd.getNumPartitions() == cores
    monkeypatch.setattr(fc, "FULL_ROWS", 2000 // (2 * cores))
    assert fc.packed(held).rdd.getNumPartitions() == 2 * cores
    assert fc.packed(spark.range(0, 15, 1, 40)).rdd.getNumPartitions() == 2 and fc.packed(spark.range(0)).rdd.getNumPartitions() <= 1


def test_feature_frame_checks_rows_where_they_are_made(spark):
    """The check of the features isn't pushed below the aggregate, where it made them for each raw row."""
    df = spark.createDataFrame([(1, D(2024, 1, 1, 12), 1.0), (1, D(2024, 1, 1, 12), 3.0), (2, D(2024, 1, 1, 13), float("nan")), (None, D(2024, 1, 1, 13), 5.0), (3, D(2024, 1, 1, 14), None)],
                               "site_id long, ts timestamp_ntz, kwh double")
    f = df.groupBy("site_id", "ts").agg(F.sum("kwh").alias("kwh")).withColumn("wave", F.sin(F.col("site_id") + F.hour("ts")))
    out = calendar.feature_frame(f, ["wave"], keep=("site_id", "ts"), target="kwh")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "SIN" in x]
    assert out.columns == ["site_id", "ts", "wave", "kwh"] and [(r.site_id, r.kwh) for r in out.collect()] == [(1, 4.0)]


@pytest.mark.parametrize("scale", [True, False])
def test_a_fit_over_bins_is_the_fit_over_rows(spark, scale):
    """Rows counted together by their bins give MLlib's model of the single rows: few and many values, a constant, repeats, NULLs, NaN."""
    import random
    rnd = random.Random(3)
    rows = [(float(rnd.randrange(7)), rnd.gauss(0, 1), rnd.random() ** 3, 1) for _ in range(1500)]
    rows = [(a, b, c, k, 3.0 * a + (b > 0.3) * 5.0 + 20 * c + rnd.gauss(0, 0.5)) for a, b, c, k in rows]
    rows += rows[:400] + [(None, 0.1, 0.2, 1, 7.0), (1.0, float("nan"), 0.2, 1, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k int, y double").repartition(3).persist()
    names = ["a", "b", "c", "k"]
    got = fc.score(fc.fit_gbt(df, names, "y", rounds=6, scale=scale), df)
    want = fc.score(fc.gbt_pipeline(names, "y", rounds=6, scale=scale).fit(df), df)  # MLlib's own fit over single rows
    assert got.columns == [*df.columns, "prediction"]
    key = lambda r: (r.a, r.b, r.c, r.y)
    got, want = (sorted(x.collect(), key=key) for x in (got, want))
    assert len(got) == len(want) == 1900 and [r.prediction for r in got] == pytest.approx([r.prediction for r in want])


def test_a_fit_runs_over_as_many_groups_however_many_rows(spark, monkeypatch):
    """Hours, days and a continuous value: eight times the rows are no eight times the rows of a round."""
    seen = []
    real = fc.wave
    monkeypatch.setattr(fc, "wave", lambda n, df, each: seen.append(n) or real(n, df, each))
    for n in (4000, 32000):
        df = spark.range(n).select((F.col("id") % 24).alias("hour"), (F.col("id") % 7).alias("day"), (F.xxhash64("id") / 2.0**62).alias("x"))
        fc.fit_gbt(df.withColumn("y", F.col("hour") + F.col("x")), ["hour", "day", "x"], "y", rounds=1, depth=2)
    assert seen[1] <= 24 * 7 * fc.GBT_BINS and seen[1] < 2 * seen[0]
    assert fc.all_seen(seen[1]) ** 2 >= seen[1] and fc.all_seen(5) == fc.GBT_BINS


def test_split_points():
    assert fc.split_points([]) == [] and fc.split_points([(3.0, 9)]) == []
    assert fc.split_points([(4.0, 1), (0.0, 99), (1.0, 5)]) == [0.5, 2.5]  # all values are told apart, however rare
    assert fc.split_points([(float(i), 1) for i in range(8)], bins=4) == [1.5, 3.5, 5.5]
    assert fc.split_points([(0.0, 97), *((float(i), 1) for i in range(1, 4))], bins=2) == [0.5]


def test_a_label_without_a_value_is_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (2.0, 3.0)], "a double, y double")
    with pytest.raises(Exception, match="(?i)null"):
        fc.fit_gbt(df, ["a"], "y", rounds=1)


def test_sun_position_has_each_term_once(spark):
    """Staged terms give the values of the whole expressions, and aren't written out again for each use."""
    from plantframe.functions import solar
    df = spark.createDataFrame([(i, D(2024, 1 + i % 12, 3, i % 24, 7)) for i in range(48)] + [(99, None)], "site_id long, ts timestamp_ntz")
    lat, lon = F.lit(47.0) + F.col("site_id") % 8, F.lit(6.0) + F.col("site_id") % 9
    az, alt = solar.sun_position_cols("ts", lat, lon)
    out = solar.sun_position(df, lat, lon)
    assert out.columns == ["site_id", "ts", "azimuth", "altitude"]
    want = {r.site_id: (r.a, r.b) for r in df.select("site_id", az.alias("a"), alt.alias("b")).collect()}
    assert {r.site_id: (r.azimuth, r.altitude) for r in out.collect()} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().upper().count("SIN(") < 20


@pytest.mark.parametrize("few", [True, False])
def test_trees_are_asked_once_for_each_combination_of_bins(spark, few):
    """The scores of single rows, repeated ones too, without those that have NULLs; few combinations are broadcast, many are not."""
    rows = [(i, float(i % 5), float(i % 3) if few else i / 7.0, (i % 5) * 2.0 + i % 3) for i in range(600)]
    df = spark.createDataFrame(rows + rows[:50] + [(-1, None, 1.0, 2.0), (-2, 1.0, float("nan"), 2.0)], "id long, a double, b double, y double")
    model = fc.fit_gbt(df, ["a", "b"], "y", rounds=4, depth=3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold if few else "-1")
        out = fc.score_each(model, fc.binned(model, df))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ("BroadcastHashJoin" in plan) == few and "__raw" not in plan  # the trees' vectors are no part of the rows' plan
    assert out.columns == [*df.columns, "prediction"]
    assert len(got) == 650 and got == sorted(map(tuple, fc.score(model, df).collect()))
    assert fc.binned(None, df) is df and fc.score_each(None, df).where("prediction is not null").count() == 0


def test_scored_features_are_the_rows_that_were_scored(spark):
    from plantframe.plans import scoring
    rows = [(i, D(2024, 1, 1, i % 24), float(i % 5), float(i % 3), i % 5 + 1.0) for i in range(200)]
    df = spark.createDataFrame([*rows, (999, D(2024, 1, 1), None, 1.0, 1.0)], "site_id long, ts timestamp_ntz, a double, b double, y double")
    model = fc.fit_gbt(df, ["a", "b"], "y", rounds=3, depth=2)
    frame = df.drop("y")
    both = scoring.scored(model, frame, "out")
    assert both.forecast.columns == ["site_id", "ts", "out"] and both.features.columns == frame.columns
    assert sorted(map(tuple, both.features.collect())) == sorted(r[:4] for r in rows)
    want = {r.site_id: r.prediction for r in fc.score(model, frame).collect()}
    assert {r.site_id: r.out for r in both.forecast.collect()} == want and len(want) == 200
    assert "UDF" not in both.forecast._jdf.queryExecution().optimizedPlan().toString()


def _horizon_rows(spark, sites=3, hours=260, horizons=12, partitions=3):
    """Samples of noisy series: 12 horizons or fewer at the ends, some targets missing; kept, so that each fit samples rows of the same order."""
    import random
    rnd = random.Random(11)
    rows = [(s, D(2024, 1, 1) + dt.timedelta(hours=h), None if h % 97 == 40 else round(20 + 10 * math.sin(h / 4) + 3 * s + rnd.gauss(0, 4), 2) * (h % 53 != 7))
            for s in range(sites) for h in range(hours)]
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, kwh double")
    return fc.multi_horizon_frame(df, "kwh", 6, horizons, rows_per_chunk=128).coalesce(partitions).persist()


def _same_scores(got, want, rows, depth=4):
    key = ["site_id", "anchor_ts", "h", "y"]
    a, b = (sorted(tuple(r) for r in m.transform(rows).select(*key, "prediction").collect()) for m in (got, want))
    assert len(a) == len(b) > 0 and [x[:4] for x in a] == [x[:4] for x in b]
    assert [x[4] for x in a] == pytest.approx([x[4] for x in b])
    assert got.stages[0].getNumTrees == want.stages[0].getNumTrees and got.stages[0].numFeatures == want.stages[0].numFeatures
    for x, y in zip(got.stages[0].trees, want.stages[0].trees):
        assert x.numNodes == y.numNodes and x.depth <= depth
        (r, q) = (t._java_obj.rootNode() for t in (x, y))
        assert r.impurity() == pytest.approx(q.impurity()) and r.gain() == pytest.approx(q.gain()) and r.impurityStats().count() == q.impurityStats().count()


@pytest.mark.parametrize("sites", [2, 5])
def test_a_fit_over_bundles_is_the_fit_over_rows(spark, sites, tmp_path, monkeypatch):
    """Rows that share their lags, counted together, give MLlib's trees of the single rows: all rows looked at for the bins (2 sites) or a sample (5)."""
    from plantframe.plans import boosting
    monkeypatch.setattr(fc, "TRAIN_ROWS", 2000)
    monkeypatch.setattr(boosting, "BLOCK_BUNDLES", 100)
    monkeypatch.setattr(boosting, "CHAIN", 2)  # residuals are made anew from the targets now and then
    monkeypatch.setattr(boosting, "DIRECT", 2)
    rows = _horizon_rows(spark, sites)
    assert (rows.count() > fc.LIMIT_ROWS) == (sites == 5)
    got = fc.fit_gbt_vector(rows, "y", parts=("lags", "h"), rounds=5, depth=4)
    _same_scores(got, fc.fit_gbt_vector(rows, "y", rounds=5, depth=4), rows)
    path = str(tmp_path / "m")
    got.write().save(path)
    again = fc.PipelineModel.load(path)
    assert [r.prediction for r in again.transform(rows).collect()] == [r.prediction for r in got.transform(rows).collect()]


def test_a_fit_over_bundles_takes_rows_as_they_come(spark):
    """Horizons left out, rows that come twice with other targets, rows in any order: each row counts."""
    rows = _horizon_rows(spark).where("(h + hour(anchor_ts)) % 5 > 0")
    twice = rows.union(rows.where("h % 3 = 0").withColumn("y", F.col("y") + 1.0)).repartition(3, "site_id").sortWithinPartitions("site_id", "anchor_ts", "h")
    mixed = rows.repartition(3, F.xxhash64("anchor_ts", "h")).sortWithinPartitions(F.xxhash64("h", "anchor_ts"))
    for x in (twice, mixed):
        _same_scores(fc.fit_gbt_vector(x, "y", parts=("lags", "h"), rounds=3, depth=3), fc.fit_gbt_vector(x, "y", rounds=3, depth=3), x, 3)


def test_a_bundle_is_looked_at_once_for_all_horizons(spark, monkeypatch):
    """The work of a level follows the anchors, not anchors times horizons, and no row goes to MLlib's own fit."""
    from plantframe.plans import boosting

    def refuse(*_):
        raise AssertionError("a fit over single rows")

    monkeypatch.setattr(fc.GBTRegressor, "_fit", refuse)
    seen = []
    real = boosting.boost
    monkeypatch.setattr(boosting, "boost", lambda blocks, *a: seen.append(blocks.map(lambda b: (b[0].shape[1], int(b[2].sum()))).collect()) or real(blocks, *a))
    rows = _horizon_rows(spark)
    fc.fit_gbt_vector(rows, "y", parts=("lags", "h"), rounds=2, depth=3)
    anchors = rows.select("site_id", "anchor_ts").distinct().count()
    bundles, counted = (sum(x) for x in zip(*seen[0]))
    assert counted == rows.count() and anchors <= bundles <= anchors + 6 < counted / 8


@pytest.mark.parametrize("x, y", [([1.0, float("nan")], 1.0), ([1.0, 2.0], None), ([1.0, 2.0], float("inf")), ([1.0, None], 1.0)])
def test_a_fit_over_bundles_refuses_what_has_no_value(spark, x, y):
    df = spark.createDataFrame([([1.0, 2.0], 1.0, 3.0), (x, 2.0, y)], "lags array<double>, h double, y double")
    with pytest.raises(Exception, match="(?i)null"):
        fc.fit_gbt_vector(df, parts=("lags", "h"), rounds=1)


def test_a_fit_over_bundles_of_few_rows(spark):
    """A single row, equal targets and constant features have trees without splits; no rows are refused."""
    df = spark.createDataFrame([([1.0, 2.0], 1.0, 3.0), ([1.0, 2.0], 2.0, 3.0), ([0.0, 2.0], 1.0, 3.0)], "lags array<double>, h double, y double")
    df = df.withColumn("__vec", fc.array_to_vector(F.concat("lags", F.array("h"))))
    for x in (df, df.limit(1)):
        model = fc.fit_gbt_vector(x, parts=("lags", "h"), rounds=3)
        assert {r.prediction for r in model.transform(x).collect()} == {3.0}
    with pytest.raises(Exception, match="(?i)empty"):
        fc.fit_gbt_vector(df.where("h > 9"), parts=("lags", "h"), rounds=1)
