"""File-based sources and sinks."""

import datetime as dt
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from plantframe.plans import forecast as fc
from plantframe.sources import meter_csv, params, payloads, prices, sinks

D = dt.datetime


def _tmpdir():
    return tempfile.mkdtemp(prefix="plantframe-test-")


def test_scan_meter_csv_skips_preamble(spark):
    d = _tmpdir()
    with open(os.path.join(d, "site_7.csv"), "w", encoding="utf-8") as f:
        f.write("Zählpunkt;DE0001\nZeitraum;01.01.2024 - 02.01.2024\nDatum;Wert;Einheit\n"
                "01.01.2024 00:15;1,25;kWh\n01.01.2024 00:30;2,5;kWh\nSumme;3,75;kWh\n")
    df = meter_csv.scan_meter_csv(spark, d, site_pattern=r"site_(\d+)\.csv")
    rows = sorted(df.collect())
    assert [(r.site_id, r.ts, r.kwh) for r in rows] == [("7", D(2024, 1, 1, 0, 15), 1.25), ("7", D(2024, 1, 1, 0, 30), 2.5)]
    counts = meter_csv.meter_reject_counts(spark, d).collect()[0]
    assert (counts.rows, counts.rejected, counts.preamble) == (2, 1, 3)


def test_scan_forecast_csv_keeps_microseconds(spark):
    d = _tmpdir()
    p = os.path.join(d, "heat.csv")
    with open(p, "w") as f:
        f.write("timestamp,heat_demand\n2025-07-08 14:16:03.134891,175.0\n2025-07-08 15:16:03.134891,164.6\n")
    rows = meter_csv.scan_forecast_csv(spark, p, "heat_demand double").orderBy("ts").collect()
    assert rows[0].ts == D(2025, 7, 8, 14, 16, 3, 134891) and rows[1].heat_demand == 164.6


def test_profile_fallback_fills_missing(spark):
    base = spark.createDataFrame([(1, D(2024, 1, 1, 12)), (1, D(2024, 1, 1, 13))], "site_id long, ts timestamp_ntz")
    obs = spark.createDataFrame([(1, D(2024, 1, 1, 12), 3.0, 100.0, 70.0)],
                                "site_id long, ts timestamp_ntz, temperature double, solar_irradiance double, humidity double")
    got = {r.ts.hour: r for r in meter_csv.with_profile_fallback(base, obs).collect()}
    assert got[12].temperature == 3.0
    assert got[13].temperature == pytest.approx(15 + 10 * math.sin(2 * math.pi * 7 / 24))


def test_params_file_with_defaults(spark):
    d = _tmpdir()
    p = os.path.join(d, "parameters.json")
    with open(p, "w") as f:
        json.dump({"system_parameters": {"chp": {"P_max": 123.0}}}, f, indent=2)
    row = params.flat_system_params(params.read_params(spark, p)).collect()[0]
    assert row["chp__P_max"] == 123.0 and row["chp__eta_el"] == 0.35 and row["battery_storage__max_level"] == 95.0
    assert row["electric_heaters__stage_powers"] == [50.0, 75.0, 75.0]


def test_flatten_series_payload(spark):
    js = json.dumps({"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, 2.5],
                                "relative_humidity_2m": [80.0, 81.0]}})
    df = spark.createDataFrame([(js,)], "payload string")
    rows = payloads.flatten_series_payload(df, ["temperature_2m", "relative_humidity_2m"]).orderBy("ts").collect()
    assert [(r.ts, r.temperature, r.humidity) for r in rows] == [(D(2024, 1, 1, 0), 1.5, 80.0), (D(2024, 1, 1, 1), 2.5, 81.0)]


def test_holiday_dates_region(spark):
    js = json.dumps([{"date": "2024-01-01", "global": True, "counties": None},
                     {"date": "2024-10-31", "global": False, "counties": ["DE-SH", "DE-HH"]},
                     {"date": "2024-01-06", "global": False, "counties": ["DE-BY"]}])
    df = spark.createDataFrame([(js,), (js,)], "payload string")
    got = sorted(r.date.isoformat() for r in payloads.holiday_dates(df, "DE-SH").collect())
    assert got == ["2024-01-01", "2024-10-31"]


def test_flatten_price_json_both_shapes(spark):
    items = [{"date": "2024-01-01T00:00", "value": 80.0, "region": "DE-LU", "resolution": "PT60M"},
             {"date": "2024-01-01T01:00", "value": 81.0, "region": "AT", "resolution": "PT60M"}]
    df = spark.createDataFrame([(json.dumps(items),), (json.dumps({"data": items}),)], "payload string")
    rows = payloads.flatten_price_json(df, region="DE-LU").collect()
    assert len(rows) == 2 and all(r.price == 80.0 and r.timestamp == D(2024, 1, 1) for r in rows)


def test_extract_price_table(spark):
    cells = "".join(f"<tr><td>{h}</td><td>a</td><td>b</td><td>{80 + h},5</td></tr>" for h in range(25))
    html = "<table><tr><th>h</th></tr><tr><td>x</td><td>1,0</td></tr><tr><td>1</td><td>2</td><td>3</td><td>n/a</td></tr>" + cells
    short = "<table>" + "".join(f"<tr><td>{h}</td><td>a</td><td>b</td><td>1,0</td></tr>" for h in range(23)) + "</table>"
    df = spark.createDataFrame([(1, html, dt.date(2024, 1, 2)), (2, short, dt.date(2024, 1, 2))],
                               "page long, html string, delivery_date date")
    rows = prices.extract_price_table(df, keep=("page",)).orderBy("hour").collect()
    assert len(rows) == 24 and {r.page for r in rows} == {1}
    assert rows[0].price_eur_mwh == 80.5 and rows[0].price_ct_kwh == pytest.approx(8.05)
    assert rows[23].ts == D(2024, 1, 2, 23)


def test_price_source_fallback(spark):
    src = spark.createDataFrame([(1, dt.date(2024, 1, 1), "scrape", 1, h, 5.0) for h in range(24)]
                                + [(1, dt.date(2024, 1, 2), "scrape", 1, h, 5.0) for h in range(23)],
                                "site_id long, day date, source string, priority int, hour long, price_ct double")
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2))], "site_id long, day date")
    got = prices.price_source_fallback(src, days).groupBy("day", "source").count().collect()
    assert {(r.day.day, r.source, r["count"]) for r in got} == {(1, "scrape", 24), (2, "default", 24)}


def test_sink_round_trip(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1, h), float(h)) for h in range(5)] + [(2, D(2024, 1, 1), 9.0)],
                               "site_id long, ts timestamp_ntz, v double")
    d = _tmpdir() + "/out"
    sinks.sink_series(df, d, "csv")
    back = sinks.read_sink(spark, d, "csv", "site_id long, ts timestamp_ntz, v double").drop("date")
    assert sorted(back.select("site_id", "ts", "v").collect()) == sorted(df.collect())
    assert os.path.isdir(os.path.join(d, "date=2024-01-01"))


def test_model_store_round_trip(spark):
    df = spark.createDataFrame([(float(i), float(i % 7), float(2 * i + (i % 7))) for i in range(200)], "a double, b double, y double")
    d = _tmpdir() + "/model"
    m = fc.load_or_train(d, df, ["a", "b"], "y", rounds=5)
    m2 = fc.load_or_train(d, df, ["a", "b"], "y", rounds=50)   # loads, does not retrain
    p1 = [r.prediction for r in fc.score(m, df).collect()]
    p2 = [r.prediction for r in fc.score(m2, df).collect()]
    assert p1 == p2
    assert fc.score(None, df).filter(F.col("prediction").isNotNull()).count() == 0


def test_model_store_counts_finished_versions_only(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(2 * i)) for i in range(60)], "a double, y double")
    path = str(tmp_path / "store")
    assert fc.model_versions(path) == []
    with pytest.raises(FileNotFoundError):
        fc.load_model(path)
    first = fc.load_or_train(path, df, ["a"], "y", rounds=2)
    want = [r.prediction for r in fc.score(first, df).collect()]
    # a run that broke off: half a folder, no manifest
    os.makedirs(os.path.join(path, "version-broken", "metadata"))
    assert len(fc.model_versions(path)) == 1
    assert [r.prediction for r in fc.score(fc.load_or_train(path, df, ["a"], "y", rounds=9), df).collect()] == want
    # two runs that store at the same time have a version each; the later one is loaded
    second = fc.fit_gbt(df, ["a"], "y", rounds=3)
    version = fc.save_model(second, path)
    assert fc.model_versions(path)[-1] == version and len(fc.model_versions(path)) == 2
    assert fc.load_model(path).stages[-1].getNumTrees == 3
    # a finished version that can't be read is an error, not a reason to train
    import shutil
    shutil.rmtree(os.path.join(path, f"version-{version}"))
    with pytest.raises(Exception):
        fc.load_or_train(path, df, ["a"], "y", rounds=2)
    assert len(fc.model_versions(path)) == 2


def test_scored_without_a_model(spark):
    from plantframe.plans import scoring
    weather = spark.createDataFrame([(1, D(2024, 6, 1) + dt.timedelta(hours=h), float(h), 50.0, None if h == 2 else 1.0) for h in range(169)],
                                    "site_id long, ts timestamp_ntz, temperature double, humidity double, wind_speed double")
    f = scoring.heat_features(weather)
    both = scoring.scored(None, f, "heat_demand_forecast")
    rows = both.features.orderBy("ts").collect()
    assert len(rows) == 672 and [r.temperature for r in rows[:5]] == [0.0, 0.25, 0.5, 0.75, 1.0] and rows[8].wind_speed == 1.0
    assert both.forecast.columns == ["site_id", "ts", "heat_demand_forecast"] and both.forecast.where("heat_demand_forecast is null").count() == 672
    starts = spark.createDataFrame([(1, D(2024, 6, 1, 5, 40))], "site_id long, start timestamp_ntz")
    holidays = spark.createDataFrame([(dt.date(2024, 6, 3),)], "date date")
    hours = scoring.consumption_features(weather, starts, holidays).orderBy("ts").collect()
    assert len(hours) == 168 and hours[0].ts == D(2024, 6, 1, 5, 40) and hours[0].temperature == 6.0 and hours[-1].temperature == 168.0
    assert {r.Holiday for r in hours if r.ts.day == 3} == {1} and {r.Holiday for r in hours if r.ts.day != 3} == {0}
    assert scoring.heat_features(weather.where("false")).collect() == []


def test_params_overrides(spark):
    p = params.with_overrides(params.default_params(spark), {"chp.P_max": 250.0, "battery_storage.initial_level": 70.0})
    row = params.flat_system_params(p).collect()[0]
    assert row["chp__P_max"] == 250.0 and row["battery_storage__initial_level"] == 70.0 and row["chp__Q_max"] == 300.0


def test_price_table_whole_cells_of_the_first_table(spark):
    cell = lambda v: f"<TD class='n'><span>{v}</span>&nbsp;</TD>"
    row = lambda v: "<TR>" + cell("a") + cell("b") + cell("c") + cell(v) + "</TR>"
    first = "".join(row(f"{h},50") for h in range(24))
    page = f"<html><TABLE id=x>{first}</TABLE><table>{row('999,0')}</table></html>"
    df = spark.createDataFrame([(page, dt.date(2024, 5, 1)), ("<table><tr><td>1</td></tr></table>" + page, dt.date(2024, 5, 2))], "html string, delivery_date date")
    got = [(r.delivery_date.day, r.hour, r.price_eur_mwh) for r in prices.extract_price_table(df).orderBy("delivery_date", "hour").collect()]
    assert got == [(1, h, h + 0.5) for h in range(24)]


def test_meter_file_with_bad_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Kopf\nDatum;Einheit\n01.05.2024 00:00;1,5\n01.05.2024 01:00;n/a\n01.05.2024 02:00;\nrubbish;1,0\n")
    got = [(r.ts.hour, r.kwh) for r in meter_csv.scan_meter_csv(spark, str(tmp_path)).orderBy("ts").collect()]
    assert got == [(0, 1.5), (2, None)]
    n = meter_csv.meter_reject_counts(spark, str(tmp_path)).collect()[0]
    assert (n.rows, n.rejected, n.bad_values, n.preamble) == (2, 2, 1, 2)


def test_readings_begin_after_the_header(spark, tmp_path):
    """A line like a reading above the header is none; a second header and a file without one change nothing."""
    (tmp_path / "site_1.csv").write_bytes("\ufeffKopf\r\n01.01.2023 00:00;99999\r\n\r\nDatum;Wert;Einheit\r\n01.05.2024 00:00;\"1,5\";kWh\r\n".encode())
    (tmp_path / "site_2.csv").write_text("01.01.2023 00:00;1\nDatum;Einheit\n01.05.2024 00:00;2\nDatum;Einheit\n01.05.2024 01:00;3\n")
    (tmp_path / "site_3.csv").write_text("01.01.2023 00:00;1\n01.01.2023 01:00;1\n")
    (tmp_path / "site_4.csv").write_text("")
    got = sorted((r.site_id, r.ts.hour, r.kwh) for r in meter_csv.scan_meter_csv(spark, str(tmp_path), r"site_(\d)").collect())
    assert got == [("1", 0, 1.5), ("2", 0, 2.0), ("2", 1, 3.0)]
    counts = {r.file[-5]: (r.rows, r.rejected, r.preamble) for r in meter_csv.meter_reject_counts(spark, str(tmp_path)).collect()}
    assert counts == {"1": (1, 0, 3), "2": (2, 1, 2), "3": (0, 0, 2)}
    assert [(r.line, r.bad_value) for r in meter_csv.meter_rejects(spark, str(tmp_path)).collect()] == [("Datum;Einheit", False)]


@pytest.mark.parametrize("split", [64, 200, 1 << 20])
def test_files_are_read_in_splits(spark, tmp_path, split):
    """The header may lie in any split; each split knows from which of its lines the data begins."""
    row = lambda d, h: f"{d:02d}.05.2024 {h:02d}:00;{d},{h}"
    for site, above in ((1, 1), (2, 30)):
        head = [row(1 + i % 28, 0) for i in range(above)] + ["Datum;Einheit"]
        (tmp_path / f"site_{site}.csv").write_text("\n".join(head + [row(d, h) for d in range(1, 29) for h in range(24)]) + "\n")
    (tmp_path / "pv_3.csv").write_text("\n".join([row(1, 0)] * 3 + [row(d, 5) for d in range(1, 29)]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = meter_csv.scan_meter_csv(spark, [str(tmp_path / f"site_{s}.csv") for s in (1, 2)], r"site_(\d)")
        if split == 200:
            assert meter_csv.read_lines(spark, str(tmp_path / "site_2.csv")).select("block").distinct().count() > 10
        per_site = {r.site_id: (r.n, r.lo, r.total) for r in read.groupBy("site_id").agg(F.count("kwh").alias("n"), F.min("ts").alias("lo"), F.round(F.sum("kwh"), 4).alias("total")).collect()}
        # a filter on the site must not change how the files are split
        assert read.where("site_id = '2'").count() == 28 * 24
        pv = meter_csv.scan_pv_csv(spark, str(tmp_path / "pv_3.csv"), r"pv_(\d)").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert per_site["1"] == per_site["2"] and per_site["1"][:2] == (28 * 24, D(2024, 5, 1))
    assert len(pv) == 28 and {r.ts.hour for r in pv} == {5}


def _prices(spark, *pages):
    df = spark.createDataFrame([(i, p, dt.date(2024, 5, 1)) for i, p in enumerate(pages)], "page long, html string, delivery_date date")
    out = {}
    for r in prices.extract_price_table(df, keep=("page",)).orderBy("page", "hour").collect():
        out.setdefault(r.page, []).append(r.price_eur_mwh)
    return out


def test_price_table_with_tables_inside(spark):
    """Inner tables belong to the first table: in a cell of a narrow row, in a wide row, two levels deep."""
    row = lambda v: f"<tr><td>a</td><td>b</td><td>c</td><td>{v}</td></tr>"
    inner = "<table>" + "".join(row(h) for h in range(1, 12)) + "</table>"
    tail = "".join(row(h) for h in range(12, 30))
    one_cell = f"<table><tr><td>x {inner}</td></tr>{tail}</table><table>{row(999)}</table>"
    wide = f"<table><tr><td>1</td><td>2</td><td>{inner}</td><td>0,5</td></tr>{tail}</table>"
    deep = f"<table><tr><td><table><tr><td>{inner}</td></tr></table></td></tr>{tail}</table>"
    got = _prices(spark, one_cell, wide, deep)
    # a row around an inner table has its cells too: its last cell is the inner table's last, or its own behind it
    assert got[0] == [11.0, *map(float, range(1, 24))]
    assert got[1] == [0.5, *map(float, range(1, 24))]
    assert got[2] == [11.0, 11.0, *map(float, range(1, 23))]


def test_price_table_without_end_tags_and_with_entities(spark):
    cells = lambda v: f"<td>a<td>b<td><b>c</b><td> <i>{v}</i>&nbsp;"
    loose = "<TABLE>" + "".join(f"<TR>{cells(f'{h}&#44;5')}" for h in range(25)) + "</TABLE>"
    hidden = "<script>var t = '<table><tr><td>1</td></tr></table>'</script><!-- <table></table> -->" + loose
    odd = "<table>" + "".join(f"<tr><td>a</td><td>b</td><td>c</td><td>{v}</td></tr>" for v in ["&#45;3&#46;5", "+4", "1.234,5", "12d", "NaN", "1e2", "", "&#x37;", ".5", "5."]) \
        + "".join(f"<tr><td>a</td><td>b</td><td>c</td><td>{h}</td></tr>" for h in range(30)) + "</table>"
    got = _prices(spark, loose, hidden, odd, None, "", "no table at all", "<table><table></table>")
    assert got[0] == got[1] == [h + 0.5 for h in range(24)]
    assert got[2][:7] == [-3.5, 4.0, 100.0, 7.0, 0.5, 5.0, 0.0] and set(got) == {0, 1, 2}


def test_price_source_fallback_cases(spark):
    day = lambda d: dt.date(2024, 1, d)
    src = [(1, day(1), "a", 2, h, 1.0) for h in range(24)] + [(1, day(1), "b", 1, h, 2.0) for h in range(24)]  # the better of two complete ones
    src += [(1, day(2), "a", 1, h, 1.0) for h in range(25)] + [(1, day(2), "b", 2, h, 2.0) for h in range(24)]  # too many rows are not complete
    src += [(1, day(3), "a", 1, h, 1.0) for h in range(3)] + [(1, day(4), "a", 1, h, 1.0) for h in range(24)]  # day 4 was not asked for, but has prices
    df = spark.createDataFrame(src, "site_id long, day date, source string, priority int, hour long, price_ct double")
    days = spark.createDataFrame([(1, day(d)) for d in (1, 2, 3, 3)] + [(2, day(1))], "site_id long, day date")
    got = prices.price_source_fallback(df, days).groupBy("site_id", "day", "source").agg(F.count("*").alias("n"), F.countDistinct("hour").alias("hours")).collect()
    assert {(r.site_id, r.day.day, r.source, r.n, r.hours) for r in got} == {(1, 1, "b", 24, 24), (1, 2, "b", 24, 24), (1, 3, "default", 24, 24), (1, 4, "a", 24, 24), (2, 1, "default", 24, 24)}


def test_sink_replaces_the_days_it_has(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double")
    path, read = str(tmp_path / "sink"), lambda: sorted((r.ts.day, r.v) for r in sinks.read_sink(spark, path, committed=True).collect())
    with pytest.raises(FileNotFoundError):
        sinks.read_sink(spark, path, committed=True)
    sinks.sink_series(frame([(1, D(2024, 1, 1), 1.0), (1, D(2024, 1, 1, 5), 1.5)]), path)
    first = sinks.commit_id(spark, path)
    sinks.sink_series(frame([(1, D(2024, 1, 2), 2.0)]), path)
    assert read() == [(1, 1.0), (1, 1.5), (2, 2.0)] and sinks.commit_id(spark, path) != first
    kept = sorted(os.listdir(tmp_path / "sink" / "date=2024-01-01"))
    sinks.sink_series(frame([(1, D(2024, 1, 2), 9.0)]), path)  # the same day again
    assert read() == [(1, 1.0), (1, 1.5), (2, 9.0)] and sorted(os.listdir(tmp_path / "sink" / "date=2024-01-01")) == kept
    # a write that fails leaves the old rows, in a partitioned sink and in one without partitions
    bad = frame([(1, D(2024, 1, 2), 3.0), (1, D(2024, 1, 3), 0.0)]).withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    before = sinks.commit_id(spark, path)
    with pytest.raises(Exception, match="broken"):
        sinks.sink_series(bad, path)
    assert read() == [(1, 1.0), (1, 1.5), (2, 9.0)] and sinks.commit_id(spark, path) == before
    plain = str(tmp_path / "plain")
    sinks.sink_series(frame([(1, D(2024, 1, 2), 9.0)]).drop("ts"), plain, "json")
    with pytest.raises(Exception, match="broken"):
        sinks.sink_series(bad.drop("ts"), plain, "json")
    sinks.sink_series(frame([(2, D(2024, 1, 2), 7.0)]).drop("ts"), f"{plain}/", "json")
    assert [tuple(r) for r in sinks.read_sink(spark, plain, "json", "site_id long, v double").collect()] == [(2, 7.0)]


CUT = '{"hourly": {"time": ["2024-01-01T00:00", "2024-0'


def test_bad_payloads_are_counted(spark):
    good = json.dumps({"hourly": {"time": ["2024-01-01T00:00", "not a time"], "temperature_2m": [1.5, 2.0]}})
    texts = [good, CUT, None, "[]", "", json.dumps({"error": True}), json.dumps({"hourly": {"time": [], "temperature_2m": []}}),
             json.dumps({"hourly": {"time": ["2024-01-01T02:00"]}}), json.dumps({"hourly": {"time": ["2024-01-01T03:00"], "temperature_2m": ["x"]}})]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, payload string")
    seen = Observation()
    rows = payloads.flatten_series_payload(df, ["temperature_2m"], keep=("id",), counts=seen).collect()
    assert sorted((r.id, r.ts.hour, r.temperature) for r in rows) == [(0, 0, 1.5), (7, 2, None)]
    assert seen.get == {"payloads": 9, "rejects": 6}
    rejects = payloads.payload_rejects(df, "series", keep=("id",), variables=["temperature_2m"]).collect()
    assert sorted((r.id, r.reason) for r in rejects) == [(1, "not json"), (2, "missing"), (3, "other shape"), (4, "not json"), (5, "other shape"), (8, "other shape")]


def test_bad_holiday_and_price_payloads(spark):
    day = {"date": "2024-01-01", "global": True, "counties": None}
    texts = [json.dumps([day]), json.dumps([day])[:-3], json.dumps({"date": 1}), json.dumps([]), json.dumps([{**day, "date": "soon"}, {"date": "2024-05-01"}])]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, payload string")
    assert [(r.id, r.date) for r in payloads.holiday_dates(df, keep=("id",)).collect()] == [(0, dt.date(2024, 1, 1))]
    assert sorted((r.id, r.reason) for r in payloads.payload_rejects(df, "holidays", keep=("id",)).collect()) == [(1, "not json"), (2, "other shape")]
    item = {"date": "2024-01-01T00:00", "value": 80.0, "region": "AT", "resolution": "PT60M"}
    texts = [json.dumps([item]), json.dumps({"data": [item]}), json.dumps({"data": [item]})[:-4], json.dumps({"prices": []}), json.dumps({"data": []}), "null", json.dumps([{**item, "date": None}])]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, payload string")
    seen = Observation()
    assert sorted((r.id, r.price) for r in payloads.flatten_price_json(df, keep=("id",), counts=seen).collect()) == [(0, 80.0), (1, 80.0)]
    assert seen.get["rejects"] == 3
    assert sorted((r.id, r.reason) for r in payloads.payload_rejects(df, "prices", keep=("id",)).collect()) == [(2, "not json"), (3, "other shape"), (5, "other shape")]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_arrays_of_payloads_become_rows_without_a_second_parse(spark):
    """No filter over parsed text: it would be pushed below the aggregate that payloads are made from, and parse for each raw row."""
    raw = spark.createDataFrame([(1, 2024), (1, 2024), (2, None)], "site_id long, year int")
    text = F.when(F.col("year").isNotNull(), F.format_string('[{"date":"%d-05-01","global":true},{"date":"x","global":true}]', F.col("year")))
    dates = payloads.holiday_dates(raw.select("site_id", "year").distinct().select("site_id", text.alias("payload")), keep=("site_id",))
    assert not [line for line in _plan(dates).splitlines() if "Filter" in line and ("from_json" in line or "FromJson" in line or "jsontostructs" in line.lower())]
    assert [(r.site_id, str(r.date)) for r in dates.collect()] == [(1, "2024-05-01")]
    series_text = F.lit('{"hourly":{"time":["2024-01-01T00:00",null],"temperature_2m":[1.5]}}')
    rows = payloads.flatten_series_payload(raw.select("site_id").distinct().select("site_id", series_text.alias("payload")), ["temperature_2m"], keep=("site_id",))
    assert not [line for line in _plan(rows).splitlines() if "Filter" in line and "from_json" in line.lower()]
    assert sorted((r.site_id, r.temperature) for r in rows.collect()) == [(1, 1.5), (2, 1.5)]


def test_a_price_page_is_folded_once(spark):
    page = lambda n: "<table>" + "".join(f"<tr><td>{i}</td><td>a</td><td>b</td><td>{i},5</td></tr>" for i in range(n)) + "</table>"
    df = spark.createDataFrame([(1, page(25)), (2, page(23)), (3, None)], "page long, html string").withColumn("delivery_date", F.lit("2024-01-02").cast("date"))
    out = prices.extract_price_table(df, keep=("page",))
    assert _plan(out).count("aggregate(") == 1
    assert [(r.page, r.hour, r.price_eur_mwh) for r in out.orderBy("page", "hour").collect()] == [(1, h, h + 0.5) for h in range(24)]
