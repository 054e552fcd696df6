"""Structured Streaming ingestion: arriving meter files -> watermarked hourly means."""

import datetime as dt
import os
import tempfile

from plantframe.streaming import meter_stream

D = dt.datetime


def _write(d, name, lines):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write("Zählpunkt;X\nDatum;Wert;Einheit\n" + "\n".join(lines) + "\n")


def test_stream_hourly_means(spark):
    src = tempfile.mkdtemp(prefix="pf-stream-src-")
    out = tempfile.mkdtemp(prefix="pf-stream-out-") + "/hourly"
    ckpt = tempfile.mkdtemp(prefix="pf-stream-ckpt-")
    _write(src, "site_1_a.csv", ["01.01.2024 00:15;1,0;kWh", "01.01.2024 00:45;3,0;kWh", "01.01.2024 01:30;5,0;kWh"])
    _write(src, "site_1_b.csv", ["01.01.2024 06:00;7,0;kWh"])
    _write(src, "site_2_a.csv", ["01.01.2024 00:10;2,0;kWh", "01.01.2024 09:00;4,0;kWh"])
    readings = meter_stream.meter_stream(spark, src, site_pattern=r"site_(\d+)_")
    q = meter_stream.start_sink(meter_stream.resample_stream(readings, "1 hour", "2 hours"), out, checkpoint=ckpt)
    q.awaitTermination(120)
    got = {(str(r.site_id), r.ts): (r.kwh, r.n) for r in spark.read.parquet(out).collect()}
    # bins closed by the watermark (max stamp 09:00 minus 2 h) are emitted; later ones stay open
    assert got[("1", D(2024, 1, 1, 0))] == (2.0, 2)
    assert got[("1", D(2024, 1, 1, 1))] == (5.0, 1)
    assert got[("2", D(2024, 1, 1, 0))] == (2.0, 1)
    assert ("2", D(2024, 1, 1, 9)) not in got
