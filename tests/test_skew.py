"""A site holding most of the rows must not become one task in the ordered scans."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantframe.operators import chunks, ledger, series

D = dt.datetime


@pytest.fixture()
def skewed(spark):
    rnd = random.Random(0)
    rows = []
    for m in range(0, 60 * 24 * 60, 10):            # hot site: one reading every 10 minutes for 60 days
        rows.append((0, D(2024, 1, 1) + dt.timedelta(minutes=m), rnd.choice([None, rnd.uniform(0, 100)])))
    for s in range(1, 9):                            # eight small sites
        for m in range(0, 60 * 24 * 60, 360):
            rows.append((s, D(2024, 1, 1) + dt.timedelta(minutes=m), rnd.uniform(0, 100)))
    df = spark.createDataFrame(rows, "site_id long, ts timestamp_ntz, v double")
    # the plan a large table gets: no coalescing of small partitions, no runtime broadcast of the steps
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield df
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_site_spreads_over_partitions(skewed):
    base = chunks.with_chunk(skewed, "ts", "day")
    out = chunks.fill_scan(base, "site_id", "ts", "v", "both").withColumn("pid", F.spark_partition_id())
    hot = out.filter(F.col("site_id") == 0)
    assert hot.select("pid").distinct().count() >= 8
    assert hot.count() == 60 * 24 * 6


def test_hot_site_results_equal_plain_window(skewed):
    got = series.fill_forward_backward(skewed, "v")
    w = Window.partitionBy("site_id").orderBy("ts")
    ref = skewed.withColumn("v", F.coalesce(
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing))))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_hot_site_ledger_spreads(skewed):
    df = skewed.withColumn("battery_charge", F.coalesce("v", F.lit(0.0)) / 2).withColumn("battery_discharge", F.lit(5.0))
    led = ledger.battery_ledger(df).withColumn("pid", F.spark_partition_id())
    assert led.filter(F.col("site_id") == 0).select("pid").distinct().count() >= 8


@pytest.mark.parametrize("name", ["minmax", "standard", "inverse", "params"])
def test_hot_site_joins_spread(skewed, name):
    """Rows meet their site's statistics or parameters in many tasks, and no row is lost or doubled."""
    from plantframe.operators import samples
    from plantframe.sources import params

    stats = samples.standard_fit(skewed, ["v"])
    own = skewed.select("site_id").distinct().withColumn("p", F.col("site_id") * 2)
    out = {"minmax": lambda: samples.minmax_scale(skewed, ["v"]), "standard": lambda: samples.standard_apply(skewed, stats, ["v"]),
           "inverse": lambda: samples.inverse_scale_target(skewed, stats, "v"), "params": lambda: params.params_cross(skewed, own)}[name]().withColumn("pid", F.spark_partition_id())
    assert out.filter(F.col("site_id") == 0).select("pid").distinct().count() >= 8
    assert out.count() == skewed.count()
    if name == "params":
        assert out.where("p is null or p <> site_id * 2").count() == 0
    if name == "minmax":
        assert tuple(out.where("site_id = 0").agg(F.min("v"), F.max("v")).first()) == (0.0, 1.0)


def test_spread_join_keeps_rows_without_a_match(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 2.0), (None, 3.0)], "site_id long, v double")
    per = spark.createDataFrame([(1, "a"), (None, "n")], "site_id long, w string")
    got = sorted(map(str, chunks.spread_join(df, per, ["site_id"]).collect()))
    assert len(got) == 4 and sum("w='a'" in r for r in got) == 2 and sum("w=None" in r for r in got) == 2
    assert chunks.spread_join(df.select("site_id"), per, ["site_id"], how="inner").count() == 2
