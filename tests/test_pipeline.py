"""End-to-end batch run: readings -> forecast -> dispatch -> plan -> KPIs, as one plan."""

import tempfile

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.plans import pipeline
from plantframe.queries.q_sources import holidays_from_data


def test_pipeline_end_to_end(spark, sf_small):
    readings = cat.readings(spark, sf_small).select("site_id", "ts", "kwh")
    out = tempfile.mkdtemp(prefix="pf-pipeline-")
    res = pipeline.run(readings, holidays_from_data(spark, sf_small), horizon=24, rounds=3, sink_path=out)
    n_sites = readings.select("site_id").distinct().count()
    assert res.forecast.count() == 24 * n_sites
    assert res.plan.count() == 24 * n_sites
    s = res.summary.agg(F.count(F.lit(1)).alias("n"), F.min("total_heat_supplied").alias("h")).collect()[0]
    assert s.n == n_sites and s.h > 0
    # every planned step starts strictly after the site's last reading
    last = readings.groupBy("site_id").agg(F.max("ts").alias("last"))
    assert res.plan.join(last, "site_id").filter(F.col("ts") <= F.col("last")).count() == 0
    assert res.kpis.count() >= n_sites
    assert spark.read.json(out + "/summary").count() == n_sites
