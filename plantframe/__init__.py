"""plantframe — energy-plant time-series analytics on Spark.

Lazy ``DataFrame -> DataFrame`` operators keyed by ``site_id``:

* ``sources``    meter CSV, forecast CSV, parameters, weather/holiday/price payloads, HTML prices, sinks
* ``functions``  column expressions (calendar, solar, tariff, plant physics, dispatch rules, profiles)
* ``operators``  skew-safe ordered scans, time series, samples, joins, ledgers, audits, metrics
* ``plans``      plan columns, MLlib forecasts, the end-to-end batch pipeline
* ``streaming``  incremental meter ingestion
"""

__version__ = "0.1.0"
