"""Spark session helpers.

Library code never creates a session on its own; callers pass one in.
``build_session`` is for tests, the bench and local runs.  On a cluster
the session comes from ``spark-submit`` and ``spark.checkpoint.dir``
names a shared folder, which ``checkpoint_dir`` reads instead of
choosing a machine-local path.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness of the operators (not tuning):
# naive local timestamps stay TIMESTAMP_NTZ end to end.
_REQUIRED = {
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "plantframe", extra: dict | None = None) -> SparkSession:
    """Local/test session.  Cluster jobs should use the session they are given."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(_DEFAULTS)
    conf.update(_REQUIRED)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; we read it
    from the session.  Only a local master falls back to a fresh scratch folder;
    on a cluster each executor would write to its own disk, so an unset folder
    is an error there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="plantframe-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - some deployments refuse runtime core confs
            pass
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
