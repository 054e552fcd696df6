"""S9 ``sink_series``: write forecasts, schedules and plans.

Sinks write one folder per day by default, so a later read of some days prunes
to their folders; a folder per site would be millions of tiny files at scale and
stays an option (``partition_by``).  Writing replaces the folders that it has
rows for and leaves all others: a day that runs again replaces that day.  Files are
written beside the sink and moved when all tasks are done, so a write that fails
leaves the old rows; a sink without partitions is written whole beside the old one
and takes its place at the end.  Each finished write leaves a marker, and
``read_sink`` can ask for one.  Paths must be on shared storage
on a cluster — use ``session.scratch_path`` (under ``spark.checkpoint.dir``)
for intermediates, never a machine-local folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FORMATS = {"csv", "json", "parquet"}
#: A finished write's marker; names that begin with ``_`` are never read as data.
MARKER = "_committed-"


def _folder(spark: SparkSession, path: str):
    """File system and path of a folder, through Hadoop, whatever the storage."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def sink_series(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] | None = None,
                mode: str = "overwrite", cluster_by: tuple[str, ...] | None = ("site_id", "ts"),
                num_partitions: int | None = None) -> None:
    """Write ``df`` under ``path``, one folder per ``partition_by`` value (None: per ``date`` of ``ts``, if there is one).

    ``mode`` ``overwrite`` replaces the folders that ``df`` has rows for, all others stay; without
    partitions it replaces the sink.  Rows are first range-partitioned on ``cluster_by`` (site, then time):
    each write task gets a contiguous slice, so a site lands in one or a few
    files instead of one file per task, and a site with a huge share of the
    rows is cut by time across several tasks rather than written by one.
    """
    if fmt not in _FORMATS:
        raise ValueError(fmt)
    spark = df.sparkSession
    if cluster_by and all(c in df.columns for c in cluster_by):
        # an explicit count keeps the write parallel (AQE would coalesce small ranges into few writers)
        n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *cluster_by)
    if partition_by is None:
        partition_by = ("date",) if "ts" in df.columns else ()
        df = df.withColumn("date", F.to_date("ts")) if partition_by else df
    path = path.rstrip("/")
    beside = None if partition_by or mode != "overwrite" else f"{path}_new_{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists" if beside else mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    w.format(fmt).save(beside or path)
    if beside:
        _replace(spark, beside, path)
    _mark(spark, path)


def sink_bucketed(df: DataFrame, table: str, path: str, keys: tuple[str, ...] = ("site_id", "ts"), buckets: int = 32) -> DataFrame:
    """Write ``df`` as a table in ``buckets`` by a hash of ``keys``, and read it back.

    Tables of the same keys and number of buckets are joined on them without a
    shuffle; a hot site lies in all buckets, as its stamps do.  One file per bucket.
    """
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def _replace(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another, which is kept until the new one stands."""
    fs, source = _folder(spark, new)
    _, target = _folder(spark, path)
    _, old = _folder(spark, f"{path}_old_{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"could not move {new} to {path}")
    if had:
        fs.delete(old, True)


def _mark(spark: SparkSession, path: str) -> None:
    fs, marker = _folder(spark, f"{path}/{MARKER}{uuid.uuid4().hex}")
    fs.create(marker, True).close()
    # the new marker stands before the old ones go
    for status in fs.listStatus(marker.getParent()):
        name = status.getPath().getName()
        if name.startswith(MARKER) and name != marker.getName():
            fs.delete(status.getPath(), False)


def commit_id(spark: SparkSession, path: str) -> str | None:
    """Name of the last finished write of a sink, or None: a reader sees a new name after each write."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return None
    return max((s.getPath().getName()[len(MARKER):] for s in fs.listStatus(folder) if s.getPath().getName().startswith(MARKER)), default=None)


def read_sink(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, committed: bool = False) -> DataFrame:
    """Rows of a sink; with ``committed`` a sink without a finished write is an error."""
    if committed and commit_id(spark, path) is None:
        raise FileNotFoundError(f"{path}: no finished write")
    r = spark.read
    if schema:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return r.format(fmt).load(path)
