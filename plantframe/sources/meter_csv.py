"""S1 ``scan_meter_csv`` and S2 ``scan_forecast_csv``.

Meter exports are ``;``-separated text with a free preamble, a header line
containing ``Einheit`` and rows ``dd.MM.yyyy HH:mm;1,25[;…]``; the PV variant has a
preamble of three lines and no header.  Data begins after the header (or
the three lines): a reading-like line above it is no reading.

Files stay splittable.  Each line gets its place within its file's split (a
running number, as the lines of a split come in order); a summary per split (its
lines, its first header) is scanned per file to find from which line each
split holds data, and joined back on (file, split).  The summary has a row per
split, and no key of the join holds more than one split, however large a file is.

Lines after the preamble that do not parse are rejects, which
``meter_rejects`` returns and ``meter_reject_counts`` counts.  A file without a header has
no data lines.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantframe.functions import profiles

METER_FORMAT = "dd.MM.yyyy HH:mm"
#: The word of a meter export's header line, and the lines above a PV export's data.
HEADER_WORD = "Einheit"
PV_PREAMBLE = 3


def parse_stamp(c: Column, fmt: str = METER_FORMAT) -> Column:
    """Strict parse to TIMESTAMP_NTZ; NULL for anything that is not a stamp."""
    valid = F.try_to_timestamp(F.trim(c), F.lit(fmt)).isNotNull()
    return F.when(valid, F.to_timestamp_ntz(F.trim(c), F.lit(fmt)))


def parse_decimal_comma(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), ",", ".").try_cast("double")


def parse_meter_frame(raw: DataFrame, c0: str = "c0", c1: str = "c1", keep: tuple[str, ...] = (),
                      ts: str = "ts", value: str = "kwh") -> DataFrame:
    """Raw split lines -> (keep…, ts, kwh) for lines that parse.

    An empty value beside a valid stamp is a gap and stays as NULL; a value
    that is not a number makes the line a reject.
    """
    out = raw.select(*keep, parse_stamp(F.col(c0)).alias(ts), parse_decimal_comma(F.col(c1)).alias(value), bad_value(F.col(c1)).alias("__bad"))
    return out.filter(F.col(ts).isNotNull() & ~F.col("__bad")).drop("__bad")


def bad_value(c: Column) -> Column:
    """True for text that is neither empty nor a number."""
    return F.coalesce((F.trim(c) != "") & parse_decimal_comma(c).isNull(), F.lit(False))


def split_lines(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines -> c0, c1 (first two ``;`` fields, without quotes)."""
    parts = F.split(F.col(line), ";")
    return lines.select(*keep, *[F.btrim(F.get(parts, i), F.lit("\" ")).alias(f"c{i}") for i in range(2)])


def read_lines(spark: SparkSession, paths: str | list[str], site_pattern: str | None = None, site_field: int | None = None,
               streaming: dict | None = None) -> DataFrame:
    """Non-empty text lines with path, site_id, and their split (file, block).

    ``site_pattern``: a regular expression with one group over the path; ``site_field``:
    the field of the line that names the site; else the path is the site.
    """
    reader = spark.readStream.options(**streaming) if streaming is not None else spark.read
    path = F.col("_metadata.file_path")
    line = F.regexp_replace("value", "^\ufeff|\r$", "")
    raw = reader.text(paths).select(path.alias("path"), F.xxhash64(path).alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"))
    if site_field is not None:
        site = F.get(F.split("line", ";"), F.lit(site_field))
    else:
        site = F.regexp_extract("path", site_pattern, 1) if site_pattern else F.col("path")
    return raw.withColumn("site_id", site)


def _runs(batches: Iterator, word: str):
    """Batches with each line's number within its split, and whether an earlier line of the split has the word."""
    import numpy as np
    import pyarrow.compute as pc

    last, n, seen = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        has = pc.fill_null(pc.match_substring(batch.column("line"), word), False).to_numpy(zero_copy_only=False)
        new = np.ones(len(file), bool)
        new[1:] = (file[1:] != file[:-1]) | (block[1:] != block[:-1])
        same = last == (file[0], block[0])
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        number = np.arange(len(file)) - first[run]
        before = np.cumsum(has) - has
        earlier = before - before[first][run]
        if same:
            number[run == 0] += n
            earlier[run == 0] += seen
        last, n, seen = (file[-1], block[-1]), int(number[-1]) + 1, int(earlier[-1] + has[-1])
        yield batch, number, earlier > 0, has, first


def _numbered(word: str):
    import pyarrow as pa

    def run(batches):
        for batch, number, after, _, _ in _runs(batches, word):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(after)], names=[*batch.schema.names, "number", "after"])

    return run


def _summary(word: str):
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch, number, after, has, first in _runs(batches, word):
            end = np.append(first[1:], len(number)) - 1
            header = np.where(has & ~after, number, np.iinfo(np.int64).max)
            header = np.minimum.reduceat(header, first)
            take = pa.array(first)
            yield pa.RecordBatch.from_arrays([batch.column("file").take(take), batch.column("block").take(take), pa.array(number[end] + 1),
                                              pa.array(header, mask=header == np.iinfo(np.int64).max)], names=["file", "block", "lines", "header"])

    return run


def data_lines(lines: DataFrame, *, header: str | None = HEADER_WORD, skip: int = 0) -> DataFrame:
    """The lines with ``data``: true after the first line of their file that contains ``header``, or after its first ``skip`` lines."""
    word = header or HEADER_WORD
    splits = lines.select("file", "block", "line").mapInArrow(_summary(word), "file long, block long, lines long, header long") \
        .groupBy("file", "block").agg(F.max("lines").alias("lines"), F.min("header").alias("header"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    if header is None:
        start = F.greatest(F.lit(skip) - F.coalesce(F.sum("lines").over(earlier), F.lit(0)), F.lit(0))
    else:
        start = F.when(F.max("header").over(earlier).isNotNull(), F.lit(0)).otherwise(F.col("header") + 1)
    starts = splits.select("file", "block", start.alias("start"))
    numbered = lines.mapInArrow(_numbered(word), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema) + ", number long, after boolean")
    # an inner join loses nothing: every split with a line has a summary
    return numbered.join(starts, ["file", "block"]).withColumn("data", F.coalesce(F.col("number") >= F.col("start"), F.lit(False))).drop("number", "after", "start")


def _not_blank() -> Column:
    return F.trim("line") != ""


def _readings(lines: DataFrame) -> DataFrame:
    return parse_meter_frame(split_lines(lines.where(F.col("data")), keep=("site_id",)), keep=("site_id",))


def scan_meter_csv(spark: SparkSession, paths: str | list[str], site_pattern: str | None = None, site_field: int | None = None) -> DataFrame:
    """Readings (site_id, ts, kwh) of meter export files: the lines after the header that parse."""
    return _readings(data_lines(read_lines(spark, paths, site_pattern, site_field)))


def scan_pv_csv(spark: SparkSession, paths: str | list[str], site_pattern: str | None = None, site_field: int | None = None) -> DataFrame:
    """PV export variant (3 preamble lines, no header, same row format) -> (site_id, ts, pv_kw)."""
    lines = data_lines(read_lines(spark, paths, site_pattern, site_field), header=None, skip=PV_PREAMBLE)
    return _readings(lines).withColumnRenamed("kwh", "pv_kw")


def meter_rejects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines after the header that are no reading: path, line, and whether they have a stamp but no number."""
    lines = data_lines(read_lines(spark, paths)).where(F.col("data") & _not_blank())
    parts = split_lines(lines, keep=("path", "line"))
    stamp = parse_stamp(F.col("c0")).isNotNull()
    return parts.where(~stamp | bad_value(F.col("c1"))).select("path", "line", stamp.alias("bad_value"))


def meter_reject_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file: data rows read, lines rejected, how many of those had a stamp but no number, and lines of the preamble (header included).

    A file without a header is all preamble.
    """
    lines = data_lines(read_lines(spark, paths)).where(_not_blank())
    parts = split_lines(lines, keep=("path", "data"))
    stamp, bad = parse_stamp(F.col("c0")).isNotNull(), bad_value(F.col("c1"))
    return parts.groupBy(F.col("path").alias("file")).agg(
        F.count_if(F.col("data") & stamp & ~bad).alias("rows"), F.count_if(F.col("data") & (~stamp | bad)).alias("rejected"),
        F.count_if(F.col("data") & stamp & bad).alias("bad_values"), F.count_if(~F.col("data")).alias("preamble"))


def stream_meter_lines(spark: SparkSession, path: str, site_pattern: str | None = None, **options) -> DataFrame:
    """Readings of files that arrive.  A stream has no summary of a file, so its header must be in the file's first split (128 MB)."""
    lines = read_lines(spark, path, site_pattern, streaming=options)
    numbered = lines.mapInArrow(_numbered(HEADER_WORD), "path string, file long, block long, line string, site_id string, number long, after boolean")
    return _readings(numbered.withColumn("data", F.col("after") | (F.col("block") > 0)))


# ------------------------------------------------------------------------ S2
FORECAST_TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def scan_forecast_csv(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """Headered forecast CSV (``timestamp,<values>``) with an explicit schema.

    ``value_schema`` is a DDL list of the value columns, e.g.
    ``"heat_demand double"``.  The stamp keeps microseconds as TIMESTAMP_NTZ.
    """
    raw = spark.read.option("header", True).schema(f"timestamp string, {value_schema}").csv(path)
    return raw.withColumn("ts", F.to_timestamp_ntz(F.col("timestamp"), F.lit(FORECAST_TS_FORMAT))) \
        .drop("timestamp")


def with_profile_fallback(base: DataFrame, observed: DataFrame | None, kind: str = "weather", *,
                          site: str = "site_id", ts: str = "ts") -> DataFrame:
    """Values from ``observed`` where present, else the default profile.

    Left join on the base stamps + ``coalesce`` — a missing file (``None``)
    simply means every row takes the profile.
    """
    if kind == "weather":
        cols = ["temperature", "solar_irradiance", "humidity"]
    elif kind == "control":
        cols = profiles.CONTROL_COLUMNS
    else:
        raise ValueError(kind)
    out = base
    if observed is not None:
        out = out.join(observed.select(site, ts, *[F.col(c).alias(f"__o_{c}") for c in cols]), [site, ts], "left")
    h = F.hour(F.col(ts))
    if kind == "weather":
        dflt = {"temperature": profiles.weather_temperature(h), "solar_irradiance": profiles.weather_irradiance(h),
                "humidity": F.lit(profiles.DEFAULT_HUMIDITY)}
    else:
        dflt = profiles.control_columns(h)
    if observed is None:
        return out.withColumns(dflt)
    return out.withColumns({c: F.coalesce(F.col(f"__o_{c}"), dflt[c]) for c in cols}) \
        .drop(*[f"__o_{c}" for c in cols])
