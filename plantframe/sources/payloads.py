"""JSON payload sources (S4, S5, S7) — landed API responses read as text.

* S4 parallel-array weather payload ``{"hourly": {"time": [...], "<var>": [...]}}``
  -> one row per stamp (``inline(arrays_zip(...))``), variables renamed.
* S5 holiday list ``[{"date", "global", "counties"}]`` -> distinct dates that
  are national or include the region.
* S7 price payload, either a list of objects or ``{"data": [...]}``, with
  ``date``/``value`` aliased to ``timestamp``/``price``.

Each payload row is one API response (bounded size); exploding it is a
narrow, per-row operation.

A payload that is cut off, is no JSON or has another shape gives no rows and is a
reject: ``payload_rejects`` returns it with the reason, and the flatten
functions count good and bad payloads into an ``Observation`` where one is given. An item
without a readable date gives no row either. An error answer is a reject, not an
empty one. Payloads that are valid and empty are neither rows nor rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Weather API variable names -> our column names.
WEATHER_RENAMES = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
    "precipitation": "precipitation",
    "direct_radiation": "direct_radiation",
    "cloud_cover": "cloud_cover",
}
API_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
HOLIDAY_SCHEMA = "array<struct<date: string, global: boolean, counties: array<string>>>"
PRICE_ITEM = "struct<date: string, value: double, region: string, resolution: string>"
#: The raw text of a document that does not parse, as ``from_json`` hands it over.
CORRUPT = "_corrupt_record"
KINDS = ("series", "holidays", "prices")


def _named(variables: dict[str, str] | list[str]) -> dict[str, str]:
    return variables if isinstance(variables, dict) else {v: WEATHER_RENAMES.get(v, v) for v in variables}


def _stamp(c: Column) -> Column:
    """A stamp, or NULL where the text is none."""
    return F.try_to_timestamp(c, F.lit(API_TIME_FORMAT)).cast("timestamp_ntz")


def _parsed(kind: str, payload: str, variables: dict[str, str] | None = None) -> tuple[Column, Column]:
    """What a payload holds (an array of items, or the series' arrays), and the reason why it is a reject (NULL: none)."""
    text = F.col(payload)
    options = {"columnNameOfCorruptRecord": CORRUPT}
    cut = F.when(text.isNull(), F.lit("missing")).when(F.try_parse_json(text).isNull(), F.lit("not json"))
    if kind == "series":
        fields = ", ".join(f"`{v}`: array<double>" for v in variables)
        doc = F.from_json(text, f"struct<hourly: struct<time: array<string>, {fields}>, {CORRUPT}: string>", options)
        # a value of another type than its variable's makes the document corrupt as a whole
        return doc["hourly"], cut.when(doc["hourly"]["time"].isNull() | doc[CORRUPT].isNotNull(), F.lit("other shape"))
    if kind == "holidays":
        items = F.from_json(text, HOLIDAY_SCHEMA, options)
        return items, cut.when(~F.ltrim(text).startswith("[") | items.isNull(), F.lit("other shape"))
    if kind == "prices":
        as_list = F.from_json(text, f"array<{PRICE_ITEM}>", options)
        as_obj = F.from_json(text, f"struct<data: array<{PRICE_ITEM}>, {CORRUPT}: string>", options)
        is_list = F.ltrim(text).startswith("[")
        items = F.when(is_list, as_list).otherwise(as_obj["data"])
        return items, cut.when(items.isNull() | (~is_list & as_obj[CORRUPT].isNotNull()), F.lit("other shape"))
    raise ValueError(kind)


def _good(df: DataFrame, kind: str, payload: str, keep: tuple[str, ...], variables: dict[str, str] | None, counts: Observation | None) -> DataFrame:
    """keep… and the parsed payload ``__p`` (NULL for a reject); both kinds are counted into ``counts``."""
    parsed, why = _parsed(kind, payload, variables)
    # a reject holds nothing rather than being filtered out, and arrays become rows by outer generators, whose empty row is dropped
    # behind them: a filter (a plain generator adds one) would be pushed below, there to make and parse the text again for each raw row
    out = df.select(*keep, F.when(why.isNull(), parsed).alias("__p"), *([why.alias("__why")] if counts is not None else []))
    if counts is not None:
        out = out.observe(counts, F.count(F.lit(1)).alias("payloads"), F.count("__why").alias("rejects")).drop("__why")
    return out


def payload_rejects(df: DataFrame, kind: str, *, payload: str = "payload", keep: tuple[str, ...] = (),
                    variables: dict[str, str] | list[str] | None = None) -> DataFrame:
    """The payloads that give no rows because they can't be read: keep…, reason (missing, not json, other shape) and their length."""
    _, why = _parsed(kind, payload, _named(variables) if variables is not None else {})
    return df.select(*keep, why.alias("reason"), F.length(payload).cast("long").alias("chars")).where(F.col("reason").isNotNull())


# ---------------------------------------------------------------------- S4
def flatten_series_payload(df: DataFrame, variables: dict[str, str] | list[str], *, payload: str = "payload",
                           keep: tuple[str, ...] = (), ts: str = "ts", counts: Observation | None = None) -> DataFrame:
    """Parallel arrays -> rows.  ``variables``: API name -> column name (or a list of API names)."""
    variables = _named(variables)
    good = _good(df, "series", payload, keep, variables, counts)
    zipped = F.when(F.col("__p").isNotNull(), F.arrays_zip(F.col("__p.time").alias("time"),
                    *[F.coalesce(F.col(f"__p.`{v}`"), F.array().cast("array<double>")).alias(v) for v in variables]))
    rows = good.select(*keep, F.inline_outer(zipped))
    return rows.select(*keep, _stamp(F.col("time")).alias(ts), *[F.col(v).alias(name) for v, name in variables.items()]).where(F.col(ts).isNotNull())


def read_series_payloads(spark: SparkSession, paths: str | list[str], variables, counts: Observation | None = None) -> DataFrame:
    """Landed weather responses (one JSON document per file)."""
    raw = spark.read.text(paths, wholetext=True).withColumnRenamed("value", "payload")
    raw = raw.withColumn("source_file", F.col("_metadata.file_path"))
    return flatten_series_payload(raw, variables, keep=("source_file",), counts=counts)


# ---------------------------------------------------------------------- S5
def holiday_dates(df: DataFrame, region: str | Column = "DE-SH", *, payload: str = "payload",
                  keep: tuple[str, ...] = (), counts: Observation | None = None) -> DataFrame:
    """Dates that are national holidays or holidays in ``region`` (a code, or a
    column holding each row's code); distinct over all payloads."""
    reg = region if isinstance(region, Column) else F.lit(region)
    good = _good(df.withColumn("__region", reg), "holidays", payload, (*keep, "__region"), None, counts)
    items = good.select(*keep, "__region", F.explode_outer("__p").alias("h"))
    sel = items.filter(F.coalesce(F.col("h.global"), F.lit(False)) | F.coalesce(F.array_contains("h.counties", F.col("__region")), F.lit(False)))
    return sel.select(*keep, F.try_to_timestamp(F.col("h.date"), F.lit("yyyy-MM-dd")).cast("date").alias("date")).where("date is not null").distinct()


# ---------------------------------------------------------------------- S7
def flatten_price_json(df: DataFrame, *, payload: str = "payload", keep: tuple[str, ...] = (),
                       region: str | None = None, start: str | None = None, end: str | None = None,
                       resolution: str | None = None, counts: Observation | None = None) -> DataFrame:
    """List or ``{"data": [...]}`` -> rows (timestamp, price, region, resolution) + predicates."""
    rows = _good(df, "prices", payload, keep, None, counts).select(*keep, F.inline_outer("__p"))
    rows = rows.withColumnsRenamed({"date": "timestamp", "value": "price"})
    rows = rows.withColumn("timestamp", _stamp(F.col("timestamp"))).where(F.col("timestamp").isNotNull())
    if region is not None:
        rows = rows.filter(F.col("region") == region)
    if start is not None:
        rows = rows.filter(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.filter(F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))
    if resolution is not None:
        rows = rows.filter(F.col("resolution") == resolution)
    return rows
