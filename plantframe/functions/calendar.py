"""Calendar projections and predicates.

All are built-in column functions on TIMESTAMP_NTZ, independent of the
session time zone, and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------- P1
def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, day_of_week (Monday = 0), month, is_weekend (Saturday/Sunday)."""
    dow = F.weekday(F.col(ts))
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": dow,
        "month": F.month(ts),
        "is_weekend": F.when(dow >= 5, F.lit(1)).otherwise(F.lit(0)),
    })


# ---------------------------------------------------------------------- P2
def iso_day_number(ts) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(_c(ts)) + F.lit(1)


# ---------------------------------------------------------------------- P3
def iso_week(ts) -> Column:
    return F.weekofyear(_c(ts))


# ---------------------------------------------------------------------- P4
def day_part(hour) -> Column:
    """Six 4-hour parts of the day: 0–3 → 0 … 20–23 → 5."""
    return F.floor(_c(hour) / F.lit(4)).cast("int")


# ---------------------------------------------------------------------- P5
# Temperature bins [-inf, 0), [0, 10), [10, 20), [20, inf) and their names.
TEMP_EDGES = [0.0, 10.0, 20.0]
TEMP_NAMES = ["Very Cold", "Cold", "Normal", "Hot"]


def temp_category_code(temp) -> Column:
    t = _c(temp)
    t = F.when(~F.isnan(t), t)
    return (F.when(t.isNull(), F.lit(None).cast("int"))
            .when(t < TEMP_EDGES[0], F.lit(0)).when(t < TEMP_EDGES[1], F.lit(1))
            .when(t < TEMP_EDGES[2], F.lit(2)).otherwise(F.lit(3)))


def temp_category_name(temp) -> Column:
    t = _c(temp)
    t = F.when(~F.isnan(t), t)
    return (F.when(t.isNull(), F.lit(None).cast("string"))
            .when(t < TEMP_EDGES[0], F.lit(TEMP_NAMES[0])).when(t < TEMP_EDGES[1], F.lit(TEMP_NAMES[1]))
            .when(t < TEMP_EDGES[2], F.lit(TEMP_NAMES[2])).otherwise(F.lit(TEMP_NAMES[3])))


# ---------------------------------------------------------------------- P6
def holiday_flag(df: DataFrame, holidays: DataFrame, ts: str = "ts", date_col: str = "date",
                 out: str = "holiday") -> DataFrame:
    """1 if the row's date is in the holiday set.

    The join strategy is left to Spark, which knows the caller's table's size.
    """
    h = holidays.select(F.col(date_col).alias("__hday")).distinct().withColumn("__hflag", F.lit(1))
    return (df.join(h, F.to_date(F.col(ts)) == F.col("__hday"), "left")
            .withColumn(out, F.coalesce(F.col("__hflag"), F.lit(0))).drop("__hday", "__hflag"))


# ---------------------------------------------------------------------- P9
def local_to_utc(ts, tz: str = "Europe/Berlin") -> Column:
    """Naive local stamp in ``tz`` -> naive UTC stamp."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts))


def utc_to_local(ts, tz: str = "Europe/Berlin") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))


# --------------------------------------------------------------------- P10
# Final feature lists and their column order per model family.
CONSUMPTION_FEATURES = ["day", "temp_category_int", "day_time", "month", "Holiday", "temperature", "is_weekend"]
PV_FEATURES = ["azimuth", "altitude", "week", "hour", "direct_radiation", "cloud_cover"]
HEAT_FEATURES = ["temperature", "humidity", "wind_speed", "hour", "day_of_week", "is_weekend"]


def feature_frame(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
                  target: str | None = None) -> DataFrame:
    """Select keys + features (+ target) in the model's column order; drop rows with any NULL/NaN.

    Incomplete rows are left out of an array rather than filtered: a filter would be pushed below
    the aggregates that the features are made from, and make every feature again for each raw row.
    """
    values = list(features) + ([target] if target else [])
    out = df.select(*keep, *values)

    def known(row: Column) -> Column:
        cond = F.lit(True)
        for c in values:
            cond = cond & row[c].isNotNull()
            if out.schema[c].dataType.simpleString() in ("double", "float"):
                cond = cond & ~F.isnan(row[c])
        return cond

    return out.select(*keep, F.inline(F.filter(F.array(F.struct(*values)), known)))


# --------------------------------------------------------------------- P23
def horizon_filter(df: DataFrame, from_date: str, ts: str = "ts") -> DataFrame:
    """Rows whose date is on/after ``from_date``, written as a range on the raw
    stamp so the predicate reaches the Parquet scan."""
    return df.filter(F.col(ts) >= F.lit(from_date).cast("date").cast("timestamp_ntz"))


# --------------------------------------------------------------------- P24
# Plan series -> report names used by the dashboard.
REPORT_NAMES = {
    "thermal_level": "storage",
    "thermal_charge": "charge",
    "thermal_discharge": "discharge",
    "heat_pump_heat": "heat_pump_usage",
    "electric_heater_heat": "electric_heater_usage",
}


def report_columns(df: DataFrame, ts: str = "ts") -> DataFrame:
    """``HH:mm`` label, ISO date string, plan series renamed to report names."""
    present = {k: v for k, v in REPORT_NAMES.items() if k in df.columns}
    return (df.withColumnsRenamed(present)
            .withColumns({"time_label": F.date_format(ts, "HH:mm"),
                          "date_label": F.date_format(ts, "yyyy-MM-dd")}))
