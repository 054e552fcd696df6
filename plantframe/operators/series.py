"""Time-series shaping (T1–T11, J5): resample, grids, interpolation, as-of
alignment, fills and per-site limits.

All ordered scans go through ``chunks`` so that a site is never a single
task; limits use ``row_number() <= n`` which Spark plans as a partial
``WindowGroupLimit`` before the shuffle (top-k per site, skew-safe).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantframe.operators import chunks
from plantframe.operators.chunks import CHUNK, _as_list


def _interval(every: str) -> Column:
    return F.expr(f"INTERVAL {every}")


# ------------------------------------------------------------------ T1 / T2
def resample_mean(df: DataFrame, every: str, cols: Sequence[str] | str, *, site: str = "site_id",
                  ts: str = "ts", count_col: str | None = None) -> DataFrame:
    """Left-closed, left-labelled tumbling mean; only non-empty bins.

    ``groupBy(site, window(ts, every))`` — partial aggregation runs map-side,
    so only one row per (site, bin, task) is shuffled.
    """
    cols = _as_list(cols)
    aggs = [F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in cols]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return (df.groupBy(site, F.window(ts, every).start.alias(ts)).agg(*aggs))


_UNITS_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
             "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_micros(every: str) -> int:
    """'15 minutes' / '1 hour' / '1 day' -> microseconds."""
    num, unit = every.strip().split()
    unit = unit.lower().rstrip("s")
    return int(float(num) * _UNITS_US[unit])


def time_grid(bounds: DataFrame, every: str, *, site: str = "site_id", start: str = "start",
              end: str = "end", ts: str = "ts") -> DataFrame:
    """Regular stamps from ``start`` to ``end`` (inclusive) per site.

    Expanded in two steps: the days, which are dealt to tasks by (site, day),
    then the stamps within each day.
    """
    days = _grid_days(bounds, every, site, start, end)
    return days.select(site, F.explode("__stamps").alias(ts))


def _grid_days(bounds: DataFrame, every: str, site: str, start: str = "start", end: str = "end") -> DataFrame:
    """site, start, end, __day and the array of the day's stamps, dealt by (site, __day)."""
    step_us = interval_micros(every)
    days = bounds.select(site, start, end, F.explode(F.sequence(
        F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY"))).alias("__day"))
    # the exchange carries sites x days rows; its partition count is given, so AQE does not merge the few
    # bytes of days into one task before the stamps of each day are made
    n = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = days.repartition(n, site, "__day")
    gap = F.expr(f"timestampdiff(MICROSECOND, {start}, cast(__day as timestamp_ntz))")
    k = F.greatest(F.lit(0), F.ceil(gap / F.lit(float(step_us)))).cast("long")
    first = F.expr(f"timestampadd(MICROSECOND, __k * {step_us}, {start})")
    last = F.least(F.col(end), F.expr("timestampadd(MICROSECOND, 86399999999, cast(__day as timestamp_ntz))"))
    return days.withColumn("__k", k).select(
        site, start, end, "__day", F.when(first <= last, F.sequence(first, last, _interval(every))).otherwise(F.array()).alias("__stamps"))


def time_grid_periods(starts: DataFrame, periods: int, every: str, *, site: str = "site_id",
                      start: str = "start", ts: str = "ts", keep: Sequence[str] = ()) -> DataFrame:
    """T3 variant: ``periods`` stamps from ``start`` (date_range(start, periods, freq)); ``keep``: further columns of a site."""
    step_us = interval_micros(every)
    return starts.select(site, start, *keep, F.explode(F.sequence(F.lit(0), F.lit(periods - 1))).alias("step")) \
        .select(site, *keep, F.col("step").cast("long").alias("step"),
                F.expr(f"timestampadd(MICROSECOND, step * {step_us}, {start})").alias(ts))


def bounds(df: DataFrame, *, site: str = "site_id", ts: str = "ts") -> DataFrame:
    return df.groupBy(site).agg(F.min(ts).alias("start"), F.max(ts).alias("end"))


def resample_mean_dense(df: DataFrame, every: str, cols: Sequence[str] | str, *,
                        site: str = "site_id", ts: str = "ts", chunk: str = "day") -> DataFrame:
    """T1, then every bin between the first and last non-empty bin, then T4."""
    cols = _as_list(cols)
    sparse = resample_mean(df, every, cols, site=site, ts=ts)
    grid = time_grid(bounds(sparse, site=site, ts=ts), every, site=site, ts=ts)
    dense = grid.join(sparse, [site, ts], "left")
    # the grid is regular, so time-weighted equals position-weighted interpolation
    return interpolate_linear(dense, cols, site=site, ts=ts, chunk=chunk, by="time")


# ---------------------------------------------------------------------- T4
def interpolate_linear(df: DataFrame, cols: Sequence[str] | str, *, site: str = "site_id",
                       ts: str = "ts", chunk: str = "day", by: str = "position") -> DataFrame:
    """T4: linear interpolation between known points (pandas ``interpolate('linear')``).

    ``by="position"`` weights by row position (the pandas rule for any
    series); ``by="time"`` weights by elapsed time, which is the same thing
    on a regular grid and skips the positional index.  Leading gaps stay
    NULL; trailing gaps repeat the last known value; known points are
    unchanged.  The nearest known neighbours come from one chunked scan.
    """
    cols = _as_list(cols)
    base = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})
    if CHUNK not in base.columns:
        base = chunks.with_chunk(base, ts, chunk)
    if by == "position":
        base = chunks.positional_index(base, site, ts, pos="__pos")
        x = F.col("__pos").cast("double")
    elif by == "time":
        base = base.withColumn("__pos", F.timestamp_diff("MICROSECOND", F.lit("2000-01-01 00:00:00")
                                                         .cast("timestamp_ntz"), F.col(ts)))
        x = F.col("__pos").cast("double")
    else:
        raise ValueError(by)
    # carry (x, value) as the packed payload
    packed = base.withColumns({f"__pv_{c}": F.when(F.col(c).isNotNull(), F.struct(
        F.col("__pos").cast("double").alias("p"), F.col(c).alias("x"))) for c in cols})
    pv = [f"__pv_{c}" for c in cols]
    both = chunks.fill_scan(packed, site, ts, pv, "both", prev_prefix="__P", next_prefix="__N")
    out = {}
    for c in cols:
        p, n = F.col(f"__P__pv_{c}.v"), F.col(f"__N__pv_{c}.v")
        frac = (x - p.p) / (n.p - p.p)
        interp = F.when(n.isNull() | (n.p == p.p), p.x).otherwise(p.x + (n.x - p.x) * frac)
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(interp)
    res = both.withColumns(out)
    drop = [CHUNK, "__pos"] + [f"__pv_{c}" for c in cols] + [f"__P__pv_{c}" for c in cols] + \
        [f"__N__pv_{c}" for c in cols]
    return res.drop(*drop)


# ---------------------------------------------------------------------- T5
def upsample_linear(df: DataFrame, every: str, cols: Sequence[str] | str, *, site: str = "site_id",
                    ts: str = "ts", chunk: str = "day") -> DataFrame:
    """T5: put a coarse series on a finer grid (first to last stamp) and interpolate.

    A day's stamps meet its points as arrays, one row per (site, day).  Only the points, and the first stamp of a day that
    has none there, are shuffled and scanned; the stamps between two of them are made last, each from its neighbours' values.
    A site's first and last stamp are taken from the days' points, so that ``df`` (parsed answers, say) is made once: both
    readings of ``points`` are one shuffle.
    """
    cols = _as_list(cols)
    step_us = interval_micros(every)
    placed = df.select(site, ts, *cols, F.to_date(ts).alias("__day")).where(F.col(site).isNotNull() & F.col("__day").isNotNull())
    points = placed.groupBy(site, "__day").agg(F.collect_list(F.struct(F.col(ts).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])).alias("__points"))
    stamps_of = F.transform("__points", lambda p: p["t"])
    ends = points.groupBy(site).agg(F.min(F.array_min(stamps_of)).alias("start"), F.max(F.array_max(stamps_of)).alias("end"))
    days = _grid_days(ends, every, site)
    off = lambda p: F.pmod(F.timestamp_diff("MICROSECOND", F.col("start"), p["t"]), F.lit(step_us))
    kind = points.schema["__points"].dataType.simpleString()
    known = F.coalesce(F.filter("__points", lambda p: off(p) == 0), F.array().cast(kind))
    unknown = lambda t: F.struct(t.alias("t"), *[F.lit(None).cast(df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(cols)])
    met = days.join(points, [site, "__day"], "left").select(site, F.col("__day").alias("__day"), F.slice("__stamps", 1, 1).alias("__first"), F.try_element_at("__stamps", F.lit(-1)).alias("__last"), known.alias("__known"))
    rows = met.select(site, "__day", "__last", F.explode_outer(F.concat("__known", F.transform(F.array_except("__first", F.transform("__known", lambda p: p["t"])), unknown))).alias("__row"))
    value = lambda c: F.when(~F.isnan(c), c)
    coarse = rows.where(F.col("__row").isNotNull()).select(site, "__day", F.col("__row.t").alias(ts), "__last", *[value(F.col(f"__row.c{i}")).alias(c) for i, c in enumerate(cols)])
    coarse = coarse.withColumn(CHUNK, F.col("__day") if chunk == "day" else chunks.chunk_expr(ts, chunk))
    position = lambda t: F.timestamp_diff("MICROSECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), t).cast("double")
    coarse = coarse.withColumns({f"__pv_{c}": F.when(F.col(c).isNotNull(), F.struct(position(F.col(ts)).alias("p"), F.col(c).alias("x"))) for c in cols})
    coarse = coarse.withColumn("__next", F.lead(ts).over(Window.partitionBy(site, CHUNK if chunk == "day" else "__day").orderBy(ts)))
    both = chunks.fill_scan(coarse, site, ts, [f"__pv_{c}" for c in cols], "both", inclusive=False, prev_prefix="__P", next_prefix="__N")
    # the stamps after a point, up to the next one or the end of the day
    first = F.expr(f"timestampadd(MICROSECOND, {step_us}, `{ts}`)")
    last = F.coalesce(F.expr(f"timestampadd(MICROSECOND, -{step_us}, __next)"), F.col("__last"))
    stamps = F.concat(F.array(F.col(ts)), F.when(first <= last, F.sequence(first, last, _interval(every))).otherwise(F.array().cast("array<timestamp_ntz>")))
    fine = both.select(site, F.col(ts).alias("__at"), F.explode(stamps).alias(ts), *cols,
                       *[F.coalesce(f"__pv_{c}", F.col(f"__P__pv_{c}.v")).alias(f"__p{i}") for i, c in enumerate(cols)], *[F.col(f"__N__pv_{c}.v").alias(f"__n{i}") for i, c in enumerate(cols)])

    def between(i: int, c: str) -> Column:
        p, n = F.col(f"__p{i}"), F.col(f"__n{i}")
        frac = (position(F.col(ts)) - p.p) / (n.p - p.p)
        line = F.when(n.isNull() | (n.p == p.p), p.x).otherwise(p.x + (n.x - p.x) * frac)
        return F.when((F.col("__at") == F.col(ts)) & F.col(c).isNotNull(), F.col(c)).otherwise(line).alias(c)

    return fine.select(site, ts, *[between(i, c) for i, c in enumerate(cols)])


# ---------------------------------------------------------------- T6 / J5
def align_nearest(targets: DataFrame, series: DataFrame, cols: Sequence[str] | str, *,
                  site: str = "site_id", ts: str = "ts", chunk: str = "day") -> DataFrame:
    """For every target stamp, the values of the nearest series stamp.

    Ties go to the later stamp; targets before the first / after the last
    stamp take the edge value (pandas ``reindex(method='nearest')``).
    Implemented as union + chunked prev/next scans: no theta join, no row
    blow-up, one shuffle on (site, chunk).
    """
    cols = _as_list(cols)
    tcols = [c for c in targets.columns]
    t = targets.withColumn("__kind", F.lit(1))
    payload = F.struct(F.col(ts).alias("t"), *[F.col(c).alias(c) for c in cols])
    s = series.select(site, ts, payload.alias("__row")).withColumn("__kind", F.lit(0))
    u = t.withColumn("__row", F.lit(None).cast(s.schema["__row"].dataType)) \
        .unionByName(s, allowMissingColumns=True)
    u = chunks.with_chunk(u, ts, chunk)
    u = chunks.fill_scan(u, site, [ts, "__kind"], "__row", "both", prev_prefix="__P", next_prefix="__N")
    p, n = F.col("__P__row.v"), F.col("__N__row.v")
    dp = F.expr(f"timestampdiff(MICROSECOND, __P__row.v.t, {ts})")
    dn = F.expr(f"timestampdiff(MICROSECOND, {ts}, __N__row.v.t)")
    pick = F.when(p.isNull(), n).when(n.isNull(), p).when(dn <= dp, n).otherwise(p)
    res = u.filter(F.col("__kind") == 1).withColumn("__pick", pick)
    return res.select(*tcols, *[F.col("__pick").getField(c).alias(c) for c in cols],
                      F.col("__pick.t").alias("matched_ts"))


# ---------------------------------------------------------------------- T7
def fill_forward_backward(df: DataFrame, cols: Sequence[str] | str, *, site: str = "site_id",
                          ts: str = "ts", chunk: str = "day") -> DataFrame:
    """Forward fill, then back-fill the leading gap, per column."""
    cols = _as_list(cols)
    base = chunks.with_chunk(df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols}), ts, chunk)
    both = chunks.fill_scan(base, site, ts, cols, "both", prev_prefix="__P", next_prefix="__N")
    res = both.withColumns({c: F.coalesce(F.col(f"__P{c}.v"), F.col(f"__N{c}.v")) for c in cols})
    return res.drop(CHUNK, *[f"__P{c}" for c in cols], *[f"__N{c}" for c in cols])


# ----------------------------------------------------------------- T8–T10
def _ranked(df: DataFrame, site: str, order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(site).orderBy(*order))


def first_n(df: DataFrame, n: int, *, site: str = "site_id", ts: str = "ts",
            pos: str = "pos") -> DataFrame:
    """First ``n`` rows per site (``head(n)``); ``pos`` is 0-based."""
    r = _ranked(df, site, [F.col(ts)])
    return df.withColumn("__rn", r).filter(F.col("__rn") <= n) \
        .withColumn(pos, (F.col("__rn") - 1).cast("long")).drop("__rn")


def slice_rows(df: DataFrame, offset: int, n: int, *, site: str = "site_id", ts: str = "ts",
               pos: str = "pos") -> DataFrame:
    """Rows ``[offset, offset + n)`` by position per site."""
    r = _ranked(df, site, [F.col(ts)])
    return df.withColumn("__rn", r).filter(F.col("__rn") <= offset + n) \
        .filter(F.col("__rn") > offset).withColumn(pos, (F.col("__rn") - 1).cast("long")).drop("__rn")


def last_n(df: DataFrame, n: int, *, site: str = "site_id", ts: str = "ts",
           pos: str = "pos_from_end") -> DataFrame:
    """Last ``n`` rows per site; ``pos_from_end`` 0 is the newest row."""
    r = _ranked(df, site, [F.col(ts).desc()])
    return df.withColumn("__rn", r).filter(F.col("__rn") <= n) \
        .withColumn(pos, (F.col("__rn") - 1).cast("long")).drop("__rn")


# --------------------------------------------------------------------- T11
def sort_series(df: DataFrame, *, site: str = "site_id", ts: str = "ts") -> DataFrame:
    """Global order by (site, ts) — range-partitioned sort, no single task."""
    return df.orderBy(site, ts)


def with_position(df: DataFrame, *, site: str = "site_id", ts: str = "ts", pos: str = "pos",
                  chunk: str = "day", with_count: str | None = None) -> DataFrame:
    """0-based position per site (skew-safe), used by W6/W7/J6."""
    base = chunks.with_chunk(df, ts, chunk)
    return chunks.positional_index(base, site, ts, pos=pos, with_count=with_count).drop(CHUNK)
