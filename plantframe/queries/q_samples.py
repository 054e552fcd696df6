"""W1–W11 over the test tables.

Window samples are arrays of a day of hours; the checked output has one row
per window element, so the oracle sees every value in its place.  The readings
have gaps (``_hourly``): a NULL target keeps its place in a window.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.operators import samples
from plantframe.queries.common import R4, register, round_doubles

RD, HR = cat.SQL_READINGS, cat.SQL_HOURLY
W = cat.with_sql
WIN = 24


def _hourly(spark, d):
    return cat.hourly(spark, d).select("site_id", "ts", "kwh", F.col("n").cast("double").alias("n"))


def _gaps(spark, d):
    """Hourly values with a NULL target at 07:00 on some sites."""
    return _hourly(spark, d).withColumn("kwh", F.when((F.pmod("site_id", F.lit(5)) == 0) & (F.hour("ts") == 7), F.lit(None)).otherwise(F.col("kwh")))


def _scaled(spark, d):
    """The same with both features also scaled to 0..1 per site."""
    h = _gaps(spark, d).withColumns({"kwh_s": F.col("kwh"), "n_s": F.col("n")})
    return samples.minmax_scale(h, ["kwh_s", "n_s"])


def _elements(df, array, *rest):
    """One row per window element: k from 0 (the oldest) on."""
    return df.select("site_id", "anchor_ts", F.col("anchor_pos").cast("long").alias("anchor_pos"), F.posexplode(array).alias("k", "e"), *rest) \
        .withColumn("k", F.col("k").cast("long"))


_GW = HR + ", hw AS (SELECT site_id, ts, CASE WHEN site_id % 5 = 0 AND hour(ts) = 7 THEN NULL ELSE kwh END AS kwh, CAST(n AS DOUBLE) AS n, " \
    "row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY site_id) AS cnt FROM hourly), " \
    f"ks AS (SELECT unnest(range(0, {WIN})) AS k), anchors AS (SELECT site_id, ts AS anchor_ts, pos AS anchor_pos, cnt, kwh AS y, n AS n_now FROM hw WHERE pos >= {WIN}), " \
    f"past AS (SELECT a.*, ks.k, p.kwh, p.n FROM anchors a CROSS JOIN ks JOIN hw p ON p.site_id = a.site_id AND p.pos = a.anchor_pos - {WIN} + ks.k)"
_SCALE = "CASE WHEN max({c}) OVER s <> min({c}) OVER s THEN ({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s) WHEN {c} IS NOT NULL THEN 0.0::DOUBLE END AS {c}_s"
_GW_SCALED = _GW.replace("ks AS (", f"sw AS (SELECT site_id, pos, {_SCALE.format(c='kwh')}, {_SCALE.format(c='n')} FROM hw WINDOW s AS (PARTITION BY site_id)), ks AS (")
_KEYS = "past.site_id, past.anchor_ts, CAST(past.anchor_pos AS BIGINT) AS anchor_pos, CAST(past.k AS BIGINT) AS k"
_WBASE = HR + ", hw AS (SELECT site_id, ts, kwh, CAST(n AS DOUBLE) AS n, " \
    "row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY site_id) AS cnt FROM hourly)"


# ---------------------------------------------------------------------- W1
@register("seq_to_seq_windows", W(_GW) + f"SELECT {_KEYS}, {R4('past.kwh')} AS x_kwh, {R4('past.n')} AS x_n, {R4('f.kwh')} AS y, f.ts AS y_ts "
          "FROM past JOIN hw f ON f.site_id = past.site_id AND f.pos = past.anchor_pos + past.k "
          f"WHERE past.anchor_pos <= past.cnt - {WIN}")
def q_seq2seq(spark, d):
    out = samples.seq_to_seq_windows(_gaps(spark, d), ["kwh", "n"], "kwh", WIN)
    rows = _elements(out, F.arrays_zip("x", "y", "y_ts"))
    return round_doubles(rows.select("site_id", "anchor_ts", "anchor_pos", "k", F.col("e.x.kwh").alias("x_kwh"), F.col("e.x.n").alias("x_n"),
                                     F.col("e.y").alias("y"), F.col("e.y_ts").alias("y_ts")))


# ---------------------------------------------------------------------- W2
@register("feature_windows_next", W(_GW_SCALED) + f"SELECT {_KEYS}, {R4('sw.kwh_s')} AS x_kwh, {R4('sw.n_s')} AS x_n, {R4('past.y')} AS y FROM past "
          f"JOIN sw ON sw.site_id = past.site_id AND sw.pos = past.anchor_pos - {WIN} + past.k")
def q_feature_windows(spark, d):
    rows = _elements(samples.feature_windows_next(_scaled(spark, d), ["kwh_s", "n_s"], "kwh", WIN), "x", "y")
    return round_doubles(rows.select("site_id", "anchor_ts", "anchor_pos", "k", F.col("e.kwh_s").alias("x_kwh"), F.col("e.n_s").alias("x_n"), "y"))


# ---------------------------------------------------------------------- W3
@register("lag_windows_next", W(_GW) + "SELECT site_id, anchor_ts, CAST(anchor_pos AS BIGINT) AS anchor_pos, "
          + ", ".join(f"{R4(f'max(CASE WHEN k = {WIN - k} THEN kwh END)')} AS lag_{k}" for k in range(1, WIN + 1))
          + f", {R4('any_value(y)')} AS y FROM past GROUP BY site_id, anchor_ts, anchor_pos HAVING count(kwh) = {WIN}")
def q_lag_windows(spark, d):
    return round_doubles(samples.lag_windows_next(_gaps(spark, d), "kwh", WIN, flat=True, nulls="drop").drop("x"))


# ---------------------------------------------------------------------- W4
@register("lag_plus_current_windows", W(_GW_SCALED) + f"SELECT {_KEYS}, {R4('past.kwh')} AS x_kwh, {R4('sw.n_s')} AS x_n, {R4('past.y')} AS y FROM past "
          "JOIN sw ON sw.site_id = past.site_id AND sw.pos = past.anchor_pos")
def q_lag_plus_current(spark, d):
    rows = _elements(samples.lag_plus_current_windows(_scaled(spark, d), ["n_s"], "kwh", WIN), "x", "y")
    return round_doubles(rows.select("site_id", "anchor_ts", "anchor_pos", "k", F.col("e.kwh").alias("x_kwh"), F.col("e.n_s").alias("x_n"), "y"))


# ---------------------------------------------------------------------- W5
@register("lag_concat_current", W(_GW, f"flat AS (SELECT site_id, anchor_ts, anchor_pos, k, kwh AS x, y FROM past UNION ALL SELECT site_id, anchor_ts, anchor_pos, {WIN}, n_now, y "
                                  f"FROM anchors UNION ALL SELECT site_id, anchor_ts, anchor_pos, {WIN + 1}, hour(anchor_ts), y FROM anchors)")
          + f"SELECT site_id, anchor_ts, CAST(anchor_pos AS BIGINT) AS anchor_pos, CAST(k AS BIGINT) AS k, {R4('x')} AS x, {R4('y')} AS y FROM flat")
def q_lag_concat(spark, d):
    h = _gaps(spark, d).withColumn("hour", F.hour("ts").cast("double"))
    rows = _elements(samples.lag_concat_current(h, ["n", "hour"], "kwh", WIN), "x", "y")
    return round_doubles(rows.select("site_id", "anchor_ts", "anchor_pos", "k", F.col("e").alias("x"), "y"))


# ---------------------------------------------------------------------- W6
@register("aligned_one_to_one", W(HR, "a AS (SELECT site_id, ts, kwh, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos FROM hourly)",
                                  "b AS (SELECT site_id, ts AS right_ts, kwh AS y, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos FROM readings)")
          + f"SELECT site_id, CAST(pos AS BIGINT) AS pos, ts, {R4('kwh')} AS kwh, right_ts, {R4('y')} AS y FROM a JOIN b USING (site_id, pos)")
def q_aligned(spark, d):
    feats = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    targets = cat.readings(spark, d).select("site_id", "ts", F.col("kwh").alias("y"))
    return round_doubles(samples.aligned_one_to_one(feats, targets, "y"))


# ---------------------------------------------------------------------- W7
_SPLIT = ("CASE WHEN pos < floor(cnt * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(cnt * 0.7::DOUBLE) + floor(cnt * 0.15::DOUBLE) "
          "THEN 'val' ELSE 'test' END")


@register("chrono_split", W(_WBASE) + f"SELECT site_id, ts, {R4('kwh')} AS kwh, {_SPLIT} AS split FROM hw")
def q_chrono(spark, d):
    return round_doubles(samples.chrono_split(cat.hourly(spark, d).select("site_id", "ts", "kwh")))


# ---------------------------------------------------------------------- W8
@register("random_split", W(RD) + "SELECT site_id, event_id, CASE WHEN ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::UBIGINT % 100 < 70 "
          "THEN 'train' ELSE 'test' END AS split FROM readings")
def q_random_split(spark, d):
    return samples.random_split(cat.readings(spark, d).select("site_id", "event_id"), ["event_id"])


# ---------------------------------------------------------------------- W9
@register("minmax_scale", W(HR, "s AS (SELECT site_id, min(kwh) AS k0, max(kwh) AS k1, min(n) AS n0, max(n) AS n1 FROM hourly GROUP BY site_id)")
          + f"SELECT h.site_id, h.ts, {R4('CASE WHEN k1 <> k0 THEN (kwh - k0) / (k1 - k0) ELSE 0.0::DOUBLE END')} AS kwh, "
          f"{R4('CASE WHEN n1 <> n0 THEN (n - n0) / (n1 - n0) ELSE 0.0::DOUBLE END')} AS n FROM hourly h JOIN s USING (site_id)")
def q_minmax(spark, d):
    return round_doubles(samples.minmax_scale(_hourly(spark, d), ["kwh", "n"]))


# ---------------------------------------------------------------- W10/W11
_STD = W(_WBASE, f"sp AS (SELECT *, {_SPLIT} AS split FROM hw)",
         "st AS (SELECT site_id, avg(kwh) AS km, CASE WHEN stddev_pop(kwh) = 0 THEN 1.0::DOUBLE ELSE stddev_pop(kwh) END AS ks, "
         "avg(n) AS nm, CASE WHEN stddev_pop(n) = 0 THEN 1.0::DOUBLE ELSE stddev_pop(n) END AS ns FROM sp WHERE split = 'train' GROUP BY site_id)")


@register("standard_scale", _STD + f"SELECT sp.site_id, ts, split, {R4('(kwh - km) / ks')} AS kwh, {R4('(n - nm) / ns')} AS n "
          "FROM sp LEFT JOIN st USING (site_id)")
def q_standard(spark, d):
    h = samples.chrono_split(_hourly(spark, d))
    scaled, _ = samples.standard_scale_train(h, ["kwh", "n"])
    return round_doubles(scaled)


@register("inverse_scale_target", _STD + f"SELECT sp.site_id, ts, {R4('(kwh - km) / ks')} AS kwh_scaled, "
          f"{R4('((kwh - km) / ks) * ks + km')} AS kwh_restored FROM sp LEFT JOIN st USING (site_id)")
def q_inverse(spark, d):
    h = samples.chrono_split(_hourly(spark, d))
    scaled, stats = samples.standard_scale_train(h, ["kwh", "n"])
    back = samples.inverse_scale_target(scaled.withColumn("kwh_scaled", F.col("kwh")), stats, "kwh", out="kwh_restored")
    return round_doubles(back.select("site_id", "ts", "kwh_scaled", "kwh_restored"))
