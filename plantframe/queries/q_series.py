"""T1–T11 and J5 over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.operators import series
from plantframe.queries.common import R4, register, round_doubles

RD = cat.SQL_READINGS
HR = cat.SQL_HOURLY
W = cat.with_sql

# readings with the 'error' events' values blanked — gaps to fill
SQL_GAPPY = RD + ", gappy AS (SELECT site_id, event_id, ts, CASE WHEN event_type <> 'error' THEN kwh END AS kwh FROM readings)"


def _gappy(spark, d):
    r = cat.readings(spark, d)
    return r.select("site_id", "event_id", "ts", F.when(F.col("event_type") != "error", F.col("kwh")).alias("kwh"))


def _sql_interp(src: str, order: str = "ts") -> str:
    """Positional linear interpolation of ``kwh`` in DuckDB (prev/next known by position)."""
    return (f"pos_t AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY {order}) - 1 AS pos FROM {src}), "
            "known AS (SELECT *, "
            "last_value(CASE WHEN kwh IS NOT NULL THEN pos END IGNORE NULLS) OVER w1 AS pp, "
            "last_value(kwh IGNORE NULLS) OVER w1 AS pv, "
            "first_value(CASE WHEN kwh IS NOT NULL THEN pos END IGNORE NULLS) OVER w2 AS np, "
            "first_value(kwh IGNORE NULLS) OVER w2 AS nv FROM pos_t "
            "WINDOW w1 AS (PARTITION BY site_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            "w2 AS (PARTITION BY site_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), "
            "interp AS (SELECT *, CASE WHEN kwh IS NOT NULL THEN kwh WHEN np IS NULL OR np = pp THEN pv "
            "ELSE pv + (nv - pv) * ((pos - pp) / (np - pp)) END AS kwh_i FROM known)")


# ---------------------------------------------------------------------- T1
@register("resample_mean_sparse", W(HR) + f"SELECT site_id, ts, {R4('kwh')} AS kwh, CAST(n AS BIGINT) AS n FROM hourly")
def q_resample_sparse(spark, d):
    return round_doubles(cat.hourly(spark, d))


# ---------------------------------------------------------------------- T2
@register("resample_mean_dense", W(RD, "sparse AS (SELECT site_id, time_bucket(INTERVAL '1 hour', ts) AS ts, avg(kwh) AS kwh "
                                  "FROM readings GROUP BY ALL)",
                                  "b AS (SELECT site_id, min(ts) AS s, max(ts) AS e FROM sparse GROUP BY site_id)",
                                  "grid AS (SELECT site_id, unnest(generate_series(s, e, INTERVAL '1 hour')) AS ts FROM b)",
                                  "dense AS (SELECT g.site_id, g.ts, s.kwh FROM grid g LEFT JOIN sparse s USING (site_id, ts))",
                                  _sql_interp("dense"))
          + f"SELECT site_id, ts, {R4('kwh_i')} AS kwh FROM interp")
def q_resample_dense(spark, d):
    return round_doubles(series.resample_mean_dense(cat.readings(spark, d), "1 hour", "kwh"))


# ---------------------------------------------------------------------- T3
@register("time_grid", W(RD, "b AS (SELECT site_id, min(ts) AS s, max(ts) AS e FROM readings GROUP BY site_id)")
          + "SELECT site_id, unnest(generate_series(s, e, INTERVAL '1 hour')) AS ts FROM b")
def q_time_grid(spark, d):
    return series.time_grid(series.bounds(cat.readings(spark, d)), "1 hour")


# ---------------------------------------------------------------------- T4
@register("interpolate_linear", W(SQL_GAPPY, _sql_interp("gappy"))
          + f"SELECT site_id, event_id, ts, {R4('kwh_i')} AS kwh FROM interp")
def q_interpolate(spark, d):
    return round_doubles(series.interpolate_linear(_gappy(spark, d), "kwh"))


# ---------------------------------------------------------------------- T5
@register("upsample_linear", W(HR, "b AS (SELECT site_id, min(ts) AS s, max(ts) AS e FROM hourly GROUP BY site_id)",
                              "grid AS (SELECT site_id, unnest(generate_series(s, e, INTERVAL '30 minutes')) AS ts FROM b)",
                              "dense AS (SELECT g.site_id, g.ts, h.kwh FROM grid g LEFT JOIN hourly h USING (site_id, ts))",
                              _sql_interp("dense"))
          + f"SELECT site_id, ts, {R4('kwh_i')} AS kwh FROM interp")
def q_upsample(spark, d):
    return round_doubles(series.upsample_linear(cat.hourly(spark, d).select("site_id", "ts", "kwh"), "30 minutes", "kwh"))


# ---------------------------------------------------------------- T6 / J5
_SQL_NEAREST = (
    "p AS (SELECT r.site_id, r.event_id, r.ts, h.ts AS pts, h.kwh AS pkwh FROM readings r "
    "ASOF LEFT JOIN hourly h ON r.site_id = h.site_id AND r.ts >= h.ts), "
    "n AS (SELECT r.site_id, r.event_id, h.ts AS nts, h.kwh AS nkwh FROM readings r "
    "ASOF LEFT JOIN hourly h ON r.site_id = h.site_id AND r.ts <= h.ts), "
    "pick AS (SELECT p.site_id, p.event_id, p.ts, "
    "CASE WHEN pts IS NULL THEN nts WHEN nts IS NULL THEN pts "
    "WHEN date_diff('microsecond', p.ts, nts) <= date_diff('microsecond', pts, p.ts) THEN nts ELSE pts END AS matched_ts, "
    "CASE WHEN pts IS NULL THEN nkwh WHEN nts IS NULL THEN pkwh "
    "WHEN date_diff('microsecond', p.ts, nts) <= date_diff('microsecond', pts, p.ts) THEN nkwh ELSE pkwh END AS kwh_hourly "
    "FROM p JOIN n USING (site_id, event_id))")


@register("align_nearest", W(HR, _SQL_NEAREST)
          + f"SELECT site_id, event_id, ts, {R4('kwh_hourly')} AS kwh_hourly, matched_ts FROM pick")
def q_align_nearest(spark, d):
    targets = cat.readings(spark, d).select("site_id", "event_id", "ts")
    h = cat.hourly(spark, d).select("site_id", "ts", F.col("kwh").alias("kwh_hourly"))
    return round_doubles(series.align_nearest(targets, h, "kwh_hourly"))


@register("asof_nearest", W(cat.SQL_PLAN_INPUTS,
                            "p AS (SELECT r.site_id, r.event_id, r.ts, h.ts AS pts, h.temperature AS pt, h.heat_demand AS pd "
                            "FROM readings r ASOF LEFT JOIN plan_inputs h ON r.site_id = h.site_id AND r.ts >= h.ts)",
                            "n AS (SELECT r.site_id, r.event_id, h.ts AS nts, h.temperature AS nt, h.heat_demand AS nd "
                            "FROM readings r ASOF LEFT JOIN plan_inputs h ON r.site_id = h.site_id AND r.ts <= h.ts)",
                            "pick AS (SELECT p.site_id, p.event_id, p.ts, p.pt, p.pd, n.nt, n.nd, "
                            "(pts IS NOT NULL AND (nts IS NULL OR date_diff('microsecond', p.ts, nts) > "
                            "date_diff('microsecond', pts, p.ts))) AS use_prev FROM p JOIN n USING (site_id, event_id))")
          + f"SELECT site_id, event_id, ts, {R4('CASE WHEN use_prev THEN pt ELSE nt END')} AS temperature, "
            f"{R4('CASE WHEN use_prev THEN pd ELSE nd END')} AS heat_demand FROM pick")
def q_asof_nearest(spark, d):
    targets = cat.readings(spark, d).select("site_id", "event_id", "ts")
    weather = cat.plan_inputs(spark, d).select("site_id", "ts", "temperature", "heat_demand")
    return round_doubles(series.align_nearest(targets, weather, ["temperature", "heat_demand"]).drop("matched_ts"))


# ---------------------------------------------------------------------- T7
@register("fill_forward_backward", W(SQL_GAPPY, "f AS (SELECT *, coalesce(last_value(kwh IGNORE NULLS) OVER "
                                     "(PARTITION BY site_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
                                     "first_value(kwh IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts "
                                     "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS kwh_f FROM gappy)")
          + f"SELECT site_id, event_id, ts, {R4('kwh_f')} AS kwh FROM f")
def q_ffill(spark, d):
    return round_doubles(series.fill_forward_backward(_gappy(spark, d), "kwh"))


# ----------------------------------------------------------------- T8–T11
_RN = "r AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS rn, " \
      "row_number() OVER (PARTITION BY site_id ORDER BY ts DESC) - 1 AS rd FROM hourly)"


@register("first_n_per_site", W(HR, _RN) + f"SELECT site_id, ts, {R4('kwh')} AS kwh, CAST(n AS BIGINT) AS n, "
          "CAST(rn AS BIGINT) AS pos FROM r WHERE rn < 24")
def q_first_n(spark, d):
    return round_doubles(series.first_n(cat.hourly(spark, d), 24))


@register("slice_per_site", W(HR, _RN) + f"SELECT site_id, ts, {R4('kwh')} AS kwh, CAST(n AS BIGINT) AS n, "
          "CAST(rn AS BIGINT) AS pos FROM r WHERE rn >= 24 AND rn < 48")
def q_slice(spark, d):
    return round_doubles(series.slice_rows(cat.hourly(spark, d), 24, 24))


@register("last_n_per_site", W(HR, _RN) + f"SELECT site_id, ts, {R4('kwh')} AS kwh, CAST(n AS BIGINT) AS n, "
          "CAST(rd AS BIGINT) AS pos_from_end FROM r WHERE rd < 24")
def q_last_n(spark, d):
    return round_doubles(series.last_n(cat.hourly(spark, d), 24))


@register("sort_series", W(HR) + f"SELECT site_id, ts, {R4('kwh')} AS kwh, CAST(n AS BIGINT) AS n FROM hourly ORDER BY site_id, ts")
def q_sort(spark, d):
    return round_doubles(series.sort_series(cat.hourly(spark, d)))
