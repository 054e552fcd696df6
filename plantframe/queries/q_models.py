"""M1–M8 and S10 over the test tables (rows-only checks: model output has no SQL oracle).

Every query trains with the library's own settings (100 rounds, a day of lags).
The input frames of the models have oracles: ``feature_frame``, ``pv_feature_frame``,
``heat_feature_frame``, ``lag_concat_current``, ``multi_horizon_frame`` and the frames to score.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import calendar, profiles, solar
from plantframe.ml_features import consumption_frame, heat_frame, pv_frame
from plantframe.operators import samples, series
from plantframe.plans import forecast as fc
from plantframe.plans import scoring
from plantframe.queries.common import R4, register, round_doubles
from plantframe.queries.q_sources import holidays_of_years, sql_holiday_values
from plantframe.session import scratch_path
from plantframe.sources import payloads

#: A day of hours, as the windows of the sample builders.
LAGS = HORIZONS = 24


def _rounded(df):
    return round_doubles(df)


def _stored(spark, df, name):
    """A frame that is read more than once (rows and error measures, say) is written once."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _with_errors(scored, label):
    """Rows with the error measures of the whole frame: mae, rmse, mape (of rows whose label is not 0)."""
    err = F.col(label) - F.col("prediction")
    one = scored.agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
                     (F.avg(F.when(F.col(label) != 0, F.abs(err / F.col(label)))) * 100).alias("mape"))
    return scored.crossJoin(F.broadcast(one))  # an aggregate without keys is one row


# ---------------------------------------------------------------------- M1
@register("gbt_consumption")
def q_gbt_consumption(spark, d):
    data = consumption_frame(spark, d)
    out = fc.score(fc.fit_gbt(data, calendar.CONSUMPTION_FEATURES, "kwh"), data)
    return _rounded(_with_errors(_stored(spark, out.select("site_id", "ts", "kwh", "prediction"), "m1"), "kwh"))


# ---------------------------------------------------------------------- M2
@register("gbt_pv")
def q_gbt_pv(spark, d):
    data = samples.random_split(pv_frame(spark, d), ["site_id", "ts"])
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    pred = fc.score(fc.fit_gbt(train, calendar.PV_FEATURES, "pv_kw", scale=False), test)
    out = _with_errors(_stored(spark, pred.select("site_id", "ts", "pv_kw", "prediction"), "m2"), "pv_kw")
    return _rounded(out.withColumn("test_mse", F.col("rmse") * F.col("rmse")))


# ---------------------------------------------------------------------- M3
def _heat_series(spark, d):
    pi = cat.plan_inputs(spark, d).select("site_id", "ts", "heat_demand", "temperature")
    return calendar.calendar_features(pi)


@register("gbt_heat_lags")
def q_gbt_heat_lags(spark, d):
    frame = fc.lag_vector_frame(_heat_series(spark, d), ["temperature", "hour", "is_weekend"], "heat_demand", LAGS)
    model = fc.fit_gbt_vector(frame, "y")
    out = model.transform(frame)
    return _rounded(out.select("site_id", "anchor_ts", "y", "prediction"))


# ---------------------------------------------------------------------- M4
@register("multi_horizon_forecast")
def q_multi_horizon(spark, d):
    h = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    horizons = HORIZONS
    train = fc.multi_horizon_frame(h, "kwh", LAGS, horizons)
    model = fc.fit_gbt_vector(train, "y", parts=("lags", "h"))
    # score from each site's latest window: the last LAGS values, oldest first
    last = series.last_n(h, LAGS).groupBy("site_id").agg(
        F.max("ts").alias("anchor_ts"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("ts", "kwh"))).alias("w"))
    lags = F.transform("w", lambda x: x["kwh"])
    grid = last.select("site_id", "anchor_ts", "n", lags.alias("lags"),
                       F.explode(F.sequence(F.lit(1), F.lit(horizons))).alias("h"))
    full = grid.filter(F.col("n") == LAGS)
    full = full.withColumn("__vec", fc.array_to_vector(F.concat("lags", F.array(F.col("h").cast("double")))))
    scored = model.transform(full).select("site_id", "anchor_ts", "h", "prediction")
    # sites with less history than one window get the constant default forecast
    short = grid.filter(F.col("n") < LAGS).select("site_id", "anchor_ts", "h", F.lit(None).cast("double").alias("prediction"))
    out = fc.fallback_short_history(scored.unionByName(short), h, LAGS)
    return _rounded(out.select("site_id", "anchor_ts", F.col("h").cast("long").alias("h"), "prediction"))


@register("multi_horizon_frame", cat.with_sql(cat.SQL_HOURLY, (
    "n AS (SELECT site_id, ts, kwh, row_number() OVER (PARTITION BY site_id ORDER BY ts) AS p, count(*) OVER (PARTITION BY site_id) AS total FROM hourly)"))
          + f"SELECT a.site_id, a.ts AS anchor_ts, CASE WHEN b.p > a.p THEN 'ahead' ELSE 'lag' END AS part, CASE WHEN b.p > a.p THEN b.p - a.p ELSE b.p - a.p + {LAGS - 1} END AS place, {R4('b.kwh')} AS v "
          f"FROM n a JOIN n b ON b.site_id = a.site_id AND b.p BETWEEN a.p - {LAGS - 1} AND a.p + {HORIZONS} WHERE a.p >= {LAGS} AND a.p < a.total")
def q_multi_horizon_frame(spark, d):
    """The training frame of M4, element by element: each anchor's lags once (oldest first) and its target of each horizon."""
    frame = fc.multi_horizon_frame(cat.hourly(spark, d).select("site_id", "ts", "kwh"), "kwh", LAGS, HORIZONS)
    element = lambda part, place, v: F.struct(F.lit(part).alias("part"), place.cast("long").alias("place"), v.alias("v"))
    lags = F.when(F.col("h") == 1, F.transform("lags", lambda x, i: element("lag", i, x))).otherwise(F.slice(F.array(element("lag", F.col("h"), F.col("y"))), 1, 0))
    rows = frame.select("site_id", "anchor_ts", F.explode(F.concat(lags, F.array(element("ahead", F.col("h"), F.col("y"))))).alias("e"))
    return _rounded(rows.select("site_id", "anchor_ts", "e.*"))


# ---------------------------------------------------------------------- M5
@register("seasonal_regression")
def q_seasonal(spark, d):
    h = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    model = fc.fit_seasonal(h, "kwh")
    starts = h.groupBy("site_id").agg(F.max("ts").alias("start"))
    return _rounded(fc.forecast_seasonal(model, starts, 24, "1 hour"))


def _sql_seasonal_terms() -> list[str]:
    share = "(days - lo) / greatest(hi - lo, 1e-9::DOUBLE)"
    out = ["1.0::DOUBLE", share] + [f"greatest({share} - {bend}::DOUBLE, 0.0::DOUBLE)" for bend in fc.BENDS]
    for _, period, k_max in fc.SEASONS:
        for k in range(1, k_max + 1):
            out += [f"{f}({2.0 * math.pi * k / period!r}::DOUBLE * days)" for f in ("sin", "cos")]
    return out


def _sql_seasonal_statistics() -> str:
    terms = _sql_seasonal_terms()
    n = len(terms)
    return cat.with_sql(cat.SQL_HOURLY, (
        "d AS (SELECT site_id, kwh, (epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-01')) / 86400000000.0::DOUBLE AS days FROM hourly), "
        "f AS (SELECT site_id, ln(1.0::DOUBLE + greatest(kwh, 0.0::DOUBLE)) AS y, min(days) OVER () AS lo, max(days) OVER () AS hi, days FROM d), "
        f"t AS (SELECT site_id, y, [{', '.join(terms)}] AS x FROM f), "
        f"s AS (SELECT site_id, count(*) AS n, [{', '.join(f'sum(x[{i}] * x[{j}])' for i in range(1, n + 1) for j in range(i, n + 1))}] AS gram, "
        f"[{', '.join(f'sum(x[{i}] * y)' for i in range(1, n + 1))}] AS moment FROM t GROUP BY site_id)"))


@register("seasonal_statistics", _sql_seasonal_statistics()
          + f"SELECT site_id, n, 'gram' AS part, place, {R4('v')} AS v FROM (SELECT site_id, n, unnest(range(len(gram))) AS place, unnest(gram) AS v FROM s) UNION ALL "
          f"SELECT site_id, n, 'moment', place, {R4('v')} FROM (SELECT site_id, n, unnest(range(len(moment))) AS place, unnest(moment) AS v FROM s)")
def q_seasonal_statistics(spark, d):
    h = cat.hourly(spark, d).select("site_id", "ts", "kwh")
    stats = fc.seasonal_statistics(h, "kwh", fc.time_span(h))
    each = F.explode(F.array(F.struct(F.lit("gram").alias("part"), F.col("gram").alias("v")), F.struct(F.lit("moment").alias("part"), F.col("moment").alias("v"))))
    rows = stats.select("site_id", "n", each.alias("e")).select("site_id", "n", "e.part", F.posexplode("e.v").alias("place", "v"))
    return _rounded(rows)


# ---------------------------------------------------------------------- M6
@register("validated_boosting")
def q_validated(spark, d):
    data = samples.chrono_split(consumption_frame(spark, d))
    train, val, test = (data.filter(F.col("split") == x) for x in ("train", "val", "test"))
    model, losses = fc.fit_validated(train, val, calendar.CONSUMPTION_FEATURES, "kwh")
    out = fc.score(model, test)
    return _rounded(out.select("site_id", "ts", "kwh", "prediction", F.lit(model.stages[-1].getNumTrees).cast("long").alias("trees"), F.lit(len(losses)).cast("long").alias("rounds")))


# ------------------------------------------------------ weather of the days to come
#: Hours of a forecast answer: a week and the midnight after it.
ANSWER_HOURS = 169


def weather_answers(spark, d):
    """A forecast answer (S4 payload) for each site: hourly from the midnight before its last reading; some temperatures are missing."""
    starts = cat.readings(spark, d).groupBy("site_id").agg(F.to_date(F.max("ts")).cast("timestamp_ntz").alias("start"))
    h = F.transform(F.sequence(F.lit(0), F.lit(ANSWER_HOURS - 1)), lambda i: F.struct(
        F.timestamp_add("HOUR", i, "start").alias("ts"), F.pmod(i, F.lit(24)).cast("double").alias("hour"), i.alias("i")))
    # an answer is some thousand times its site's row, so the few bytes of rows are dealt out before answers are made
    # (by the stamp too, as a second exchange by the same key would be left out)
    starts = starts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "site_id", "start")
    site = F.col("site_id")
    values = {
        "temperature_2m": lambda x: F.when((x["i"] > 0) & (F.pmod(x["hour"] + site, F.lit(9)) == 5), F.lit(None)).otherwise(
            profiles.weather_temperature(x["hour"]) - 12.0 + F.pmod(site, F.lit(10)) * 1.5 + x["i"] / 100.0),
        "relative_humidity_2m": lambda x: F.lit(50.0) + x["hour"],
        "wind_speed_10m": lambda x: F.lit(3.0) + F.pmod(site, F.lit(5)) + x["hour"] / 10.0,
        "direct_radiation": lambda x: profiles.weather_irradiance(x["hour"]) * (F.lit(0.5) + F.pmod(site, F.lit(5)) / 10.0),
        "cloud_cover": lambda x: F.pmod(x["i"] * 3 + site, F.lit(100)).cast("double"),
    }
    arrays = F.struct(F.transform("h", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")).alias("time"), *[F.transform("h", f).alias(n) for n, f in values.items()])
    return starts.withColumn("h", h).select("site_id", F.to_json(F.struct(arrays.alias("hourly")), {"ignoreNullFields": "false"}).alias("payload"))


def future_weather(spark, d, *variables):
    return payloads.flatten_series_payload(weather_answers(spark, d), list(variables), keep=("site_id",))


_SIN = "sin(2 * pi() * (i % 24 - 6) / 24.0::DOUBLE)"
_SQL_FUTURE = (
    "starts AS (SELECT site_id, max(ts) AS now, CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) AS day0 FROM readings GROUP BY site_id), "
    f"wx AS (SELECT site_id, day0 + i * INTERVAL 1 HOUR AS ts, i, CASE WHEN i > 0 AND (i % 24 + site_id) % 9 = 5 THEN NULL ELSE 15.0::DOUBLE + 10.0::DOUBLE * {_SIN} - 12.0::DOUBLE "
    "+ (site_id % 10) * 1.5::DOUBLE + i / 100.0::DOUBLE END AS t0, 50.0::DOUBLE + i % 24 AS humidity, 3.0::DOUBLE + site_id % 5 + (i % 24) / 10.0::DOUBLE AS wind_speed, "
    f"greatest(0.0::DOUBLE, 800.0::DOUBLE * {_SIN}) * (0.5::DOUBLE + (site_id % 5) / 10.0::DOUBLE) AS direct_radiation, ((i * 3 + site_id) % 100)::DOUBLE AS cloud_cover "
    f"FROM (SELECT site_id, day0, unnest(range({ANSWER_HOURS})) AS i FROM starts)), "
    # missing hours stand alone: the mean of their neighbours, at the end the last value
    "wt AS (SELECT *, coalesce(t0, (lag(t0) OVER w + lead(t0) OVER w) / 2.0::DOUBLE, lag(t0) OVER w) AS temperature FROM wx WINDOW w AS (PARTITION BY site_id ORDER BY i))")


# ---------------------------------------------------------------------- M7
def future_consumption_features(spark, d):
    starts = cat.readings(spark, d).groupBy("site_id").agg(F.max("ts").alias("start"))
    # holidays of the years that are scored, not of those that were read
    years = starts.select(F.explode(F.array(F.year("start"), F.year(F.timestamp_add("DAY", F.lit(7), "start")))).alias("year")).distinct()
    return scoring.consumption_features(future_weather(spark, d, "temperature_2m"), starts, holidays_of_years(years))


def _next_7_days(spark, d):
    # trained and stored by one run, loaded and applied by the next
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    fc.load_or_train(path, consumption_frame(spark, d), calendar.CONSUMPTION_FEATURES, "kwh")
    return scoring.scored(fc.load_model(path), future_consumption_features(spark, d), "electricity_consumption_forecast")


@register("score_next_7_days")
def q_next_7_days(spark, d):
    return _rounded(_next_7_days(spark, d).forecast)


_SQL_NEXT_7_DAYS = cat.with_sql(cat.SQL_READINGS, _SQL_FUTURE, (
    f"g AS (SELECT site_id, now + k * INTERVAL 1 HOUR AS ts, least({ANSWER_HOURS - 1}, (epoch_us(now + k * INTERVAL 1 HOUR) - epoch_us(day0) + 1800000000) // 3600000000) AS i "
    f"FROM (SELECT *, unnest(range({scoring.WEEK_HOURS})) AS k FROM starts)), "
    "hol AS (SELECT DISTINCT make_date(y, t.m, t.d) AS date FROM (SELECT DISTINCT year(ts) AS y FROM g) CROSS JOIN " + sql_holiday_values()
    + " WHERE t.g OR list_contains(coalesce(t.counties, []::VARCHAR[]), 'DE-SH')), "
    "ff AS (SELECT g.site_id, g.ts, isodow(g.ts) AS day, CASE WHEN temperature < 0 THEN 0 WHEN temperature < 10 THEN 1 WHEN temperature < 20 THEN 2 ELSE 3 END AS temp_category_int, "
    "hour(g.ts) // 4 AS day_time, month(g.ts) AS month, CASE WHEN EXISTS (SELECT 1 FROM hol WHERE hol.date = CAST(g.ts AS DATE)) THEN 1 ELSE 0 END AS Holiday, temperature, "
    "CASE WHEN isodow(g.ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM g JOIN wt ON wt.site_id = g.site_id AND wt.i = g.i)"))


@register("next_7_days_features", _SQL_NEXT_7_DAYS + "SELECT site_id, ts, day, temp_category_int::BIGINT AS temp_category_int, day_time, month, Holiday::BIGINT AS Holiday, "
          f"{R4('temperature')} AS temperature, is_weekend::BIGINT AS is_weekend, NULL::DOUBLE AS electricity_consumption_forecast FROM ff")
def q_next_7_days_features(spark, d):
    """Both results without a model: the features, and a forecast that is NULL."""
    both = scoring.scored(None, future_consumption_features(spark, d), "electricity_consumption_forecast")
    return _rounded(both.features.join(both.forecast, ["site_id", "ts"]))


# ---------------------------------------------------------------------- M8
def _place():
    return F.lit(47.0) + F.pmod("site_id", F.lit(8)), F.lit(6.0) + F.pmod("site_id", F.lit(9))


def future_pv_features(spark, d):
    return scoring.pv_features(future_weather(spark, d, "direct_radiation", "cloud_cover"), *_place())


@register("score_next_day_pv")
def q_next_day_pv(spark, d):
    model = fc.fit_gbt(pv_frame(spark, d), calendar.PV_FEATURES, "pv_kw", scale=False)
    return _rounded(scoring.scored(model, future_pv_features(spark, d), "pv_forecast").forecast)


_AZ, _ALT = solar.sql_sun_position("ts", "(47.0::DOUBLE + (site_id % 8))", "(6.0::DOUBLE + (site_id % 9))")


@register("next_day_pv_features", cat.with_sql(cat.SQL_READINGS, _SQL_FUTURE) + f"SELECT site_id, ts, {R4(_AZ)} AS azimuth, {R4(_ALT)} AS altitude, week(ts) AS week, hour(ts) AS hour, "
          f"{R4('direct_radiation')} AS direct_radiation, cloud_cover FROM wt WHERE i >= 24 AND i < 48")
def q_next_day_pv_features(spark, d):
    return _rounded(future_pv_features(spark, d))


# ------------------------------------------------- heat, quarter hours of the next 7 days
def future_heat_features(spark, d):
    return scoring.heat_features(future_weather(spark, d, "temperature_2m", "relative_humidity_2m", "wind_speed_10m"))


def _between(c: str) -> str:
    return f"(a.{c} + (b.{c} - a.{c}) * (q / 4.0::DOUBLE))"


@register("next_7_days_heat_features", cat.with_sql(cat.SQL_READINGS, _SQL_FUTURE, (
    # quarters lie between an hour and the next known one; after a missing hour the line goes on from the mean, which lies on it
    "qt AS (SELECT a.site_id, a.ts + q * INTERVAL 15 MINUTE AS ts, " + ", ".join(f"{_between(c)} AS {c}" for c in ("temperature", "humidity", "wind_speed"))
    + f" FROM wt a JOIN wt b ON a.site_id = b.site_id AND b.i = a.i + 1, unnest(range(4)) u(q) WHERE a.i < {ANSWER_HOURS - 1})"))
    + f"SELECT site_id, ts, {R4('temperature')} AS temperature, {R4('humidity')} AS humidity, {R4('wind_speed')} AS wind_speed, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, "
    "CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend FROM qt")
def q_next_7_days_heat_features(spark, d):
    return _rounded(future_heat_features(spark, d))


@register("score_next_7_days_heat")
def q_next_7_days_heat(spark, d):
    model = fc.fit_gbt(heat_frame(spark, d), calendar.HEAT_FEATURES, "heat_demand")
    return _rounded(scoring.scored(model, future_heat_features(spark, d), "heat_demand_forecast").forecast)


# ---------------------------------------------------------------------- P10
@register("heat_feature_frame", cat.with_sql(cat.SQL_HOURLY) + f"SELECT site_id, ts, {R4('15.0::DOUBLE + 10.0::DOUBLE * sin(2 * pi() * (hour(ts) - 6) / 24.0::DOUBLE) - 12.0::DOUBLE + (site_id % 10) * 1.5::DOUBLE')} AS temperature, "
          f"50.0::DOUBLE + hour(ts) AS humidity, {R4('3.0::DOUBLE + site_id % 5 + hour(ts) / 10.0::DOUBLE')} AS wind_speed, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, "
          f"CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END::BIGINT AS is_weekend, {R4('100.0::DOUBLE + kwh')} AS heat_demand FROM hourly")
def q_heat_frame(spark, d):
    return _rounded(heat_frame(spark, d))


@register("pv_feature_frame", cat.with_sql(cat.SQL_HOURLY) + f"SELECT site_id, ts, {R4(_AZ)} AS azimuth, {R4(_ALT)} AS altitude, week(ts) AS week, hour(ts) AS hour, "
          f"{R4('greatest(0.0::DOUBLE, 800.0::DOUBLE * sin(2 * pi() * (hour(ts) - 6) / 24.0::DOUBLE)) * (1.0::DOUBLE - ((kwh % 100.0::DOUBLE) + 100.0::DOUBLE) % 100.0::DOUBLE / 100.0::DOUBLE)')} AS direct_radiation, "
          f"{R4('((kwh % 100.0::DOUBLE) + 100.0::DOUBLE) % 100.0::DOUBLE')} AS cloud_cover FROM hourly")
def q_pv_frame(spark, d):
    return _rounded(pv_frame(spark, d).drop("pv_kw"))


# ---------------------------------------------------------------------- S10
@register("model_store")
def q_model_store(spark, d):
    data = _stored(spark, consumption_frame(spark, d), "s10")
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    model = fc.load_or_train(path, data, calendar.CONSUMPTION_FEATURES, "kwh")
    loaded = fc.load_model(path)
    a, b = (fc.score_each(m, fc.binned(m, data)).select("site_id", "ts", F.col("prediction").alias(name))
            for m, name in ((model, "prediction_trained"), (loaded, "prediction_loaded")))
    return _rounded(a.join(b, ["site_id", "ts"]))
