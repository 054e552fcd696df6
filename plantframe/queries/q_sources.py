"""S1–S9 and A9 over the test tables.

Landed inputs (meter text, JSON payloads, HTML pages, parameter files) are
derived from the test tables with Spark, then read back through the
source operators, so every query's work grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plantframe import catalog as cat
from plantframe.functions import profiles
from plantframe.operators import metrics, series
from plantframe.queries.common import R4, register, round_doubles
from plantframe.session import scratch_path
from plantframe.sources import meter_csv, params, payloads, prices, sinks

RD, HR = cat.SQL_READINGS, cat.SQL_HOURLY
W = cat.with_sql

# Fixed-date public holidays used to build holiday payloads
# (month-day, national, county codes).
HOLIDAY_TEMPLATE = [
    ("01-01", True, None),
    ("01-06", False, ["DE-BW", "DE-BY", "DE-ST"]),
    ("03-08", False, ["DE-BE", "DE-MV"]),
    ("05-01", True, None),
    ("08-15", False, ["DE-SL"]),
    ("10-03", True, None),
    ("10-31", False, ["DE-BB", "DE-HB", "DE-HH", "DE-MV", "DE-NI", "DE-SN", "DE-ST", "DE-SH", "DE-TH"]),
    ("11-01", False, ["DE-BW", "DE-BY", "DE-NW", "DE-RP", "DE-SL"]),
    ("12-25", True, None),
    ("12-26", True, None),
]


def _holiday_payload(year_col):
    items = []
    for md, glob, counties in HOLIDAY_TEMPLATE:
        c = F.array(*[F.lit(x) for x in counties]) if counties else F.lit(None).cast("array<string>")
        items.append(F.struct(F.format_string(f"%d-{md}", year_col).alias("date"), F.lit(glob).alias("global"),
                              c.alias("counties")))
    return F.to_json(F.array(*items))


def sql_holiday_values() -> str:
    rows = []
    for md, glob, counties in HOLIDAY_TEMPLATE:
        m, d = md.split("-")
        lst = "NULL::VARCHAR[]" if not counties else "[" + ", ".join(f"'{c}'" for c in counties) + "]"
        rows.append(f"({int(m)}, {int(d)}, {str(glob).upper()}, {lst})")
    return "(VALUES " + ", ".join(rows) + ") t(m, d, g, counties)"


def site_region(site_col="site_id"):
    return F.when(F.pmod(F.col(site_col), F.lit(2)) == 0, F.lit("DE-SH")).otherwise(F.lit("DE-BY"))


def holidays_from_data(spark, d, region: str = "DE-SH"):
    """S5 + A10: holiday dates for every year present in the readings."""
    return holidays_of_years(cat.readings(spark, d).select(F.year("ts").alias("year")).distinct(), region)


def holidays_of_years(years, region: str = "DE-SH"):
    pay = years.select("year", _holiday_payload(F.col("year")).alias("payload"))
    return payloads.holiday_dates(pay, region)


SQL_HOLIDAYS = ("holidays AS (SELECT DISTINCT make_date(y.y, t.m, t.d) AS date FROM "
                "(SELECT DISTINCT year(ts) AS y FROM readings) y CROSS JOIN " + sql_holiday_values()
                + " WHERE t.g OR list_contains(coalesce(t.counties, []::VARCHAR[]), 'DE-SH'))")


# ---------------------------------------------------------------------- S1
#: Export files that a query lands; readings are dealt to them, so no file belongs to one site.
METER_FILES = 16
#: Lines above the data: one looks like a reading, as exports may state the period's total.
METER_HEAD = ["Zählpunkt;DE00000000000000", "01.01.2023 00:00;99999,0;kWh;1", "Datum;Wert;Einheit;Anlage"]
PV_HEAD = ["PV-Anlage;Dach", "01.01.2023 00:00;88888,0;kW;1", "Datum;Leistung"]


def _land_meter_files(spark, d, name, head):
    """Meter files in the shared folder; some values are not numbers, and a file ends with its total."""
    r = cat.readings(spark, d)
    value = F.when(F.pmod("event_id", F.lit(97)) == 0, F.lit("n/a")).otherwise(F.regexp_replace(F.col("kwh").cast("string"), r"\.", ","))
    data = r.select(F.pmod("event_id", F.lit(METER_FILES)).alias("export"), F.lit(1).alias("o"), F.lit(0).alias("i"),
                    F.concat_ws(";", F.date_format("ts", "dd.MM.yyyy HH:mm"), value, F.lit("kWh"), F.col("site_id").cast("string")).alias("line"))
    exports = data.select("export").distinct()
    above = exports.select("export", F.lit(0).alias("o"), F.posexplode(F.array(*map(F.lit, head))).alias("i", "line"))
    below = exports.select("export", F.lit(2).alias("o"), F.lit(0).alias("i"), F.lit("Summe;1,0;kWh;0").alias("line"))
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    lines = above.unionByName(data).unionByName(below)
    lines.repartition(METER_FILES, "export").sortWithinPartitions("export", "o", "i").select("export", "line").write.partitionBy("export").text(path)
    return path


_SQL_METER = "SELECT site_id, strptime(strftime(ts, '%d.%m.%Y %H:%M'), '%d.%m.%Y %H:%M') AS ts, {v} FROM readings WHERE event_id % 97 <> 0"


@register("scan_meter_csv", W(RD) + _SQL_METER.format(v=f"{R4('kwh')} AS kwh"))
def q_scan_meter(spark, d):
    out = meter_csv.scan_meter_csv(spark, _land_meter_files(spark, d, "meter", METER_HEAD), site_field=3)
    return round_doubles(out.withColumn("site_id", F.col("site_id").cast("long")))


@register("scan_pv_csv", W(RD) + _SQL_METER.format(v=f"{R4('kwh')} AS pv_kw"))
def q_scan_pv(spark, d):
    out = meter_csv.scan_pv_csv(spark, _land_meter_files(spark, d, "pv", PV_HEAD), site_field=3)
    return round_doubles(out.withColumn("site_id", F.col("site_id").cast("long")))


@register("meter_reject_counts", W(RD) + f"SELECT event_id % {METER_FILES} AS export, count_if(event_id % 97 <> 0)::BIGINT AS n_rows, "
          f"(count_if(event_id % 97 = 0) + 1)::BIGINT AS n_rejected, count_if(event_id % 97 = 0)::BIGINT AS n_bad_values, {len(METER_HEAD)}::BIGINT AS n_preamble FROM readings GROUP BY 1")
def q_meter_reject_counts(spark, d):
    counts = meter_csv.meter_reject_counts(spark, _land_meter_files(spark, d, "rejects", METER_HEAD))
    return counts.select(F.regexp_extract("file", r"export=(\d+)", 1).cast("long").alias("export"), F.col("rows").alias("n_rows"),
                         F.col("rejected").alias("n_rejected"), F.col("bad_values").alias("n_bad_values"), F.col("preamble").alias("n_preamble"))


# ---------------------------------------------------------------------- S2
@register("scan_forecast_csv", W(HR) + "SELECT site_id, ts, "
          f"{R4('CASE WHEN hour(ts) % 3 = 0 THEN kwh / 10.0::DOUBLE ELSE 15.0::DOUBLE + 10.0::DOUBLE * sin(2 * pi() * (hour(ts) - 6) / 24.0::DOUBLE) END')} AS temperature, "
          f"{R4('CASE WHEN hour(ts) % 3 = 0 THEN kwh ELSE greatest(0.0::DOUBLE, 800.0::DOUBLE * sin(2 * pi() * (hour(ts) - 6) / 24.0::DOUBLE)) END')} AS solar_irradiance, "
          "CASE WHEN hour(ts) % 3 = 0 THEN 60.0::DOUBLE ELSE 50.0::DOUBLE END AS humidity FROM hourly")
def q_scan_forecast(spark, d):
    h = cat.hourly(spark, d)
    base = h.select("site_id", "ts")
    # landed as a forecast file; two of three stamps lie half an hour off and match nothing
    stamp = F.when(F.pmod(F.hour("ts"), F.lit(3)) == 0, F.col("ts")).otherwise(F.expr("ts + INTERVAL 30 MINUTE"))
    landed = h.select(
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "site_id", (F.col("kwh") / 10.0).alias("temperature"), F.col("kwh").alias("solar_irradiance"),
        F.lit(60.0).alias("humidity"))
    path = scratch_path(spark, f"forecast-{uuid.uuid4().hex}")
    landed.write.option("header", True).csv(path)
    observed = meter_csv.scan_forecast_csv(spark, path, "site_id long, temperature double, solar_irradiance double, humidity double")
    return round_doubles(meter_csv.with_profile_fallback(base, observed, "weather"))


# ---------------------------------------------------------------------- S3
@register("params_table", W(RD, "s AS (SELECT site_id, count(*) AS n FROM readings GROUP BY site_id)")
          + "SELECT site_id, 150.0::DOUBLE + 10.0::DOUBLE * (site_id % 6) AS chp__P_max, 0.35::DOUBLE AS chp__eta_el, "
          "least(90.0::DOUBLE, 20.0::DOUBLE + n) AS battery_storage__initial_level, 1900.0::DOUBLE AS thermal_storage__max_level, "
          "CAST(3 AS BIGINT) AS electric_heaters__stages, 200.0::DOUBLE AS stage_total FROM s")
def q_params(spark, d):
    s = cat.readings(spark, d).groupBy("site_id").agg(F.count(F.lit(1)).alias("n"))
    js = s.select("site_id", F.to_json(F.struct(F.struct(
        F.struct((F.lit(150.0) + F.lit(10.0) * F.pmod("site_id", F.lit(6))).alias("P_max")).alias("chp"),
        F.struct(F.least(F.lit(90.0), F.lit(20.0) + F.col("n")).alias("initial_level")).alias("battery_storage"),
    ).alias("system_parameters"))).alias("j"))
    p = params.parse_params_json(js, "j").drop("j")
    flat = params.flat_system_params(p)
    out = flat.select("site_id", "chp__P_max", "chp__eta_el", "battery_storage__initial_level",
                      "thermal_storage__max_level", F.col("electric_heaters__stages").cast("long").alias("electric_heaters__stages"),
                      F.aggregate("electric_heaters__stage_powers", F.lit(0.0), lambda a, x: a + x).alias("stage_total"))
    return round_doubles(out)


@register("params_file", W(RD, "f AS (SELECT 100.0::DOUBLE + count(DISTINCT site_id) % 50 AS p_max, avg(kwh) AS mean FROM readings)")
          + "SELECT DISTINCT site_id, p_max AS chp__P_max, 0.35::DOUBLE AS chp__eta_el, 70.0::DOUBLE AS battery_storage__initial_level, "
          f"{R4('1000.0::DOUBLE + mean')} AS thermal_storage__max_level FROM readings, f")
def q_params_file(spark, d):
    """A parameter file of the fleet: landed as JSON, read with the defaults behind it, one value overridden for the run, attached to every site."""
    r = cat.readings(spark, d)
    system = r.agg(F.struct(
        F.struct((F.lit(100.0) + F.pmod(F.count_distinct("site_id"), F.lit(50))).alias("P_max")).alias("chp"),
        F.struct(F.lit(55.0).alias("initial_level")).alias("battery_storage"),
        F.struct((F.lit(1000.0) + F.avg("kwh")).alias("max_level")).alias("thermal_storage")).alias("system_parameters"))
    path = scratch_path(spark, f"params-{uuid.uuid4().hex}")
    system.write.json(path)
    p = params.with_overrides(params.read_params(spark, path), {"battery_storage.initial_level": 70.0})
    flat = params.flat_system_params(p).select("chp__P_max", "chp__eta_el", "battery_storage__initial_level", "thermal_storage__max_level")
    return round_doubles(params.params_cross(r.select("site_id").distinct(), flat))


# ---------------------------------------------------------------------- S4
def _field(name):
    return lambda x: x[name]


#: Which payloads are cut off, as SQL over the rows that they are made of.
_CUT = {"series": "(site_id + day(ts)) % 11 = 0", "holidays": "site_id % 17 = 0", "prices": "(site_id + page) % 13 = 0"}
_S4_VARS = {"temperature_2m": "temperature", "relative_humidity_2m": "humidity",
            "wind_speed_10m": "wind_speed", "precipitation": "precipitation"}


@register("flatten_series_payload", W(HR) + "SELECT site_id, date_trunc('minute', ts) AS ts, "
          f"{R4('kwh / 10.0::DOUBLE - 5.0::DOUBLE')} AS temperature, {R4('50.0::DOUBLE + n')} AS humidity, "
          f"{R4('kwh / 20.0::DOUBLE')} AS wind_speed, CASE WHEN n > 1 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS precipitation "
          f"FROM hourly WHERE NOT {_CUT['series']}")
def q_flatten_series(spark, d):
    return round_doubles(payloads.flatten_series_payload(series_payloads(spark, d), _S4_VARS, keep=("site_id",)))


def _cut(payload, condition):
    """Some answers broke off on their way."""
    return F.when(condition, F.substr(payload, F.lit(1), F.length(payload) - 2)).otherwise(payload)


def series_payloads(spark, d):
    """A weather answer for each site and day, some of them cut off."""
    h = cat.hourly(spark, d)
    row = F.struct(F.col("ts").alias("ts"), (F.col("kwh") / 10.0 - 5.0).alias("temperature_2m"),
                   (F.lit(50.0) + F.col("n")).alias("relative_humidity_2m"), (F.col("kwh") / 20.0).alias("wind_speed_10m"),
                   F.when(F.col("n") > 1, F.lit(0.5)).otherwise(F.lit(0.0)).alias("precipitation"))
    per_day = h.groupBy("site_id", F.to_date("ts").alias("day")).agg(F.array_sort(F.collect_list(row)).alias("a"))
    hourly_obj = F.struct(F.transform("a", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                          *[F.transform("a", _field(v)).alias(v) for v in _S4_VARS])
    payload = F.to_json(F.struct(hourly_obj.alias("hourly")))
    return per_day.select("site_id", "day", _cut(payload, F.pmod(F.col("site_id") + F.dayofmonth("day"), F.lit(11)) == 0).alias("payload"))


# ---------------------------------------------------------------------- S5
@register("holiday_dates", W(RD) + "SELECT DISTINCT r.site_id, CAST(make_date(r.y, t.m, t.d) AS VARCHAR) AS date FROM "
          "(SELECT DISTINCT site_id, year(ts) AS y FROM readings) r CROSS JOIN " + sql_holiday_values()
          + " WHERE (t.g OR list_contains(coalesce(t.counties, []::VARCHAR[]), "
          f"CASE WHEN r.site_id % 2 = 0 THEN 'DE-SH' ELSE 'DE-BY' END)) AND NOT r.{_CUT['holidays']}")
def q_holiday_dates(spark, d):
    return round_doubles(payloads.holiday_dates(holiday_payloads(spark, d), site_region(), keep=("site_id",)))


def holiday_payloads(spark, d):
    """A holiday list for each site and year, some of them cut off."""
    sy = cat.readings(spark, d).select("site_id", F.year("ts").alias("year")).distinct()
    return sy.select("site_id", "year", _cut(_holiday_payload(F.col("year")), F.pmod("site_id", F.lit(17)) == 0).alias("payload"))


# ------------------------------------------------------------------- S6/S8
PAGE_ROWS = 32


#: A price page is a given page with the table behind its own text.
GIVEN_PAGES = 200


def price_pages(spark, d):
    """One market-results page per 32 consecutive readings of a site, inside a given page: hours 0, 8, 16, … as a table of their own in a cell."""
    r = series.with_position(cat.readings(spark, d), pos="pos")
    cell = F.when(F.col("event_type") != "error", F.regexp_replace(F.col("kwh").cast("string"), r"\.", "&#44;")) \
        .otherwise(F.lit("n/a"))
    tr = F.concat(F.lit("<tr><td>"), F.hour("ts").cast("string"), F.lit("</td><td>"), F.col("event_type"),
                  F.lit("</td><td class=\"v\">"), F.col("site_id").cast("string"), F.lit("</td><td>&nbsp;"), cell,
                  F.lit("</td></tr>"))
    inner = F.concat(F.lit("<tr><td>see <table>"), tr, F.lit("</table></td></tr>"))
    rows = r.select("site_id", F.floor(F.col("pos") / PAGE_ROWS).cast("long").alias("page"), "pos", "ts",
                    F.when(F.pmod("pos", F.lit(8)) == 0, inner).otherwise(tr).alias("tr"), F.pmod("pos", F.lit(8)).alias("__m"))
    # the count of partitions is given, as each page is read at a hundred times the cost of its bytes here
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "site_id", "page")
    pages = rows.groupBy("site_id", "page").agg(
        F.min("ts").alias("first_ts"),
        F.array_sort(F.collect_list(F.struct("pos", "tr"))).alias("rows"))
    table = F.concat(F.lit("<!-- <table><tr><td>1</td></tr></table> --><table><tr><th>Hour</th><th>Type</th><th>Site</th><th>Price</th></tr>"
                           "<tr><td>total</td><td>-</td><td>1,0</td></tr>"),
                     F.array_join(F.transform("rows", lambda x: x["tr"]), ""), F.lit("</table><table><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table></body></html>"))
    given = cat.table(spark, d, "pages").where(F.col("page_id") < GIVEN_PAGES).select(F.col("page_id").alias("__given"), F.col("html").alias("__html"))
    made = pages.withColumn("__given", F.pmod(F.col("site_id") * 7 + F.col("page"), F.lit(GIVEN_PAGES))).join(given, "__given", "left")
    html = F.concat(F.coalesce(F.regexp_replace("__html", r"(?is)</body>.*$", ""), F.lit("<html><body>")), table)
    return made.select("site_id", "page", F.to_date("first_ts").alias("delivery_date"), html.alias("html"))


# the row around an inner table counts its cells too, so its price comes twice
_SQL_PAGES = (RD + ", rp0 AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos FROM readings), "
              "rp AS (SELECT *, pos // 32 AS page FROM rp0 UNION ALL SELECT *, pos // 32 FROM rp0 WHERE pos % 8 = 0), "
              "rp2 AS (SELECT *, min(ts) OVER (PARTITION BY site_id, page) AS first_ts, "
              "sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY site_id, page) AS nvalid FROM rp), "
              "rv AS (SELECT *, row_number() OVER (PARTITION BY site_id, page ORDER BY ts) - 1 AS hr FROM rp2 "
              "WHERE event_type <> 'error' AND nvalid >= 24), "
              "scraped AS (SELECT site_id, page, CAST(first_ts AS DATE) AS delivery_date, hr AS hour, "
              "CAST(first_ts AS DATE) + hr * INTERVAL 1 HOUR AS ts, kwh AS price_eur_mwh, kwh / 10.0::DOUBLE AS price_ct_kwh "
              "FROM rv WHERE hr < 24)")


@register("extract_price_table", W(_SQL_PAGES) + "SELECT site_id, page, CAST(delivery_date AS VARCHAR) AS delivery_date, CAST(hour AS BIGINT) AS hour, "
          f"CAST(ts AS TIMESTAMP) AS ts, {R4('price_eur_mwh')} AS price_eur_mwh, {R4('price_ct_kwh')} AS price_ct_kwh FROM scraped")
def q_extract_price(spark, d):
    return round_doubles(prices.extract_price_table(price_pages(spark, d), keep=("site_id", "page")))


def price_sources(spark, d):
    scraped = prices.extract_price_table(price_pages(spark, d), keep=("site_id",)).select(
        "site_id", F.col("delivery_date").alias("day"), F.lit("scrape").alias("source"), F.lit(1).alias("priority"),
        "hour", F.col("price_ct_kwh").alias("price_ct"))
    api = cat.hourly(spark, d).select("site_id", F.to_date("ts").alias("day"), F.lit("api").alias("source"),
                                      F.lit(2).alias("priority"), F.hour("ts").cast("long").alias("hour"),
                                      (F.col("kwh") / 10.0).alias("price_ct"))
    return scraped.unionByName(api)


_SQL_SOURCES = (_SQL_PAGES + ", hourly AS (SELECT site_id, time_bucket(INTERVAL '1 hour', ts) AS ts, avg(kwh) AS kwh "
                "FROM readings GROUP BY ALL), "
                "src AS (SELECT site_id, delivery_date AS day, 'scrape' AS source, 1 AS priority, hour, price_ct_kwh AS price_ct FROM scraped "
                "UNION ALL SELECT site_id, CAST(ts AS DATE), 'api', 2, hour(ts), kwh / 10.0::DOUBLE FROM hourly)")


@register("price_source_fallback", W(_SQL_SOURCES,
                                     "cnt AS (SELECT *, count(*) OVER (PARTITION BY site_id, day, source) AS n FROM src)",
                                     "complete AS (SELECT * FROM cnt WHERE n = 24)",
                                     "best AS (SELECT site_id, day, min(priority) AS priority FROM complete GROUP BY ALL)",
                                     "days AS (SELECT DISTINCT site_id, CAST(ts AS DATE) AS day FROM readings)",
                                     "chosen AS (SELECT c.site_id, c.day, c.hour, c.price_ct, c.source FROM complete c "
                                     "JOIN best b USING (site_id, day, priority))",
                                     "fb AS (SELECT d.site_id, d.day, unnest(range(0, 24)) AS hour FROM days d "
                                     "ANTI JOIN best b USING (site_id, day))",
                                     "allp AS (SELECT * FROM chosen UNION ALL SELECT site_id, day, hour, "
                                     + profiles.SQL_PRICE.format(h="hour") + ", 'default' FROM fb)")
          + f"SELECT site_id, CAST(day AS VARCHAR) AS day, CAST(hour AS BIGINT) AS hour, {R4('price_ct')} AS price_ct, source FROM allp")
def q_price_fallback(spark, d):
    days = cat.readings(spark, d).select("site_id", F.to_date("ts").alias("day"))
    return round_doubles(prices.price_source_fallback(price_sources(spark, d), days))


@register("available_sources", W(_SQL_SOURCES) + "SELECT site_id, CAST(day AS VARCHAR) AS day, string_agg(DISTINCT source, ',' ORDER BY source) "
          "AS sources_label FROM src GROUP BY site_id, day")
def q_available_sources(spark, d):
    return round_doubles(metrics.available_sources(price_sources(spark, d), ["site_id", "day"]).drop("sources"))


# ---------------------------------------------------------------------- S7
def price_payloads(spark, d):
    r = series.with_position(cat.readings(spark, d), pos="pos")
    item = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("date"), F.col("kwh").alias("value"),
                    F.when(F.col("event_type").isin("view", "click", "signup"), F.lit("DE-LU"))
                    .otherwise(F.lit("AT")).alias("region"),
                    F.lit("PT60M").alias("resolution"))
    rows = r.select("site_id", F.floor(F.col("pos") / PAGE_ROWS).cast("long").alias("page"), "pos", item.alias("item"))
    pages = rows.groupBy("site_id", "page").agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("a"))
    items = F.transform("a", lambda x: x["item"])
    payload = F.when(F.pmod("page", F.lit(2)) == 0, F.to_json(items)) \
        .otherwise(F.to_json(F.struct(items.alias("data"))))
    return pages.select("site_id", "page", _cut(payload, F.pmod(F.col("site_id") + F.col("page"), F.lit(13)) == 0).alias("payload"))


@register("flatten_price_json", W(RD, "rp AS (SELECT *, (row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1) // 32 AS page "
                                  "FROM readings)")
          + f"SELECT site_id, CAST(page AS BIGINT) AS page, date_trunc('minute', ts) AS timestamp, {R4('kwh')} AS price, "
          "'DE-LU' AS region, 'PT60M' AS resolution FROM rp WHERE event_type IN ('view', 'click', 'signup') "
          f"AND NOT {_CUT['prices']} "
          "AND date_trunc('minute', ts) >= TIMESTAMP '2024-01-05 00:00:00' AND date_trunc('minute', ts) < TIMESTAMP '2024-01-25 00:00:00'")
def q_flatten_price(spark, d):
    out = payloads.flatten_price_json(price_payloads(spark, d), keep=("site_id", "page"), region="DE-LU",
                                      start="2024-01-05 00:00:00", end="2024-01-25 00:00:00")
    return round_doubles(out)


# --------------------------------------------------------- S4, S5, S7: rejects
@register("payload_rejects", W(RD, "rp AS (SELECT *, (row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1) // 32 AS page FROM readings)",
                               f"r AS (SELECT DISTINCT 'series' AS kind, site_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS part FROM readings WHERE {_CUT['series']} "
                               f"UNION ALL SELECT DISTINCT 'holidays', site_id, CAST(year(ts) AS VARCHAR) FROM readings WHERE {_CUT['holidays']} "
                               f"UNION ALL SELECT DISTINCT 'prices', site_id, CAST(page AS VARCHAR) FROM rp WHERE {_CUT['prices']})")
          + "SELECT kind, site_id, part, 'not json' AS reason FROM r")
def q_payload_rejects(spark, d):
    out = None
    for kind, df, part in (("series", series_payloads(spark, d), "day"), ("holidays", holiday_payloads(spark, d), "year"), ("prices", price_payloads(spark, d), "page")):
        bad = payloads.payload_rejects(df, kind, keep=("site_id", part), variables=_S4_VARS).select(F.lit(kind).alias("kind"), "site_id", F.col(part).cast("string").alias("part"), "reason")
        out = bad if out is None else out.unionByName(bad)
    return out


# ---------------------------------------------------------------------- S9
#: The day that a second run writes again.
AGAIN = "2024-01-10"


@register("sink_series", W(cat.SQL_PLAN_INPUTS, "ru AS (SELECT site_id, ts, least(200.0::DOUBLE, greatest(0.0::DOUBLE, "
                                                "0.7::DOUBLE * heat_demand)) AS chp, heat_demand FROM plan_inputs)",
                           "bo AS (SELECT *, greatest(0.0::DOUBLE, heat_demand - least(300.0::DOUBLE, 0.5::DOUBLE * chp)) AS boiler_heat, "
                           f"CASE WHEN CAST(ts AS DATE) = DATE '{AGAIN}' THEN chp + 1.0::DOUBLE ELSE chp END AS chp_power FROM ru)")
          + f"SELECT site_id, ts, {R4('chp_power')} AS chp_power, {R4('boiler_heat')} AS boiler_heat, {R4('chp_power')} AS chp_power_json, {R4('boiler_heat')} AS boiler_heat_json FROM bo")
def q_sink(spark, d):
    """A plan written as CSV and as JSON, then one day of it again: every row is read back."""
    from plantframe.functions import dispatch
    plan = dispatch.rule_dispatch(cat.plan_inputs(spark, d)).select("site_id", "ts", "chp_power", "boiler_heat")
    again = plan.where(F.to_date("ts") == F.lit(AGAIN).cast("date")).withColumn("chp_power", F.col("chp_power") + 1.0)
    path = scratch_path(spark, f"sink-{uuid.uuid4().hex}")
    back = {}
    for fmt in ("csv", "json"):
        sinks.sink_series(plan, f"{path}-{fmt}", fmt)
        sinks.sink_series(again, f"{path}-{fmt}", fmt)
        back[fmt] = sinks.read_sink(spark, f"{path}-{fmt}", fmt, "site_id long, ts timestamp_ntz, chp_power double, boiler_heat double", committed=True)
    from_json = back["json"].select("site_id", "ts", F.col("chp_power").alias("chp_power_json"), F.col("boiler_heat").alias("boiler_heat_json"))
    return round_doubles(back["csv"].select("site_id", "ts", "chp_power", "boiler_heat").join(from_json, ["site_id", "ts"]))
