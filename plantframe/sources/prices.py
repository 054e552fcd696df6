"""Day-ahead price sources.

S6 pulls the price column out of the first HTML table of a market-results
page (a fragment without a table tag counts as one), tables inside its cells
included: every row with at least 4 ``<td>`` cells, those of inner tables counted, contributes the text of its
last cell (decimal comma, €/MWh), in the order in which the rows begin; texts that are no number are
skipped; the first 24 values become hours 0–23 of the delivery day; a page with
fewer than 24 values yields nothing.

The page is cut at its table, row and cell tags, and one fold over the pieces
keeps the depth of tables (+1 and -1 at their tags) and the rows that are open. A row ends
at its end tag, at the next row of its table or with its table, a cell likewise;
so missing end tags and inner tables are read as a browser does. The fold is
linear in the page, and all of it is array functions: no HTML parser, no Python.

S8 keeps a source's day only when it has exactly 24 rows, picks the best
such source per (site, day) by priority, and falls back to the default
profile for days no source completes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.functions import profiles
from plantframe.functions.tariff import eur_mwh_to_ct_kwh

#: What a browser shows nothing of.
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
TAGS = r"(?i)(?=</?(?:table|tr|td|th)\b)"
# Character entities that stand in number cells.
ENTITIES = {"&nbsp;": " ", "&ensp;": " ", "&emsp;": " ", "&thinsp;": " ", "&comma;": ",", "&period;": ".", "&plus;": "+", "&amp;": "&", "&lt;": "<", "&gt;": ">"}
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_ROW = "struct<level:int,at:int,cells:int,text:string,depth:int,open:boolean>"
_STATE = f"struct<depth:int,at:int,over:boolean,rows:array<{_ROW}>,done:array<{_ROW}>>"


def _entities(text: Column) -> Column:
    """Text with entities as characters: named ones of number cells, and numeric ones of the first 256 characters."""
    parts = F.split(F.regexp_replace(text, r"(?i)&#x0*([0-9a-f]{1,2});", "&#x$1;"), r"(?=&#)")
    def decoded(part: Column) -> Column:
        decimal, hexa = F.regexp_extract(part, r"^&#0*([0-9]{1,3});", 1), F.regexp_extract(part, r"^&#x([0-9A-Fa-f]{1,2});", 1)
        code = F.when(decimal != "", decimal.try_cast("int")).when(hexa != "", F.conv(hexa, 16, 10).try_cast("int"))
        return F.when(code.between(1, 255), F.concat(F.char(code), F.regexp_replace(part, r"^&#x?[0-9A-Fa-f]+;", ""))).otherwise(part)
    out = F.array_join(F.transform(parts, decoded), "")
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.translate(out, "\u00a0\u2002\u2003\u2009\u202f", "     ")


def _step(state: Column, piece: Column) -> Column:
    """The fold's state after a piece: a tag of a table, row or cell and the text up to the next one."""
    tag = lambda *names: piece["tag"].isin(*names)
    opens, closes = tag("table"), tag("/table")
    row, row_end, cell, cell_end = tag("tr"), tag("/tr"), tag("td"), tag("/td", "/th", "th")
    text, depth = piece["text"], state["depth"]
    ends_row = lambda r: (row | row_end | closes) & (r["level"] >= depth)
    ends_cell = lambda r: (row | row_end | cell | cell_end | closes) & (r["depth"] >= depth)

    def moved(r: Column) -> Column:
        still = r["open"] & ~ends_cell(r)
        return F.struct(r["level"].alias("level"), r["at"].alias("at"), (r["cells"] + cell.cast("int")).alias("cells"),
                        F.when(cell, text).when(still, F.concat(r["text"], text)).otherwise(r["text"]).alias("text"),
                        F.when(cell, depth).otherwise(r["depth"]).alias("depth"), (cell | still).alias("open"))

    begun = F.when(row, F.array(F.struct(depth.alias("level"), state["at"].alias("at"), F.lit(0).alias("cells"), F.lit("").alias("text"), depth.alias("depth"), F.lit(False).alias("open")))) \
        .otherwise(F.array().cast(f"array<{_ROW}>"))
    after = depth + opens.cast("int") - (closes & (depth > 0)).cast("int")
    new = F.struct(after.alias("depth"), (state["at"] + 1).alias("at"), (closes & (after == 0)).alias("over"),
                   F.concat(F.transform(F.filter(state["rows"], lambda r: ~ends_row(r)), moved), begun).alias("rows"),
                   F.concat(state["done"], F.filter(state["rows"], ends_row)).alias("done"))
    # after the first table nothing counts
    return F.when(state["over"], state).otherwise(new)


def first_table_rows(html: Column) -> Column:
    """Rows of a page's first table (inner tables included), in the order in which they begin: cells, and the last one's text."""
    # each lambda over an array of one holds a value that is used more than once
    seen = F.transform(F.array(F.regexp_replace(html, HIDDEN, "")), lambda t: F.struct(t.alias("text"), F.regexp_instr(t, F.lit(r"(?i)<table\b")).alias("start")))
    table = F.transform(seen, lambda t: F.when(t["start"] > 0, F.substr(t["text"], t["start"])).otherwise(t["text"]))[0]
    pieces = F.transform(F.split(table, TAGS), lambda p: F.struct(
        F.lower(F.regexp_extract(p, r"(?i)^<(/?(?:table|tr|td|th))\b", 1)).alias("tag"), F.regexp_replace(p, r"(?s)<[^>]*>", "").alias("text")))
    empty = F.array().cast(f"array<{_ROW}>")
    first = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(False).alias("over"), empty.alias("rows"), empty.alias("done")).cast(_STATE)
    rows = F.aggregate(pieces, first, _step, lambda s: F.concat(s["done"], s["rows"]))
    ordered = F.array_sort(F.transform(rows, lambda r: F.struct(r["at"].alias("at"), r["cells"].alias("cells"), r["text"].alias("text"))))
    return F.transform(ordered, lambda r: F.struct(r["cells"].alias("cells"), F.btrim(_entities(r["text"]), F.lit(" \t\r\n\f\v")).alias("text")))


# ---------------------------------------------------------------------- S6
def extract_price_table(df: DataFrame, html_col: str = "html", delivery_date_col: str = "delivery_date", *,
                        keep: tuple[str, ...] = (), min_cells: int = 4, hours: int = 24) -> DataFrame:
    """HTML page -> (keep…, delivery_date, hour, ts, price_eur_mwh, price_ct_kwh)."""
    wide = F.filter(first_table_rows(F.col(html_col)), lambda r: r["cells"] >= min_cells)
    texts = F.transform(wide, lambda r: F.replace(r["text"], F.lit(","), F.lit(".")))
    prices = F.transform(F.filter(texts, lambda t: t.rlike(NUMBER)), lambda t: t.try_cast("double"))
    page = df.select(*keep, F.col(delivery_date_col).alias("delivery_date"), prices.alias("__prices"))
    # the outer generator's empty row is dropped behind it: a filter before it (a plain one adds its own) would fold the page again
    day = F.when(F.size("__prices") >= hours, F.slice("__prices", 1, hours))
    out = page.select(*keep, "delivery_date", F.posexplode_outer(day).alias("hour", "price_eur_mwh")).where(F.col("hour").isNotNull())
    return out.withColumns({
        "hour": F.col("hour").cast("long"),
        "ts": F.expr("timestampadd(HOUR, hour, cast(delivery_date as timestamp_ntz))"),
        "price_ct_kwh": eur_mwh_to_ct_kwh("price_eur_mwh"),
    })


# ---------------------------------------------------------------------- S8
def price_source_fallback(sources: DataFrame, days: DataFrame, *, site: str = "site_id", day: str = "day",
                          expected_rows: int = 24) -> DataFrame:
    """Choose one complete source per (site, day); fall back to the default profile.

    ``sources``: (site, day, source, priority, hour, price_ct).  ``days``:
    the (site, day) pairs that need prices.  Output: (site, day, hour,
    price_ct, source) with ``source = 'default'`` for fallback days.

    One aggregate per (site, day, source) and one per (site, day) over sources
    and wanted days alike, so no input is evaluated twice: a day's candidates are its
    complete sources, and a day without one takes the default profile.
    The rows of one source and day are one array, so a source should hold a day's hours, not a day's ticks.
    """
    wanted = days.select(site, day, F.lit(None).cast("string").alias("source"), F.lit(None).cast("int").alias("priority"), F.lit(None).cast("long").alias("hour"),
                         F.lit(None).cast("double").alias("price_ct"), F.lit(True).alias("__wanted")).distinct()
    rows = sources.select(site, day, "source", F.col("priority").cast("int").alias("priority"), F.col("hour").cast("long").alias("hour"), F.col("price_ct").cast("double").alias("price_ct"),
                          F.lit(False).alias("__wanted"))
    each = rows.unionByName(wanted).groupBy(site, day, "source").agg(
        F.min("priority").alias("priority"), F.count_if(~F.col("__wanted")).alias("n"), F.max("__wanted").alias("wanted"),
        F.collect_list(F.when(~F.col("__wanted"), F.struct("hour", "price_ct"))).alias("hours"))
    complete = (F.col("n") == expected_rows) & F.col("source").isNotNull()
    best = each.groupBy(site, day).agg(
        F.min(F.when(complete, F.col("priority"))).alias("priority"), F.max("wanted").alias("wanted"),
        F.collect_list(F.when(complete, F.struct("priority", "source", "hours"))).alias("complete"))
    default = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(expected_rows - 1).cast("long")), lambda h: F.struct(h.alias("hour"), profiles.default_price_ct(h).alias("price_ct")))
    fallback = F.struct(F.lit(0).alias("priority"), F.lit("default").alias("source"), default.alias("hours"))
    chosen = F.when(F.col("priority").isNotNull(), F.filter("complete", lambda c: c["priority"] == F.col("priority"))).when(F.col("wanted"), F.array(fallback)).otherwise(F.filter("complete", lambda c: F.lit(False)))
    out = best.select(site, day, F.explode(chosen).alias("c")).select(site, day, F.col("c.source").alias("source"), F.inline("c.hours"))
    return out.select(site, day, "hour", "price_ct", "source")
