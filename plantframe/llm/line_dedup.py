"""Line dedup by site-relative frequency.

Pages are grouped by host.  For each (host, line) the pages that contain the
line are counted and divided by the host's page total; lines above the
boilerplate ratio are dropped from every page of that host, if at least
``LEAST_PAGES`` pages have them.

Defined cases: a null text has no lines and stays null; lines without a word
are never counted or dropped; lines compare after trimming white space; a line
that a page repeats counts once for that page, and all its repeats are
dropped; null hosts are one host; the rule is the same for hosts of every size.
Repeated rows (same key) are pages of their own.  A line of any length is one line.
Columns other than the text pass through.  A page that is boilerplate only
stays, with an empty text.

Each page sends a distinct 64-bit line hash once, summed on the map side, so
neither a hot host nor a line on a third of all pages meets in one task.  A
host's boilerplate is at most (its lines a page) / ratio lines, one short row;
that table is broadcast up to a checked size, and beyond it joined on host and
salt, so a hot host's pages are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantframe.llm._scratch import written

RATIO = 0.05
#: A line on fewer pages of its host is never boilerplate.
LEAST_PAGES = 3
SPACES = " \t\n\x0b\x0c\r"
#: The table of boilerplate has a row a host; up to so many rows and lines it is broadcast, beyond that joined by salted shuffle.
MAX_BROADCAST_HOSTS = 10_000
MAX_BROADCAST_LINES = 500_000
SALTS = 64


def _code(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(SPACES)))


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def boilerplate(pages: DataFrame, host: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per host with boilerplate: host_key and the hashes of its lines, at most lines-a-page / ratio of them."""
    rows = pages.select(_host_key(host).alias("host_key"), F.col(text).alias("t"))
    totals = rows.groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))
    lines = rows.select("host_key", F.explode(F.array_distinct(F.transform(F.filter(F.split("t", "\n", -1), _has_word), _code))).alias("line"))
    counts = lines.groupBy("host_key", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    return counts.join(totals, "host_key").where(F.col("n") > F.col("pages") * F.lit(ratio)) \
        .groupBy("host_key").agg(F.collect_list("line").alias("lines"))


def _host_key(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("~"))


def drop_boilerplate(pages: DataFrame, host: str, text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES,
                     counts: bool = False, length: str | None = None) -> DataFrame:
    """``pages`` without boilerplate lines.

    With ``counts`` also n_lines and n_dropped (replacing columns of that name);
    a column named by ``length`` gets the new length of a text that lost lines.
    """
    found = written(boilerplate(pages, f"`{host}`", f"`{text}`", ratio, least_pages), "boilerplate")
    size = found.agg(F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum(F.size("lines")), F.lit(0)).alias("lines")).first()
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), _host_key(f"`{host}`").alias("host_key"), F.col(f"`{text}`").alias("t"))
    if size["hosts"] <= MAX_BROADCAST_HOSTS and size["lines"] <= MAX_BROADCAST_LINES:
        joined = rows.join(F.broadcast(found), "host_key", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("t"), F.lit(SALTS)).cast("int")).join(salted, ["host_key", "salt"], "left")
    kept = F.filter(F.split("t", "\n", -1), lambda x: ~(_has_word(x) & F.array_contains("lines", _code(x))))
    out = joined.withColumn("kept", F.when(F.col("lines").isNotNull(), kept))
    new_text = F.when(F.col("kept").isNull(), F.col("t")).otherwise(F.array_join("kept", "\n"))
    added = {}
    if counts:
        n_lines = F.when(F.col("t").isNull(), 0).otherwise(F.size(F.split("t", "\n", -1)))
        added = {"n_lines": n_lines.cast("long"), "n_dropped": F.when(F.col("kept").isNull(), F.lit(0)).otherwise(n_lines - F.size("kept")).cast("long")}
    keep = [c for c in pages.columns if c.lower() not in added]
    own = {c: F.col(f"row.`{c}`") for c in keep} | {text: new_text}
    if length in keep:
        own[length] = F.when(F.col("kept").isNull(), own[length]).otherwise(F.length(new_text)).cast(pages.schema[length].dataType)
    return out.select(*[v.alias(c) for c, v in own.items()], *[v.alias(k) for k, v in added.items()])
