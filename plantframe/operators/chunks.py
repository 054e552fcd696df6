"""Skew-safe building blocks for per-site ordered scans.

A plain ``Window.partitionBy(site).orderBy(ts)`` sends every row of a site
to one task.  When one site holds a third of all rows that task is the
whole job.  The helpers here split each site into time chunks (default:
one calendar day) and run the window per ``(site, chunk)``.  Whatever has
to cross a chunk boundary is reduced to a *summary table* with one row per
chunk (last known value, row count, first/last row), built with map-side
partial aggregation.  That table is small (sites × days), is scanned per
site, and is joined back on ``(site, chunk)``.  The big side is already
hash-partitioned on exactly those keys by the chunk window, so the join
adds no second shuffle of it (or none at all when AQE broadcasts the
summary after measuring it).  Joins are inner: every chunk of the input
has a summary row; rows with a NULL site or stamp have no place in a
series and are dropped.

* ``fill_scan``         last / next non-NULL value (with its order key)
* ``positional_index``  0-based row position per site
* ``neighbor_rows``     immediate previous / next row across chunk edges
* ``spread_join``       rows with a table of one row per site
* ``halo_partition``    positional chunks plus copied edge rows, for
                        bounded frames (``rowsBetween(-w, k)``)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def chunk_expr(ts: str, unit: str = "day") -> Column:
    """Chunk key of a TIMESTAMP_NTZ column: ``day`` / ``month`` / ``hour`` / ``none``."""
    c = F.col(ts)
    if unit == "day":
        return F.to_date(c)
    if unit == "month":
        return F.trunc(F.to_date(c), "month")
    if unit == "hour":
        return F.window(c, "1 hour").start
    if unit == "none":
        return F.lit(0)
    raise ValueError(f"unknown chunk unit {unit!r}")


#: Keys that each site's rows are dealt to where they meet a row of their site.
DEALS = 32


def spread_join(df: DataFrame, per_key: DataFrame, by: Sequence[str], *, how: str = "left", deals: int = DEALS) -> DataFrame:
    """Join rows with a table of one row per key, without bringing a key's rows together.

    The small side stands once per deal and the rows are dealt by a hash of what
    else they hold, so a site with a third of all rows is ``deals`` keys of the shuffle.
    A small side that Spark measures to be small is broadcast as before.
    """
    by = list(by)
    rest = [f.name for f in df.schema.fields if f.name not in by and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    deal = F.pmod(F.xxhash64(*rest), F.lit(deals)) if rest else F.lit(0).cast("long")
    many = per_key.withColumn("__deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))))
    return df.withColumn("__deal", deal).join(many, [*by, "__deal"], how).drop("__deal")


def with_chunk(df: DataFrame, ts: str, unit: str = "day", name: str = CHUNK) -> DataFrame:
    return df.withColumn(name, chunk_expr(ts, unit))



_INT_TYPES = ("tinyint", "smallint", "int", "bigint")


def _order_code(df: DataFrame, order: list[str]):
    """One LONG that sorts like ``order``, plus a decoder back to the order columns.

    Supported orders: a timestamp, or a timestamp plus a 0/1 integer flag.
    Summaries keyed on a primitive code can use hash aggregation (``max``,
    ``max_by``) instead of sorting every input row for a struct ``max``.
    Returns None for other orders (the struct path is used then).
    """
    types = [df.schema[o].dataType.simpleString() for o in order]
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if types[0] == "timestamp_ntz":
        micros = F.timestamp_diff("MICROSECOND", epoch, F.col(order[0]))
        to_ts = lambda c: F.timestamp_add("MICROSECOND", c, epoch)
    elif types[0] == "timestamp":
        micros = F.unix_micros(F.col(order[0]))
        to_ts = F.timestamp_micros
    else:
        return None
    if len(order) == 1:
        return micros, lambda c: [to_ts(c)]
    if len(order) == 2 and types[1] in _INT_TYPES:
        def decode(c: Column) -> list[Column]:
            flag = F.pmod(c, F.lit(2))
            return [to_ts(((c - flag) / F.lit(2)).cast("long")), flag.cast(types[1])]

        return micros * F.lit(2) + F.col(order[1]).cast("long"), decode
    return None


def _fields(df: DataFrame, v: str) -> list[tuple[str, Column]] | None:
    """Primitive fields of column ``v`` (itself, or the members of a flat struct)."""
    t = df.schema[v].dataType
    if isinstance(t, T.StructType):
        if any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) for f in t.fields):
            return None
        return [(f.name, F.col(v).getField(f.name)) for f in t.fields]
    if isinstance(t, (T.ArrayType, T.MapType)):
        return None
    return [("", F.col(v))]


def _rebuild(fields: list[tuple[str, Column]], cols: list[Column]) -> Column:
    if len(fields) == 1 and fields[0][0] == "":
        return cols[0]
    return F.struct(*[c.alias(name) for (name, _), c in zip(fields, cols)])


# ----------------------------------------------------------------- fill scan
def fill_scan(df: DataFrame, part: Sequence[str] | str, order: Sequence[str] | str,
              values: Sequence[str] | str, direction: str = "both", inclusive: bool = True,
              chunk: str = CHUNK, prev_prefix: str = "_prev_", next_prefix: str = "_next_") -> DataFrame:
    """For every row, the nearest row before and/or after it (in ``order``) whose value is non-NULL.

    Adds struct columns ``{prev_prefix}{value}`` / ``{next_prefix}{value}``
    with fields ``o0..ok`` (that row's order key) and ``v`` (its value); NULL
    when no such row exists.  ``df`` must already carry the ``chunk`` column.
    ``inclusive`` makes the current row a candidate.  Both directions share
    one window pass, one summary aggregate and one join.
    """
    part, order, values = _as_list(part), _as_list(order), _as_list(values)
    if direction not in ("prev", "next", "both"):
        raise ValueError(direction)
    dirs = ["prev", "next"] if direction == "both" else [direction]
    keys = part + [chunk]

    def packed(v: str) -> Column:
        fields = [F.col(o).alias(f"o{i}") for i, o in enumerate(order)] + [F.col(v).alias("v")]
        return F.when(F.col(v).isNotNull(), F.struct(*fields))

    w = Window.partitionBy(*keys).orderBy(*[F.col(o) for o in order])
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    named = lambda c: "`" + c.replace("`", "``") + "`"

    def ahead(c: str, by: list[str], along: list[str]) -> Column:
        """The next known value: lead goes through a partition once, a frame that ends with it would be read again for each row."""
        return F.expr(f"lead({named(c)}, 1) IGNORE NULLS OVER (PARTITION BY {', '.join(map(named, by))} ORDER BY {', '.join(map(named, along))})")

    def within(dr: str, v: str) -> Column:
        if dr == "prev":
            return F.last(packed(v), ignorenulls=True).over(before)
        after = ahead(f"__at_{v}", keys, order)
        return F.coalesce(packed(v), after) if inclusive else after

    summarise = {"prev": F.max, "next": F.min}
    prefix = {"prev": prev_prefix, "next": next_prefix}

    held = df.withColumns({f"__at_{v}": packed(v) for v in values}) if "next" in dirs else df
    local = held.withColumns({f"__in_{dr}_{v}": within(dr, v) for dr in dirs for v in values}).drop(*[f"__at_{v}" for v in values])
    # one row per (site, chunk): the chunk's last / first known value per
    # column, aggregated from the input with map-side partial aggregation, so
    # only one row per (site, chunk, task) is shuffled for it.
    summary = _known_summary(df, keys, order, values, dirs) or \
        df.groupBy(*keys).agg(*[summarise[dr](packed(v)).alias(f"__s_{dr}_{v}") for dr in dirs for v in values])
    ws = Window.partitionBy(*part).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)

    def beyond(dr: str, v: str) -> Column:
        c = f"__s_{dr}_{v}"
        return F.last(c, ignorenulls=True).over(ws) if dr == "prev" else ahead(c, part, [chunk])

    carry = summary.select(*keys, *[beyond(dr, v).alias(f"__c_{dr}_{v}") for dr in dirs for v in values])
    joined = local.join(carry, keys, "inner")
    return joined.select(
        *[c for c in local.columns if not c.startswith("__in_")],
        *[F.coalesce(F.col(f"__in_{dr}_{v}"), F.col(f"__c_{dr}_{v}")).alias(f"{prefix[dr]}{v}")
          for dr in dirs for v in values])


def _known_summary(df: DataFrame, keys: list[str], order: list[str], values: list[str], dirs: list[str]):
    """Hash-aggregated form of the per-chunk last/first known (order, value) structs, or None."""
    enc = _order_code(df, order)
    fields = {v: _fields(df, v) for v in values}
    if enc is None or any(f is None for f in fields.values()):
        return None
    code, decode = enc
    ext = {"prev": (F.max, F.max_by), "next": (F.min, F.min_by)}
    aggs = []
    for dr in dirs:
        agg, agg_by = ext[dr]
        for v in values:
            ordk = F.when(F.col(v).isNotNull(), code)
            aggs.append(agg(ordk).alias(f"__k_{dr}_{v}"))
            aggs += [agg_by(c, ordk).alias(f"__f_{dr}_{v}_{i}") for i, (_, c) in enumerate(fields[v])]
    raw = df.groupBy(*keys).agg(*aggs)
    out = []
    for dr in dirs:
        for v in values:
            k = F.col(f"__k_{dr}_{v}")
            o = [c.alias(f"o{i}") for i, c in enumerate(decode(k))]
            val = _rebuild(fields[v], [F.col(f"__f_{dr}_{v}_{i}") for i in range(len(fields[v]))])
            out.append(F.when(k.isNotNull(), F.struct(*o, val.alias("v"))).alias(f"__s_{dr}_{v}"))
    return raw.select(*keys, *out)


# ---------------------------------------------------------- positional index
def positional_index(df: DataFrame, part: Sequence[str] | str, order: Sequence[str] | str,
                     pos: str = "pos", chunk: str = CHUNK, with_count: str | None = None) -> DataFrame:
    """0-based position of each row within its ``part`` group, in ``order``.

    Row numbers are taken per ``(part, chunk)``; chunk offsets come from a
    per-chunk row-count table and a running sum over it.  ``with_count``
    also adds the group's total row count.
    """
    part, order = _as_list(part), _as_list(order)
    keys = part + [chunk]
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(o) for o in order]))
    local = df.withColumn("__rn", rn)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*part).orderBy(chunk)
    offs = counts.select(
        *keys,
        F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        *([F.sum("__n").over(Window.partitionBy(*part)).alias(with_count)] if with_count else []))
    out = local.join(offs, keys, "inner").withColumn(pos, (F.col("__off") + F.col("__rn") - 1).cast("long"))
    return out.drop("__rn", "__off")


# -------------------------------------------------------------- neighbor rows
def neighbor_rows(df: DataFrame, part: Sequence[str] | str, order: Sequence[str] | str,
                  values: Sequence[str] | str, chunk: str = CHUNK,
                  prev: str = "_prev", nxt: str = "_next") -> DataFrame:
    """Previous and next row (any values, NULLs kept) as struct columns ``prev``/``nxt``.

    Inside a chunk these are ``lag``/``lead``; at chunk edges they come from
    the neighbouring chunk's last / first row, found in the summary table.
    """
    part, order, values = _as_list(part), _as_list(order), _as_list(values)
    keys = part + [chunk]
    row = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                   *[F.col(v).alias(v) for v in values])
    w = Window.partitionBy(*keys).orderBy(*[F.col(o) for o in order])
    local = df.withColumns({"__lag": F.lag(row).over(w), "__lead": F.lead(row).over(w)})
    summary = _edge_summary(df, keys, order, values) or \
        df.groupBy(*keys).agg(F.min(row).alias("__first"), F.max(row).alias("__last"))
    ws = Window.partitionBy(*part).orderBy(chunk)
    carry = summary.select(*keys, F.lag("__last").over(ws).alias("__cprev"),
                           F.lead("__first").over(ws).alias("__cnext"))
    out = local.join(carry, keys, "inner")
    return out.select(*[c for c in local.columns if c not in ("__lag", "__lead")],
                      F.coalesce("__lag", "__cprev").alias(prev),
                      F.coalesce("__lead", "__cnext").alias(nxt))


def _edge_summary(df: DataFrame, keys: list[str], order: list[str], values: list[str]):
    """Hash-aggregated first / last row of every chunk (order key + values), or None."""
    enc = _order_code(df, order)
    if enc is None or any(_fields(df, v) is None for v in values):
        return None
    code, decode = enc
    raw = df.groupBy(*keys).agg(
        F.min(code).alias("__kf"), F.max(code).alias("__kl"),
        *[F.min_by(F.col(v), code).alias(f"__vf_{i}") for i, v in enumerate(values)],
        *[F.max_by(F.col(v), code).alias(f"__vl_{i}") for i, v in enumerate(values)])

    def row(k: str, pre: str) -> Column:
        o = [c.alias(f"o{i}") for i, c in enumerate(decode(F.col(k)))]
        return F.struct(*o, *[F.col(f"{pre}{i}").alias(v) for i, v in enumerate(values)])
    return raw.select(*keys, row("__kf", "__vf_").alias("__first"), row("__kl", "__vl_").alias("__last"))


# ------------------------------------------------------------ halo partitions
def halo_partition(df: DataFrame, part: Sequence[str] | str, pos: str, lookback: int,
                   lookahead: int = 0, rows_per_chunk: int = 4096,
                   pchunk: str = "_pchunk", halo: str = "_halo") -> DataFrame:
    """Split each site into position chunks of ``rows_per_chunk`` rows and copy edge rows.

    Rows within ``lookback`` of the next chunk are copied into it, rows within
    ``lookahead`` of the previous chunk into that one (flag ``halo``).  A
    window ``partitionBy(part, pchunk)`` with a frame no wider than
    ``(-lookback, lookahead)`` then sees every row it needs; drop halo rows
    afterwards.  Copies are (lookback + lookahead) / rows_per_chunk of the data.
    """
    size = max(int(rows_per_chunk), lookback + lookahead + 1)
    c = F.floor(F.col(pos) / F.lit(size)).cast("long")
    off = F.col(pos) - c * F.lit(size)
    copies = F.array(
        F.struct(c.alias("k"), F.lit(False).alias("h")),
        F.when(off >= F.lit(size - lookback), F.struct((c + 1).alias("k"), F.lit(True).alias("h"))),
        F.when(off < F.lit(lookahead), F.struct((c - 1).alias("k"), F.lit(True).alias("h"))),
    )
    exploded = df.withColumn("__copies", F.filter(copies, lambda x: x.isNotNull()))
    exploded = exploded.withColumn("__copy", F.explode("__copies")).drop("__copies")
    return (exploded.withColumn(pchunk, F.col("__copy.k")).withColumn(halo, F.col("__copy.h"))
            .drop("__copy"))
