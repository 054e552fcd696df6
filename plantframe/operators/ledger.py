"""Clamped running balances (R1, R2) as a distributed ordered scan.

Every storage step is a monotone map ``L -> clamp(a·L + b, lo, hi)`` with
``a >= 0``.  Such maps compose into a map of the same form, and composition
is associative, so the level sequence is a *prefix scan* over maps:

1. (shown for two levels) per ``(site, day)``: the steps in runs of ``RUN``; inside a
   run the prefixes come by doubling (each map is composed with the prefix 1, 2, 4, …
   rows before it, all over one sort), and one ordered fold per day gives the
   maps of its runs, what lies before each run and the day's map;
2. per ``(site, month)``: prefix compositions of the day maps;
3. per ``site``: prefix compositions of the month maps;
4. entry levels flow back down: month entry = months-before(L0), day entry
   = days-before(month entry), run entry = runs-before(day entry), step level
   = steps-so-far(run entry).

So a bucket of n steps costs n · log2(``RUN``) compositions beside its sort.

No task ever holds more than one finest bucket of one site's steps, one
bucket of maps of the level below, or one site's month maps, whatever the skew
across sites.  The bucket summaries are joined back on the keys the step table
is already partitioned on.  The levels are a parameter (default hour → day →
month).  A NULL amount is no movement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantframe.functions.plant import DEFAULT, Params

BIG = 1e300  # stands in for ±inf: keeps 0·bound finite
#: Nested buckets, finest first: a task holds one bucket of one site's steps.
LEVELS = ("hour", "day", "month")
#: Steps of a run, a power of two.
RUN = 32
_MAP_T = "struct<a:double,b:double,l:double,h:double>"


def clamp_map(a, b, lo=None, hi=None) -> Column:
    def c(x, default):
        if x is None:
            return F.lit(default)
        return x if isinstance(x, Column) else F.lit(float(x))
    return F.struct(c(a, 1.0).cast("double").alias("a"), c(b, 0.0).cast("double").alias("b"),
                    c(lo, -BIG).cast("double").alias("l"), c(hi, BIG).cast("double").alias("h"))


def identity() -> Column:
    return clamp_map(1.0, 0.0)


def compose(m1: Column, m2: Column) -> Column:
    """``m1`` then ``m2``."""
    def clamp2(x):
        return F.least(m2["h"], F.greatest(m2["l"], x))
    return F.struct((m1["a"] * m2["a"]).alias("a"), (m2["a"] * m1["b"] + m2["b"]).alias("b"),
                    clamp2(m2["a"] * m1["l"] + m2["b"]).alias("l"),
                    clamp2(m2["a"] * m1["h"] + m2["b"]).alias("h"))


def apply_map(m: Column, x: Column) -> Column:
    return F.least(m["h"], F.greatest(m["l"], m["a"] * x + m["b"]))


def _fold(maps: Column) -> Column:
    return F.aggregate(maps, identity(), lambda acc, m: compose(acc, m))


def _field(name: str):
    return lambda e: e[name]


def _prefix(df: DataFrame, part: list[str], order: str, maps: dict[str, str]) -> DataFrame:
    """Inclusive prefix compositions, one column per ledger, all in one window pass."""
    # ties of the stamp go by the maps, as in the sorted arrays of the upward pass
    w = Window.partitionBy(*part).orderBy(order, *maps).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({out: _fold(F.collect_list(F.col(m)).over(w)) for m, out in maps.items()})


def _run_prefixes(df: DataFrame, part: list[str], order: list[str], maps: dict[str, str]) -> DataFrame:
    """Inclusive prefix compositions inside runs of ``RUN`` rows, and ``__run``, the row's run within its bucket.

    All windows have one sort.  A row looks back only as far as its run begins.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    df = df.withColumn("__row", F.row_number().over(w) - 1).withColumns({out: F.col(m) for m, out in maps.items()})
    back = 1
    while back < RUN:
        far = F.pmod("__row", F.lit(RUN)) >= back
        df = df.withColumns({f"__lag{out}": F.lag(out, back).over(w) for out in maps.values()})
        df = df.withColumns({out: F.when(far, compose(F.col(f"__lag{out}"), F.col(out))).otherwise(F.col(out)) for out in maps.values()}).drop(*[f"__lag{out}" for out in maps.values()])
        back *= 2
    return df.withColumn("__run", F.floor(F.col("__row") / RUN).cast("int")).drop("__row")


def _runs_before(steps: Column) -> Column:
    """From a bucket's ordered maps: ``m``, the bucket's map, and ``before``, what lies before each of its runs."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")), lambda i: _fold(F.slice(steps, i * RUN + 1, RUN)))
    first = F.struct(identity().alias("m"), F.array().cast(f"array<{_MAP_T}>").alias("before"))
    return F.aggregate(runs, first, lambda acc, m: F.struct(compose(acc["m"], m).alias("m"), F.concat(acc["before"], F.array(acc["m"])).alias("before")))


def _level_key(ts: str, unit: str) -> Column:
    if unit in ("minute", "hour"):   # start of the bucket in microseconds; window() can be used once per plan only
        step = {"minute": 60_000_000, "hour": 3_600_000_000}[unit]
        us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
        return us - F.pmod(us, F.lit(step))
    if unit == "day":
        return F.to_date(ts)
    if unit == "month":
        return F.trunc(F.to_date(ts), "month")
    if unit == "year":
        return F.trunc(F.to_date(ts), "year")
    raise ValueError(unit)


def run_ledgers(df: DataFrame, ledgers: dict[str, tuple[Column, Column | float]], *, site: str = "site_id",
                ts: str = "ts", levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Run several independent ledgers in one hierarchical scan.

    ``ledgers``: name -> (step map, initial level).  Adds ``{name}_in`` and
    ``{name}_out`` per ledger.  ``initial`` may be a literal or a column that
    is constant per site (e.g. from a joined parameter table).

    ``levels`` are nested time buckets, finest first: steps are folded per
    (site, levels[0]), those maps per (site, levels[1]), …, and the
    coarsest maps per site.  Each window holds at most one bucket of the
    level below, so the work per task is bounded whatever one site's size.
    Stamps are unique per site; rows that share one are taken in the order of
    their step maps, in both passes.
    """
    names = list(ledgers)
    cols = {f"__m_{n}": m for n, (m, _) in ledgers.items()}
    # initial levels: literals stay literals; per-site columns go to a small per-site table joined at
    # the top.  Keeping them out of the bucket tables lets both consumers of each bucket table prune to
    # the same columns, so Spark reuses its exchange instead of recomputing the table.
    per_site_init = {n: init for n, (_, init) in ledgers.items() if isinstance(init, Column)}
    init_lit = {n: F.lit(float(init)) for n, (_, init) in ledgers.items() if not isinstance(init, Column)}
    keys = [f"__k{i}" for i in range(len(levels))]
    base = df.withColumns(cols).withColumns({k: _level_key(ts, u) for k, u in zip(keys, levels)})
    # state the key constraints once, up front: otherwise each join below infers its own null filters
    # and the copies of the bucket tables differ, which stops Spark from reusing their exchanges
    not_null = F.col(site).isNotNull() & F.col(ts).isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    base = base.filter(not_null)

    # upward pass.  Level 0: inclusive prefixes of the steps inside the runs of each finest bucket.
    # ties of the stamp go by the maps, as in the sorted arrays below
    steps = _run_prefixes(base, [site, keys[0]], [ts, *cols], {f"__m_{n}": f"__p0_{n}" for n in names})
    # Level 1: each finest bucket's map and run entries, folded straight from the input (one ordered fold per
    # bucket, map-side partial collection) rather than from the prefixes above.
    seq = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("o"), *[F.col(f"__m_{n}").alias(n) for n in names])))
    level1 = base.groupBy(site, *keys).agg(seq.alias("__seq"))
    level1 = level1.select(site, *keys, *[_runs_before(F.transform("__seq", _field(n))).alias(f"__f_{n}") for n in names])
    level1 = level1.select(site, *keys, *[F.col(f"__f_{n}.m").alias(f"__b1_{n}") for n in names], *[F.col(f"__f_{n}.before").alias(f"__q_{n}") for n in names])
    runs = [f"__q_{n}" for n in names]
    tables = [steps]   # tables[i]: rows of level i (level 0 = steps) with their prefix maps __p{i}_*
    for i in range(1, len(levels) + 1):
        parent = [site] + keys[i:i + 1]            # (site, next bucket) or just site at the top
        if i == 1:
            summary = level1
        else:
            summary = tables[-1].groupBy(site, *keys[i - 1:]).agg(
                *[F.max_by(f"__p{i - 1}_{n}", keys[i - 2]).alias(f"__b{i}_{n}") for n in names])
        summary = _prefix(summary, parent, keys[i - 1], {f"__b{i}_{n}": f"__p{i}_{n}" for n in names})
        tables.append(summary)

    # downward pass: entry level of each bucket = exclusive prefix applied to the parent's entry
    top = tables[-1]
    if per_site_init:
        inits = df.groupBy(site).agg(*[F.first(c).alias(f"__l0_{n}") for n, c in per_site_init.items()])
        top = top.join(inits, site)
    l0 = {n: init_lit[n] if n in init_lit else F.col(f"__l0_{n}") for n in names}
    wt = Window.partitionBy(site).orderBy(keys[-1])
    entry = top.select(site, keys[-1], *(runs if len(levels) == 1 else []), *[
        apply_map(F.coalesce(F.lag(f"__p{len(levels)}_{n}").over(wt), identity()), l0[n])
        .alias(f"__e_{n}") for n in names])
    for i in range(len(levels) - 1, 0, -1):
        t = tables[i]
        w = Window.partitionBy(site, *keys[i:]).orderBy(keys[i - 1])
        t = t.withColumns({f"__x_{n}": F.coalesce(F.lag(f"__p{i}_{n}").over(w), identity()) for n in names})
        entry = t.join(entry, [site, *keys[i:]]).select(
            site, *keys[i - 1:], *(runs if i == 1 else []), *[apply_map(F.col(f"__x_{n}"), F.col(f"__e_{n}")).alias(f"__e_{n}") for n in names])
    # join on exactly the keys the step table is partitioned on (coarser buckets are
    # implied by the finest), so a shuffle join never re-shuffles the steps
    entry = entry.select(site, keys[0], *runs, *[f"__e_{n}" for n in names])
    out = steps.join(entry, [site, keys[0]])
    out = out.withColumns({f"{n}_out": apply_map(F.col(f"__p0_{n}"), apply_map(F.get(F.col(f"__q_{n}"), F.col("__run")), F.col(f"__e_{n}"))) for n in names})
    ws = Window.partitionBy(site, keys[0]).orderBy(ts, *[f"__m_{n}" for n in names])
    out = out.withColumns({f"{n}_in": F.coalesce(F.lag(f"{n}_out").over(ws), F.col(f"__e_{n}")) for n in names})
    drop = [*keys, "__run"] + [f"__{k}_{n}" for n in names for k in ("m", "p0", "e", "q")]
    return out.drop(*drop)


def run_ledger(df: DataFrame, step_map: Column, initial: Column | float, *, site: str = "site_id",
               ts: str = "ts", level_in: str = "level_in", level_out: str = "level_out",
               levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Single-ledger form of ``run_ledgers``."""
    out = run_ledgers(df, {"__led": (step_map, initial)}, site=site, ts=ts, levels=levels)
    return out.withColumnsRenamed({"__led_in": level_in, "__led_out": level_out})


# ---------------------------------------------------------------------- R1
def battery_map(p: Params = DEFAULT, charge: str = "battery_charge", discharge: str = "battery_discharge") -> Column:
    """Charge (rate, headroom) then discharge (rate, floor) then self-discharge, as one map."""
    c, d = F.col(charge), F.col(discharge)
    eta_c, eta_d = p("battery_storage.charge_efficiency"), p("battery_storage.discharge_efficiency")
    lo, hi = p("battery_storage.min_level"), p("battery_storage.max_level")
    kc = F.least(c, p("battery_storage.max_charge_rate")) * eta_c
    kd = F.least(d, p("battery_storage.max_discharge_rate")) / eta_d
    # a NULL amount is no movement: Spark's least and greatest skip NULLs and would turn it into a bound
    m_c = F.when(c > 0, clamp_map(1.0, kc, None, hi)).otherwise(identity())
    m_d = F.when(d > 0, clamp_map(1.0, -kd, lo, None)).otherwise(identity())
    m_s = clamp_map(F.lit(1.0) - p("battery_storage.self_discharge_rate"), 0.0)
    return compose(compose(m_c, m_d), m_s)


def battery_details(level_in: Column, p: Params = DEFAULT, charge: str = "battery_charge",
                    discharge: str = "battery_discharge") -> dict[str, Column]:
    """Actual charge / discharge of a step, from the level it starts at."""
    c, d = F.col(charge), F.col(discharge)
    eta_c, eta_d = p("battery_storage.charge_efficiency"), p("battery_storage.discharge_efficiency")
    lo, hi = p("battery_storage.min_level"), p("battery_storage.max_level")
    a_c = F.when(c > 0, F.least(c, p("battery_storage.max_charge_rate"), (hi - level_in) / eta_c)).otherwise(F.lit(0.0))
    l1 = level_in + a_c * eta_c
    a_d = F.when(d > 0, F.least(d, p("battery_storage.max_discharge_rate"), (l1 - lo) * eta_d)).otherwise(F.lit(0.0))
    return {"battery_charge_actual": a_c, "battery_discharge_actual": a_d}


def battery_ledger(df: DataFrame, p: Params = DEFAULT, *, charge: str = "battery_charge",
                   discharge: str = "battery_discharge", site: str = "site_id", ts: str = "ts",
                   initial: Column | float | None = None, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Requested charge/discharge -> actual charge, discharge and battery level.

    Output columns ``battery_charge_actual``, ``battery_discharge_actual``,
    ``battery_level_in``, ``battery_level``.
    """
    init = initial if initial is not None else p.scalar("battery_storage.initial_level")
    led = run_ledger(df, battery_map(p, charge, discharge), init, site=site, ts=ts,
                     level_in="battery_level_in", level_out="battery_level", levels=levels)
    return led.withColumns(battery_details(F.col("battery_level_in"), p, charge, discharge))


# ---------------------------------------------------------------------- R2
def thermal_map(p: Params = DEFAULT, supply: str = "heat_supply", demand: str = "heat_demand") -> Column:
    b = F.col(supply) - F.col(demand)
    eta_c, eta_d = p("thermal_storage.charge_efficiency"), p("thermal_storage.discharge_efficiency")
    lo, hi = p("thermal_storage.min_level"), p("thermal_storage.max_level")
    moved = F.when(b > 0, clamp_map(1.0, b * eta_c, None, hi)).otherwise(clamp_map(1.0, b / eta_d, lo, None))
    return F.when(b.isNull(), identity()).otherwise(moved)


def thermal_details(level_in: Column, p: Params = DEFAULT, supply: str = "heat_supply",
                    demand: str = "heat_demand") -> dict[str, Column]:
    b = F.col(supply) - F.col(demand)
    eta_c, eta_d = p("thermal_storage.charge_efficiency"), p("thermal_storage.discharge_efficiency")
    lo, hi = p("thermal_storage.min_level"), p("thermal_storage.max_level")
    return {"thermal_storage_charge": F.when(b > 0, F.least(b, (hi - level_in) / eta_c)).otherwise(F.lit(0.0)),
            "thermal_storage_discharge": F.when(b <= 0, F.least(-b, (level_in - lo) * eta_d)).otherwise(F.lit(0.0))}


def thermal_ledger(df: DataFrame, p: Params = DEFAULT, *, supply: str = "heat_supply",
                   demand: str = "heat_demand", site: str = "site_id", ts: str = "ts",
                   initial: Column | float | None = None, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Heat surplus charges the store, deficit discharges it (with efficiencies and bounds).

    Output ``thermal_storage_charge``, ``thermal_storage_discharge``,
    ``thermal_storage_level_in``, ``thermal_storage_level``.
    """
    init = initial if initial is not None else p.scalar("thermal_storage.initial_level")
    led = run_ledger(df, thermal_map(p, supply, demand), init, site=site, ts=ts,
                     level_in="thermal_storage_level_in", level_out="thermal_storage_level", levels=levels)
    return led.withColumns(thermal_details(F.col("thermal_storage_level_in"), p, supply, demand))


def plant_ledgers(df: DataFrame, p: Params = DEFAULT, *, site: str = "site_id", ts: str = "ts") -> DataFrame:
    """R1 + R2 in a single scan (they are independent of each other)."""
    led = run_ledgers(df, {"battery": (battery_map(p), p.scalar("battery_storage.initial_level")),
                           "thermal": (thermal_map(p), p.scalar("thermal_storage.initial_level"))}, site=site, ts=ts)
    led = led.withColumnsRenamed({"battery_in": "battery_level_in", "battery_out": "battery_level",
                                  "thermal_in": "thermal_storage_level_in", "thermal_out": "thermal_storage_level"})
    led = led.withColumns(battery_details(F.col("battery_level_in"), p))
    return led.withColumns(thermal_details(F.col("thermal_storage_level_in"), p))
