"""Sequence-sample builders, splits and scaling.

Sliding windows are bounded frames (``rowsBetween(-w, k)``).  Rather than
one window per site, rows get a 0-based position (skew-safe, see
``chunks.positional_index``), are cut into position chunks of
``rows_per_chunk`` rows, and each chunk receives copies of the ``w``
neighbouring rows it needs (``chunks.halo_partition``).  The window then
runs per ``(site, chunk)`` and the copies are dropped.

A NULL target keeps its place in a window; ``nulls="drop"`` leaves out the
windows of targets that hold one, for models that cannot take it.

Window samples multiply the data by ``w``; build them only in the plan that
feeds a model and never persist them.  Scaler statistics are a per-site
table joined back (AQE broadcasts it when small enough, measured at run
time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantframe.operators import chunks
from plantframe.operators.series import with_position


def _windowed(df: DataFrame, site: str, ts: str, lookback: int, lookahead: int,
              rows_per_chunk: int, chunk: str) -> tuple[DataFrame, Window]:
    pos = with_position(df, site=site, ts=ts, pos="__pos", chunk=chunk)
    halo = chunks.halo_partition(pos, site, "__pos", lookback, lookahead, rows_per_chunk)
    w = Window.partitionBy(site, "_pchunk").orderBy("__pos")
    return halo, w


def _finish(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_halo", "_pchunk")


def _list(value: Column, frame) -> Column:
    """Values of the frame in order.  ``collect_list`` leaves NULLs out, so each travels in a struct."""
    return F.transform(F.collect_list(F.struct(value.alias("v"))).over(frame), lambda s: s["v"])


def _full(column: str, nulls: str) -> Column:
    """Whether a window may be used: ``nulls="keep"`` takes all, ``"drop"`` only those without a NULL."""
    if nulls not in ("keep", "drop"):
        raise ValueError(nulls)
    return F.lit(True) if nulls == "keep" else ~F.exists(column, lambda v: v.isNull())


def _struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(c) for c in cols])


# ---------------------------------------------------------------------- W1
def seq_to_seq_windows(df: DataFrame, features: Sequence[str], target: str, w: int, *,
                       site: str = "site_id", ts: str = "ts", rows_per_chunk: int = 4096,
                       chunk: str = "day", nulls: str = "keep") -> DataFrame:
    """Anchor i in [w, n − w]: x = features of rows i−w..i−1, y = target of rows i..i+w−1."""
    halo, win = _windowed(df, site, ts, w, w - 1, rows_per_chunk, chunk)
    out = halo.select(
        site, "_pchunk", "_halo", "__pos", F.col(ts).alias("anchor_ts"),
        F.collect_list(_struct(features)).over(win.rowsBetween(-w, -1)).alias("x"),
        _list(F.col(target), win.rowsBetween(0, w - 1)).alias("y"),
        F.collect_list(F.col(ts)).over(win.rowsBetween(0, w - 1)).alias("y_ts"))
    out = out.filter((F.size("x") == w) & (F.size("y") == w) & _full("y", nulls))
    return _finish(out).withColumnRenamed("__pos", "anchor_pos")


# ---------------------------------------------------------------------- W2
def feature_windows_next(df: DataFrame, features: Sequence[str], target: str, w: int, *,
                         site: str = "site_id", ts: str = "ts", rows_per_chunk: int = 4096,
                         chunk: str = "day") -> DataFrame:
    """i >= w: x = features of the previous w rows, y = target[i]."""
    halo, win = _windowed(df, site, ts, w, 0, rows_per_chunk, chunk)
    out = halo.select(site, "_pchunk", "_halo", "__pos", F.col(ts).alias("anchor_ts"),
                      F.collect_list(_struct(features)).over(win.rowsBetween(-w, -1)).alias("x"),
                      F.col(target).alias("y"))
    return _finish(out.filter(F.size("x") == w)).withColumnRenamed("__pos", "anchor_pos")


# ---------------------------------------------------------------------- W3
def lag_windows_next(df: DataFrame, target: str, w: int, *, site: str = "site_id", ts: str = "ts",
                     rows_per_chunk: int = 4096, chunk: str = "day", flat: bool = False, nulls: str = "keep") -> DataFrame:
    """x = the previous w targets (oldest first), y = target[i].  ``flat`` adds lag_1..lag_w columns."""
    halo, win = _windowed(df, site, ts, w, 0, rows_per_chunk, chunk)
    out = halo.select(site, "_pchunk", "_halo", "__pos", F.col(ts).alias("anchor_ts"),
                      _list(F.col(target), win.rowsBetween(-w, -1)).alias("x"),
                      F.col(target).alias("y"))
    out = _finish(out.filter((F.size("x") == w) & _full("x", nulls))).withColumnRenamed("__pos", "anchor_pos")
    if flat:
        out = out.withColumns({f"lag_{k}": F.element_at("x", w - k + 1) for k in range(1, w + 1)})
    return out


# ---------------------------------------------------------------------- W4
def lag_plus_current_windows(df: DataFrame, features: Sequence[str], target: str, w: int, *,
                             site: str = "site_id", ts: str = "ts", rows_per_chunk: int = 4096,
                             chunk: str = "day", nulls: str = "keep") -> DataFrame:
    """x = w rows of (past target, current features), y = target[i]."""
    halo, win = _windowed(df, site, ts, w, 0, rows_per_chunk, chunk)
    out = halo.select(site, "_pchunk", "_halo", "__pos", F.col(ts).alias("anchor_ts"),
                      _list(F.col(target), win.rowsBetween(-w, -1)).alias("lags"),
                      *[F.col(f) for f in features], F.col(target).alias("y"))
    out = _finish(out.filter((F.size("lags") == w) & _full("lags", nulls))).withColumnRenamed("__pos", "anchor_pos")
    x = F.transform("lags", lambda v: F.struct(v.alias(target), *[F.col(f).alias(f) for f in features]))
    return out.select(site, "anchor_ts", "anchor_pos", x.alias("x"), "y")


# ---------------------------------------------------------------------- W5
def lag_concat_current(df: DataFrame, features: Sequence[str], target: str, w: int, *,
                       site: str = "site_id", ts: str = "ts", rows_per_chunk: int = 4096,
                       chunk: str = "day", nulls: str = "keep") -> DataFrame:
    """Flat x = w previous targets ++ current raw features (length w + len(features))."""
    halo, win = _windowed(df, site, ts, w, 0, rows_per_chunk, chunk)
    out = halo.select(site, "_pchunk", "_halo", "__pos", F.col(ts).alias("anchor_ts"),
                      _list(F.col(target).cast("double"), win.rowsBetween(-w, -1)).alias("lags"),
                      F.array(*[F.col(f).cast("double") for f in features]).alias("cur"),
                      F.col(target).alias("y"))
    out = _finish(out.filter((F.size("lags") == w) & _full("lags", nulls))).withColumnRenamed("__pos", "anchor_pos")
    return out.select(site, "anchor_ts", "anchor_pos", F.concat("lags", "cur").alias("x"), "y")


# ---------------------------------------------------------------------- W6
def aligned_one_to_one(features: DataFrame, targets: DataFrame, target: str, *, site: str = "site_id",
                       ts: str = "ts", chunk: str = "day") -> DataFrame:
    """x = feature row k, y = target row k, by position, truncated to the shorter side."""
    from plantframe.operators.joins import positional_zip
    return positional_zip(features, targets.select(site, ts, target), site=site, ts=ts, chunk=chunk)


# ---------------------------------------------------------------------- W7
def chrono_split(df: DataFrame, train: float = 0.7, val: float = 0.15, *, site: str = "site_id",
                 ts: str = "ts", chunk: str = "day", out: str = "split") -> DataFrame:
    """First ⌊0.7n⌋ rows train, next ⌊0.15n⌋ val, rest test (per site, in time order)."""
    pos = with_position(df, site=site, ts=ts, pos="__pos", chunk=chunk, with_count="__n")
    n_train = F.floor(F.col("__n") * F.lit(train))
    n_val = F.floor(F.col("__n") * F.lit(val))
    split = (F.when(F.col("__pos") < n_train, F.lit("train"))
             .when(F.col("__pos") < n_train + n_val, F.lit("val")).otherwise(F.lit("test")))
    return pos.withColumn(out, split).drop("__pos", "__n")


# ---------------------------------------------------------------------- W8
def hash_bucket(*keys: str) -> Column:
    """0..99 bucket from the first 8 hex digits of md5(key) — layout independent."""
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("long"), F.lit(100))


def random_split(df: DataFrame, keys: Sequence[str], train: float = 0.7, out: str = "split") -> DataFrame:
    """70/30 split by a hash of the row key (reproducible on any layout, unlike randomSplit)."""
    return df.withColumn(out, F.when(hash_bucket(*keys) < F.lit(int(round(train * 100))), F.lit("train"))
                         .otherwise(F.lit("test")))


# ---------------------------------------------------------------------- W9
def minmax_fit(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",)) -> DataFrame:
    return df.groupBy(*by).agg(*[F.min(c).alias(f"{c}__min") for c in cols],
                               *[F.max(c).alias(f"{c}__max") for c in cols])


def minmax_apply(df: DataFrame, stats: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",)) -> DataFrame:
    """(x − min)/(max − min); a constant column maps to 0."""
    j = chunks.spread_join(df, stats, by)
    out = {c: F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}__min"),
                                      F.when(F.col(f"{c}__max") != F.col(f"{c}__min"),
                                             F.col(f"{c}__max") - F.col(f"{c}__min"))),
                         F.when(F.col(c).isNotNull(), F.lit(0.0))) for c in cols}
    return j.withColumns(out).drop(*[f"{c}__min" for c in cols], *[f"{c}__max" for c in cols])


def minmax_scale(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",)) -> DataFrame:
    return minmax_apply(df, minmax_fit(df, cols, by), cols, by)


# --------------------------------------------------------------------- W10
def standard_fit(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",)) -> DataFrame:
    """Mean and population std per group; std 0 is stored as 1."""
    return df.groupBy(*by).agg(
        *[F.avg(c).alias(f"{c}__mean") for c in cols],
        *[F.when(F.stddev_pop(c) == 0, F.lit(1.0)).otherwise(F.stddev_pop(c)).alias(f"{c}__std") for c in cols])


def standard_apply(df: DataFrame, stats: DataFrame, cols: Sequence[str], by: Sequence[str] = ("site_id",),
                   keep_stats: bool = False) -> DataFrame:
    j = chunks.spread_join(df, stats, by)
    out = j.withColumns({c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std") for c in cols})
    if keep_stats:
        return out
    return out.drop(*[f"{c}__mean" for c in cols], *[f"{c}__std" for c in cols])


def standard_scale_train(df: DataFrame, cols: Sequence[str], split: str = "split",
                         by: Sequence[str] = ("site_id",)) -> tuple[DataFrame, DataFrame]:
    """Fit on the train rows only, apply to all rows; returns (scaled, stats)."""
    stats = standard_fit(df.filter(F.col(split) == "train"), cols, by)
    return standard_apply(df, stats, cols, by), stats


# --------------------------------------------------------------------- W11
def inverse_scale_target(df: DataFrame, stats: DataFrame, col: str, by: Sequence[str] = ("site_id",),
                         out: str | None = None) -> DataFrame:
    """z·std + mean for one column."""
    s = stats.select(*by, f"{col}__mean", f"{col}__std")
    j = chunks.spread_join(df, s, by)
    return j.withColumn(out or col, F.col(col) * F.col(f"{col}__std") + F.col(f"{col}__mean")) \
        .drop(f"{col}__mean", f"{col}__std")
