"""Joins (J1–J7).

* J1 ``join_plan_inputs``: 4-way equi-join on (site, ts).
* J5 ``asof_nearest`` is ``series.align_nearest``.
* J7 ``params_cross`` is in ``sources.params``.

Equi-joins on (site, ts) are left to Catalyst/AQE (sort-merge, converted to
broadcast at run time when one side turns out small, skew-split when a key
is hot).  Only tables bounded by construction (holiday dates) are broadcast
explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantframe.functions import profiles
from plantframe.operators.series import align_nearest, with_position

asof_nearest = align_nearest  # J5


# ---------------------------------------------------------------------- J1
def join_plan_inputs(demand: DataFrame, price: DataFrame, weather: DataFrame | None, control: DataFrame | None, *,
                     site: str = "site_id", ts: str = "ts") -> DataFrame:
    """Inner equi-join of demand, price, weather and control on (site, ts).

    A missing weather or control table is replaced by the default profile on
    the demand stamps (S2 fallback) instead of being joined.
    """
    keys = [site, ts]
    out = demand.join(price, keys)
    out = out.join(weather, keys) if weather is not None else profiles.with_default_weather(out, ts)
    return out.join(control, keys) if control is not None else profiles.with_default_control(out, ts)


# ---------------------------------------------------------------------- J2
def join_weather_inner(series: DataFrame, weather: DataFrame, *, left_ts: str = "date_time",
                       right_ts: str = "time", site: str = "site_id") -> DataFrame:
    """Inner join on differently named time keys (and the site)."""
    cond = (series[site] == weather[site]) & (series[left_ts] == weather[right_ts])
    return series.join(weather, cond, "inner").drop(weather[site]).drop(weather[right_ts])


# ---------------------------------------------------------------------- J3
def join_weather_left(series: DataFrame, weather: DataFrame | None, *, site: str = "site_id",
                      ts: str = "ts", weather_cols: list[str] | None = None) -> DataFrame:
    """Left join on (site, ts); an absent weather table yields NULL weather columns."""
    if weather is None:
        return series.withColumns({c: F.lit(None).cast("double") for c in (weather_cols or [])})
    return series.join(weather, [site, ts], "left")


# ---------------------------------------------------------------------- J4
def holiday_membership(df: DataFrame, holidays: DataFrame, *, ts: str = "ts", date_col: str = "date",
                       keep: bool = True) -> DataFrame:
    """Rows whose date is (``keep``) or is not a holiday: semi / anti join, strategy left to Spark."""
    h = holidays.select(F.col(date_col).alias("__hday")).distinct()
    how = "left_semi" if keep else "left_anti"
    return df.join(h, F.to_date(F.col(ts)) == F.col("__hday"), how)


# ---------------------------------------------------------------------- J6
def positional_zip(left: DataFrame, right: DataFrame, *, site: str = "site_id", ts: str = "ts",
                   chunk: str = "day", right_ts: str = "right_ts") -> DataFrame:
    """Pair the k-th row of ``left`` with the k-th row of ``right`` per site (shorter side wins).

    Positions come from the skew-safe positional index; the pairing is an
    equi-join on (site, pos).
    """
    lp = with_position(left, site=site, ts=ts, pos="pos", chunk=chunk)
    rp = with_position(right, site=site, ts=ts, pos="pos", chunk=chunk).withColumnRenamed(ts, right_ts)
    return lp.join(rp, [site, "pos"], "inner")
