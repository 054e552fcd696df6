"""P7 ``sun_position``: solar azimuth and altitude as closed-form columns.

Standard low-precision astronomical formulae (mean anomaly, ecliptic
longitude, declination, right ascension, sidereal time), evaluated with
built-in trig functions so the whole computation is code-generated — no
per-row Python.  Azimuth is measured from south, positive towards west;
both angles in radians; timestamps are taken as UTC.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAD = math.pi / 180.0
# Published constants of the low-precision solar position model.
J2000_UNIX_DAYS = 10957.5          # 2000-01-01 12:00 UTC in days since 1970-01-01
OBLIQUITY = 23.4397 * RAD
M0, M1 = 357.5291 * RAD, 0.98560028 * RAD
C1, C2, C3 = 1.9148 * RAD, 0.02 * RAD, 0.0003 * RAD
PERIHELION = 102.9372 * RAD
THETA0, THETA1 = 280.16 * RAD, 360.9856235 * RAD


def _days(ts: Column) -> Column:
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return us / F.lit(86_400_000_000.0) - F.lit(J2000_UNIX_DAYS)


def _anomaly(d: Column) -> Column:
    return F.lit(M0) + F.lit(M1) * d


def _longitude(m: Column) -> Column:
    c = F.lit(C1) * F.sin(m) + F.lit(C2) * F.sin(F.lit(2.0) * m) + F.lit(C3) * F.sin(F.lit(3.0) * m)
    return m + c + F.lit(PERIHELION) + F.lit(math.pi)


def _declination(lam: Column) -> Column:
    return F.asin(F.sin(lam) * F.lit(math.sin(OBLIQUITY)))


def _hour_angle(d: Column, lam: Column, lw: Column) -> Column:
    ra = F.atan2(F.sin(lam) * F.lit(math.cos(OBLIQUITY)), F.cos(lam))
    sidereal = F.lit(THETA0) + F.lit(THETA1) * d - lw
    return sidereal - ra


def _place(lat: Column | float, lon: Column | float) -> tuple[Column, Column]:
    phi = (lat if isinstance(lat, Column) else F.lit(float(lat))) * F.lit(RAD)
    return phi, -(lon if isinstance(lon, Column) else F.lit(float(lon))) * F.lit(RAD)


def _azimuth_altitude(h: Column, dec: Column, phi: Column) -> tuple[Column, Column]:
    azimuth = F.atan2(F.sin(h), F.cos(h) * F.sin(phi) - F.tan(dec) * F.cos(phi))
    altitude = F.asin(F.sin(phi) * F.sin(dec) + F.cos(phi) * F.cos(dec) * F.cos(h))
    return azimuth, altitude


def sun_position_cols(ts, lat: Column | float, lon: Column | float) -> tuple[Column, Column]:
    phi, lw = _place(lat, lon)
    d = _days(F.col(ts) if isinstance(ts, str) else ts)
    lam = _longitude(_anomaly(d))
    return _azimuth_altitude(_hour_angle(d, lam, lw), _declination(lam), phi)


def sun_position(df: DataFrame, lat: Column | float, lon: Column | float, ts: str = "ts") -> DataFrame:
    """Adds ``azimuth`` and ``altitude`` (radians).

    Each term that is used more than once is a column first: as one expression the terms are
    written out many times over, too long a method to be compiled behind an aggregate.
    """
    phi, lw = _place(lat, lon)
    c = F.col
    f = df.withColumns({"__phi": phi, "__lw": lw, "__d": _days(c(ts))})
    f = f.withColumn("__m", _anomaly(c("__d"))).withColumn("__lam", _longitude(c("__m")))
    f = f.withColumns({"__h": _hour_angle(c("__d"), c("__lam"), c("__lw")), "__dec": _declination(c("__lam"))})
    az, alt = _azimuth_altitude(c("__h"), c("__dec"), c("__phi"))
    return f.withColumn("sun", F.struct(az.alias("azimuth"), alt.alias("altitude"))) \
        .select("*", "sun.*").drop("sun", "__phi", "__lw", "__d", "__m", "__lam", "__h", "__dec")


SQL_DAYS = "(date_diff('microsecond', TIMESTAMP '1970-01-01 00:00:00', {ts}) / 86400000000.0::DOUBLE - {j2000}::DOUBLE)"


def sql_sun_position(ts: str, lat: str, lon: str) -> tuple[str, str]:
    """DuckDB mirror of ``sun_position_cols`` (returns azimuth, altitude expressions)."""
    d = SQL_DAYS.format(ts=ts, j2000=repr(J2000_UNIX_DAYS))
    r = repr
    m = f"({r(M0)}::DOUBLE + {r(M1)}::DOUBLE * {d})"
    c = f"({r(C1)}::DOUBLE * sin({m}) + {r(C2)}::DOUBLE * sin(2.0::DOUBLE * {m}) + {r(C3)}::DOUBLE * sin(3.0::DOUBLE * {m}))"
    lam = f"({m} + {c} + {r(PERIHELION)}::DOUBLE + {r(math.pi)}::DOUBLE)"
    dec = f"asin(sin({lam}) * {r(math.sin(OBLIQUITY))}::DOUBLE)"
    ra = f"atan2(sin({lam}) * {r(math.cos(OBLIQUITY))}::DOUBLE, cos({lam}))"
    phi = f"(({lat}) * {r(RAD)}::DOUBLE)"
    lw = f"(-({lon}) * {r(RAD)}::DOUBLE)"
    h = f"({r(THETA0)}::DOUBLE + {r(THETA1)}::DOUBLE * {d} - {lw} - {ra})"
    az = f"atan2(sin({h}), cos({h}) * sin({phi}) - tan({dec}) * cos({phi}))"
    alt = f"asin(sin({phi}) * sin({dec}) + cos({phi}) * cos({dec}) * cos({h}))"
    return az, alt
