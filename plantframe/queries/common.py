"""Registry of named queries over the test tables, each with its DuckDB oracle.

``register(key, sql)`` stores a ``(spark, sf_dir) -> DataFrame`` builder and
the equivalent DuckDB SQL (``None`` for keys checked by rows only).  Output
conventions shared by both sides: doubles quantised to 4 places, integers as
BIGINT, every column aliased.

Quantising: ``floor(x·10⁴ + 0.2345678) / 10⁴``.  Plain half-up rounding puts
its cut points exactly on short decimals such as ``…0.00005``, which the
plant arithmetic produces all the time, so 1e-13 differences in summation
order flip the last digit.  The offset moves every cut point to a value no
short decimal hits, and short decimals map to themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = (fn, sql)
        return fn
    return deco


QUANT_OFFSET = 0.2345678


def r4(c: Column | str) -> Column:
    """Quantise a double to 4 places (same rule as ``R4`` in the oracle SQL)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(10000.0) + F.lit(QUANT_OFFSET)) / F.lit(10000.0)


def R4(expr: str) -> str:
    return f"(floor(({expr}) * 10000.0::DOUBLE + {QUANT_OFFSET}::DOUBLE) / 10000.0::DOUBLE + 0.0::DOUBLE)"


def round_doubles(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """Apply ``r4`` to every double column; cast int columns to BIGINT; dates to ``yyyy-MM-dd`` text
    (DATE values reach pandas as ``datetime.date`` from Spark but as timestamps from DuckDB)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if f.name in skip:
            out.append(F.col(f.name))
        elif t in ("double", "float"):
            out.append(r4(F.col(f.name).cast("double")).alias(f.name))
        elif t in ("int", "smallint", "tinyint"):
            out.append(F.col(f.name).cast("long").alias(f.name))
        elif t == "date":
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def all_queries() -> dict[str, QueryFn]:
    _load()
    return {k: v[0] for k, v in REGISTRY.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load() -> None:
    # importing the modules fills REGISTRY
    from plantframe.queries import (  # noqa: F401
        q_aggregates, q_joins, q_ledger, q_models, q_projections, q_samples, q_series, q_sources)
