"""S3 ``params_table`` and J7 ``params_cross``: plant parameters as a DataFrame.

Parameters are a nested JSON document.  We read it with the JSON source into
one row of nested structs (or one row per site), fill every missing field
from the defaults below, and attach it to step tables: the one-row table by broadcast, a per-site table
by an equi-join that AQE broadcasts once it has measured the table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantframe.operators.chunks import spread_join

# Default plant parameters, equal to the reference's shipped
# parameter file (system_parameters, forecasting, optimization sections).
DEFAULT_PARAMETERS = {
    "system_parameters": {
        "chp": {"P_max": 200.0, "Q_max": 300.0, "eta_el": 0.35, "eta_th": 0.50,
                "eta_total": 0.85, "alpha": 1.5},
        "boiler": {"Q_max": 400.0, "eta": 0.90},
        "thermal_storage": {"capacity": 2000.0, "initial_level": 1000.0,
                            "charge_efficiency": 0.95, "discharge_efficiency": 0.95,
                            "min_level": 100.0, "max_level": 1900.0},
        "battery_storage": {"capacity": 100.0, "initial_level": 50.0,
                            "charge_efficiency": 0.92, "discharge_efficiency": 0.92,
                            "min_level": 10.0, "max_level": 95.0,
                            "max_charge_rate": 50.0, "max_discharge_rate": 50.0,
                            "self_discharge_rate": 0.001},
        "photovoltaic": {"peak_power": 150.0, "efficiency": 0.18, "tilt_angle": 35.0,
                         "azimuth": 180.0, "temperature_coefficient": -0.004,
                         "inverter_efficiency": 0.96, "soiling_factor": 0.95,
                         "shading_factor": 0.98},
        "heat_pump": {"Q_max": 250.0, "P_max": 60.0, "cop_nominal": 4.2, "cop_min": 2.5,
                      "cop_max": 5.5, "min_outdoor_temp": -20.0, "max_outdoor_temp": 35.0,
                      "min_water_temp": 30.0, "max_water_temp": 65.0, "defrost_power": 2.0},
        "electric_heaters": {"Q_max": 200.0, "eta": 0.99, "stages": 3,
                             "stage_powers": [50.0, 75.0, 75.0],
                             "min_water_temp": 30.0, "max_water_temp": 85.0},
        "economics": {"fuel_price": 0.03, "electricity_price_buy": 0.25,
                      "electricity_price_sell": 0.08, "maintenance_cost_chp": 0.005,
                      "maintenance_cost_boiler": 0.002, "maintenance_cost_heat_pump": 0.003,
                      "maintenance_cost_pv": 0.001, "battery_degradation_cost": 0.02},
    },
    "forecasting": {"horizon": 24, "update_frequency": "hourly",
                    "weather_api": {"lat": 53.5511, "lon": 9.9937,
                                    "timezone": "Europe/Berlin"}},
    "optimization": {"methods": ["linear_programming", "reinforcement_learning"],
                     "default_method": "linear_programming",
                     "constraints": {"min_uptime": 2, "min_downtime": 1, "ramp_rate": 0.2,
                                     "grid_connection_limit": 100.0,
                                     "battery_cycle_limit": 5000}},
}


def _schema_of(value) -> T.DataType:
    if isinstance(value, dict):
        return T.StructType([T.StructField(k, _schema_of(v), True) for k, v in value.items()])
    if isinstance(value, list):
        elem = value[0] if value else ""
        return T.ArrayType(_schema_of(elem), True)
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    return T.StringType()


PARAMS_SCHEMA: T.StructType = _schema_of(DEFAULT_PARAMETERS)  # type: ignore[assignment]


def _literal(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return F.array(*[_literal(v, dtype.elementType) for v in value]).cast(dtype)
    return F.lit(value).cast(dtype)


def _fill(col: Column, default, dtype: T.DataType) -> Column:
    """Recursively coalesce every leaf of ``col`` with the default value."""
    if isinstance(dtype, T.StructType):
        return F.when(F.lit(True), F.struct(*[
            _fill(col.getField(f.name), default[f.name], f.dataType).alias(f.name)
            for f in dtype.fields]))
    return F.coalesce(col, _literal(default, dtype))


def with_defaults(df: DataFrame, col: str = "params") -> DataFrame:
    """Fill every missing parameter leaf of struct column ``col`` from the defaults."""
    return df.withColumn(col, _fill(F.col(col), DEFAULT_PARAMETERS, PARAMS_SCHEMA))


def parse_params_json(df: DataFrame, json_col: str, out: str = "params") -> DataFrame:
    """JSON text column -> typed, default-filled parameter struct column."""
    parsed = df.withColumn(out, F.from_json(F.col(json_col), PARAMS_SCHEMA))
    return with_defaults(parsed, out)


def with_overrides(df: DataFrame, overrides: dict[str, float], col: str = "params") -> DataFrame:
    """Per-run scalar overrides, e.g. ``{"chp.P_max": 250.0}`` (paths under ``system_parameters``).

    Applied with ``withField`` on the nested struct: no re-parse, no join.
    """
    c = F.col(col)
    for path, value in overrides.items():
        c = c.withField(f"system_parameters.{path}", F.lit(value).cast("double"))
    return df.withColumn(col, c)


def read_params(spark: SparkSession, path: str | None = None) -> DataFrame:
    """S3: one-row parameter table from a (multi-line) JSON file, or the defaults."""
    if path is None:
        df = spark.createDataFrame([(json.dumps(DEFAULT_PARAMETERS),)], "j string")
        return parse_params_json(df, "j").select("params")
    raw = spark.read.option("multiLine", True).schema(PARAMS_SCHEMA).json(path)
    packed = raw.select(F.struct(*[F.col(f.name) for f in PARAMS_SCHEMA.fields]).alias("params"))
    return with_defaults(packed)


def default_params(spark: SparkSession) -> DataFrame:
    return read_params(spark, None)


def flat_system_params(params: DataFrame, col: str = "params") -> DataFrame:
    """Flatten ``system_parameters.<group>.<field>`` to ``<group>__<field>`` columns."""
    sys_t = PARAMS_SCHEMA["system_parameters"].dataType
    cols = []
    for g in sys_t.fields:
        for f in g.dataType.fields:
            cols.append(F.col(f"{col}.system_parameters.{g.name}.{f.name}").alias(f"{g.name}__{f.name}"))
    keep = [c for c in params.columns if c != col]
    return params.select(*keep, *cols)


def params_cross(df: DataFrame, params: DataFrame, site: str = "site_id") -> DataFrame:
    """Attach parameters to every row.

    A table without sites must have one row, which is checked in the plan; it
    is cross-joined by broadcast.  A per-site table (has a ``site`` column) is equi-joined on the
    site; a site's rows are dealt to several keys, so a hot site is no task of its own.
    """
    if site in params.columns:
        return spread_join(df, params, [site])
    # folded to exactly one row in the plan; a table of any other length fails there instead of losing rows
    one = params.agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*params.columns)).alias("__p"))
    checked = one.select(F.when(F.col("__n") == 1, F.col("__p")).otherwise(
        F.raise_error(F.concat(F.lit("params without a site column need exactly one row, not "), F.col("__n").cast("string")))).alias("__p"))
    return df.crossJoin(F.broadcast(checked)).select(*df.columns, "__p.*")
