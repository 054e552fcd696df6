"""Every registered query against its DuckDB oracle on the smallest test tables,
the driver entry point, and rows-only runs of the model queries."""

import importlib.util
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from plantframe.plans import forecast as fc  # noqa: E402

spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_a_unique_key():
    assert len(QUERIES) >= 85
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    sp = QUERIES[key](spark, SF).toPandas()
    dd = duck.execute(ORACLES[key]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert check.frame_hash(sp) == check.frame_hash(dd)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_model_query_runs(spark, key, monkeypatch):
    # runs the plans; the fits' results are checked in test_models
    for fit in (fc.gbt_pipeline, fc.fit_gbt_vector):
        if fit.__kwdefaults__:
            monkeypatch.setitem(fit.__kwdefaults__, "rounds", 5)
    monkeypatch.setattr(fc, "GBT_ROUNDS", 5)
    df = QUERIES[key](spark, SF)
    assert df.count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "residual" in df.columns
