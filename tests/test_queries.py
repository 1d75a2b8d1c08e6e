"""Driver contract at sf0.001: entry, every registered query against its DuckDB oracle, and plan checks
(no cartesian products, no Python, filters pushed into the scan)."""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck_conn

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of everything that is written while a query is built."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans = []
    for name in ("parquet", "csv", "json"):
        def write(self, *args, _write=getattr(DataFrameWriter, name), **kwargs):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return _write(self, *args, **kwargs)
        monkeypatch.setattr(DataFrameWriter, name, write)
    return plans


def faults(plan: str) -> list[str]:
    return [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "PythonUDF", "InArrow ", "InPandas ") if n in plan]


def all_queries_of_the_library():
    from tejado.catalog import all_queries
    return {name: fn for name, (fn, _sql) in all_queries().items()}


@needs_data
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "estado_comercial" in df.columns


@needs_data
def test_every_query_plan_and_oracle(spark, written_plans):
    con = duck_conn(SF)
    osql = entry.oracle_sql()
    failures = []
    for name, fn in all_queries_of_the_library().items():
        written_plans.clear()
        df = fn(spark, SF)
        for plan in [df._jdf.queryExecution().executedPlan().toString(), *written_plans]:
            failures += [(name, f) for f in faults(plan)]
        res = compare(name, df, osql.get(name), con)
        if name in osql and not res.get("ok"):
            failures.append(res)
        if "error" in res:
            failures.append(res)
    assert not failures, failures[:3]


@needs_data
def test_filters_reach_the_scan(spark):
    df = entry.queries()["flt01_declarative_filter"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(o_orderstatus, [F,O])" in plan
