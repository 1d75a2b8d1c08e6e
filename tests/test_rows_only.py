"""Brute-force checks on the sf0.001 tables, independent of the SQL oracles: plain Python, pandas and pyarrow."""

import os

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tejado.functions.contacts import DOMAIN_TYPOS, closest_domain
from tejado.plans.adapters import view

from conftest import one_col

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not present")


def test_closest_domain(spark):
    near = {"gmaill.com": "gmail.com", "gnail.com": "gmail.com", "hotmil.com": "hotmail.com", "contraloria.gob.pr": "contraloria.gob.pe",
            "contralora.gob.p": "contraloria.gob.pe", "live.co": "live.com", "gnaill.com": None, "outlook.es": None, "gmail.com": None, "empresa.pe": None, "": None, None: None}
    assert one_col(spark, list(near), closest_domain) == list(near.values())
    assert "gmial.com" in DOMAIN_TYPOS


def test_run_summary_counts_match_pandas(spark):
    from tejado.catalog.report_queries import PROJECTS, _park
    from tejado.plans.parking import run_summary
    procesos, rel, risk, flats = _park(spark, SF)
    row = run_summary(procesos, PROJECTS).first()
    assert row["filas_procesos_originales"] == len(procesos.toPandas())
    assert row["filas_procesos_activos_relevantes"] == rel.count()
    r = risk.toPandas()
    assert row["filas_cocheras_activas_sin_unidad_asignada"] == len(r)
    assert row["filas_departamentos_activos"] == flats.count()
    assert dict(row["cocheras_por_proyecto"]) == r["nombre_proyecto"].fillna("None").value_counts().to_dict()
    assert run_summary(procesos.limit(0), PROJECTS).first()["filas_procesos_originales"] == 0


def test_file_order_matches_pyarrow(spark):
    got = entry.queries()["wd06_file_order"](spark, SF).toPandas().sort_values("fila")
    keys = pq.read_table(f"{SF}/orders.parquet", columns=["o_orderkey"]).column(0).to_pylist()
    assert got["o_orderkey"].tolist() == keys and got["fila"].tolist() == list(range(len(keys)))


def test_display_headers_and_master_rebuild(spark):
    q = entry.queries()
    shown = q["prj09_display_headers"](spark, SF)
    stock = q["job03_stock"](spark, SF)
    assert shown.count() == stock.count() and "Estado comercial (2)" in shown.columns and "estado comercial" in shown.columns
    rebuilt = {r["__empresa"]: r["filas"] for r in q["snk10_master_rebuild"](spark, SF).collect()}
    enriched = q["job09_ledger_by_company"](spark, SF).toPandas()
    expected = enriched["source_company"].fillna("SIN_COMPANY").value_counts().to_dict()
    assert rebuilt == expected and sum(rebuilt.values()) == view(spark, SF, "ledger").count()
