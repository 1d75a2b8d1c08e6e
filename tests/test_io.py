"""Readers and writers (SRC-01..04, SRC-06, SNK-03..06, SNK-08, SNK-11) on small files in a temp folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tejado.plans import extraction as xt
from tejado.sinks import writers as wr
from tejado.sources import readers as rd


def test_csv_with_bom_and_optional_tables(spark, tmp_path):
    base = tmp_path / "raw"
    base.mkdir()
    (base / "leads.csv").write_bytes("﻿Nombre,Correo\nAna,a@b.pe\n".encode("utf-8"))
    df = rd.read_optional(spark, str(base), "leads")
    assert df.columns == ["nombre", "correo"] and rows(df) == [("Ana", "a@b.pe")]  # BOM gone, names normalised
    empty = rd.read_optional(spark, str(base), "absent", schema="a string")
    assert empty.count() == 0 and empty.columns == ["a"]


def test_required_and_by_extension(spark, tmp_path):
    with pytest.raises(rd.MissingTable):
        rd.read_required(spark, str(tmp_path / "nope.parquet"))
    with pytest.raises(ValueError):
        rd.read_by_extension(spark, str(tmp_path / "x.xlsx"))
    p = str(tmp_path / "t.json")
    spark.createDataFrame([(1, "a")], "id long, `Some Name` string").write.json(p)
    df = rd.read_by_extension(spark, p, required=["id", "some_name"])
    assert sorted(df.columns) == ["id", "some_name"]
    with pytest.raises(KeyError):
        rd.read_by_extension(spark, p, required=["missing"])


def test_write_formats_and_void_columns(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int").withColumn("v", F.lit(None))
    out = wr.write_table(df, str(tmp_path / "t"), "both")
    assert len(out) == 2 and dict(spark.read.parquet(out[-1]).dtypes)["v"] == "string"
    with pytest.raises(ValueError):
        wr.write_table(df, str(tmp_path / "u"), "xlsx")


def test_split_by_group_labels_blank_and_null(spark, tmp_path):
    long = "x" * 100
    names = ["Ana", "  ", None, " Ana ", "Luis/Ruiz", "Luis:Ruiz", "ANA", long + "a", long + "b"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "asesor string, i int")
    man = wr.split_by_group(df, "asesor", str(tmp_path / "out"))
    got = rows(man, "grupo", "filas")
    assert got[:2] == [("Ana", 2), ("Sin Asesor", 2)]
    assert sorted(got[2:]) == sorted([("Luis/Ruiz", 1), ("Luis:Ruiz", 1), ("ANA", 1), (long + "a", 1), (long + "b", 1)])
    labels = [r[0].lower() for r in rows(man, "etiqueta")]
    assert len(set(labels)) == len(labels) and max(map(len, labels)) <= 80
    for grupo, carpeta in rows(man, "grupo", "carpeta"):
        held = spark.read.parquet(carpeta)
        assert {(r[0] or "").strip() or "Sin Asesor" for r in rows(held, "asesor")} == {grupo}


def test_versioned_writes_and_log(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    wr.write_versioned(df, str(tmp_path / "t"), str(tmp_path / "led"), "t", stamp="20240101")
    second = wr.write_versioned(df.union(df), str(tmp_path / "t"), str(tmp_path / "led"), "t", stamp="20240102")
    assert wr.current_version(spark, str(tmp_path / "led"), "t") == second
    with pytest.raises(Exception):
        wr.write_versioned(df, str(tmp_path / "t"), str(tmp_path / "led"), "t", stamp="20240102")  # never overwrite
    wr.log_event(spark, str(tmp_path / "log"), "lib", "paso", "ok", "m", {"filas": 3})
    wr.log_event(spark, str(tmp_path / "log"), "lib", "paso2", "error", "m2")
    log = spark.read.schema(wr.LOG_SCHEMA).json(str(tmp_path / "log"))
    assert sorted(rows(log, "paso", "estado")) == [("paso", "ok"), ("paso2", "error")]


def test_daily_extract_cache_and_force(spark, tmp_path):
    src = {"t": lambda: spark.range(7)}
    day = dt.date(2026, 1, 2)
    raw, led = str(tmp_path / "raw"), str(tmp_path / "led")
    assert rows(xt.daily_extract(spark, src, raw, led, today=day), "estado", "filas") == [("extracted", 7)]
    assert rows(xt.daily_extract(spark, src, raw, led, today=day), "estado", "filas") == [("skipped_cache_today", 7)]
    assert rows(xt.daily_extract(spark, src, raw, led, today=day, force=True), "estado") == [("extracted",)]
    assert rows(xt.daily_extract(spark, src, raw, led, today=day + dt.timedelta(days=1)), "estado") == [("extracted",)]
    with pytest.raises(ValueError):
        xt.safe_identifier("clientes; drop table x")


def test_sample_rows_anonymised(spark, tmp_path):
    df = spark.createDataFrame([(3, "c", "x"), (1, "a", "y"), (2, "b", None)], "k int, email string, otro string")
    out = rows(wr.sample_rows(df, ["k"], 2))
    assert [r[0] for r in out] == [1, 2] and all(r[1].startswith("anon_") for r in out) and out[0][2] == "y"
    report = wr.export_samples({"ok": (df, ["k"]), "bad": (df, ["nope"])}, str(tmp_path / "s"))
    assert report[0]["estado"] == "ok" and report[1]["estado"].startswith("error")


def test_log_compaction_loses_no_event(spark, tmp_path):
    path = tmp_path / "log"
    for i in range(45):
        wr.log_event(spark, str(path), "lib", f"paso{i}", "ok", metrics={"filas": i}, compact_after=4)
    log = wr.read_log(spark, str(path))
    assert sorted(r[0] for r in rows(log, "paso")) == sorted(f"paso{i}" for i in range(45))
    assert log.where("fecha is null or ts is null").count() == 0
    small = [p for p in path.glob("fecha=*/part-*.json")]
    parts = list((path / "_partes").iterdir())
    assert len(small) < 4 and len(parts) < 10


def test_log_compaction_broken_off(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    for i in range(3):
        wr.log_event(spark, path, "lib", f"paso{i}", "ok")
    (tmp_path / "log" / "_partes" / "half" / "events").mkdir(parents=True)  # a part that no pointer names
    kept = {p: p.read_bytes() for p in (tmp_path / "log").glob("fecha=*/*.json")}
    wr.compact_log(spark, path)
    for p, body in kept.items():  # as if the small files had not gone
        p.write_bytes(body)
    assert sorted(r[0] for r in rows(wr.read_log(spark, path), "paso")) == ["paso0", "paso1", "paso2"]
    wr.log_event(spark, path, "lib", "paso3", "ok")
    monkeypatch.setattr(wr, "MOST_PARTS", 2)
    wr.compact_log(spark, path)
    for p, body in kept.items():
        p.write_bytes(body)
    wr.compact_log(spark, path)
    assert sorted(r[0] for r in rows(wr.read_log(spark, path), "paso")) == [f"paso{i}" for i in range(4)]


def test_search_in_every_column(spark):
    from tejado.operators.filters import search_rows
    df = spark.createDataFrame([(1, 350.0, True, dt.date(2024, 5, 1), None), (22, 1e9, False, None, "Torre 2"), (3, 0.08, None, None, "x")], "i long, d double, b boolean, f date, s string")
    found = lambda term: sorted(r[0] for r in rows(search_rows(df, term), "i"))
    assert [found(t) for t in ("350.0", "1000000000.0", "0.08", "TRUE", "2024-05", "torre", " 22 ", "none", "")] == [[1], [22], [3], [1], [1], [22], [22], [], [1, 3, 22]]


def test_export_by_advisor_computes_the_processes_once(spark, monkeypatch):
    from tejado.catalog import io_queries
    from tejado.operators.dedup import straight_from_files
    given, export, sf = [], io_queries.ex.export_by_advisor, "/root/testdata/sf0.001"
    monkeypatch.setattr(io_queries.ex, "export_by_advisor", lambda df, *a, **k: given.append(df) or export(df, *a, **k))
    out = io_queries.job17(spark, sf)
    assert len(given) == 2 and all(straight_from_files(df) for df in given)
    assert out.count() == io_queries.view(spark, sf, "procesos").count()
