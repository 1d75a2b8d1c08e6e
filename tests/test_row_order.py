"""Row order of files, carried through layers; sorted places; repeatable split exports."""

import csv

import pytest
from pyspark.sql import functions as F

from tejado.operators import dedup as dd
from tejado.plans import medallion as md
from tejado.plans import stock as st
from tejado.plans.leads import exclusion_list
from tejado.sinks import writers as wr
from tejado.sources.readers import read_csv, read_required

from conftest import rows

LEADS = ["nombre", "documento", "correo", "telefono", "proyecto", "estado_lead", "observacion", "fecha_registro"]


def write_leads(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(LEADS)
        out.writerows(lines)


@pytest.fixture
def split_size(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda size: (spark.conf.set("spark.sql.files.maxPartitionBytes", size), spark.conf.set("spark.sql.files.openCostInBytes", "1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_exclusions_from_csv_files_keep_the_last_row(spark, tmp_path, split_size):
    """Three keys over many rows of files in two folders that have equal names; the larger file is not the last."""
    every = []
    for folder, n in (("a", 300), ("b", 40)):
        for part in (0, 1):
            lines = [[f"{folder}{part}-{i}", f"D{i % 3}", "", "", "P", "No perfil", "", "2024-01-01"] for i in range(n)]
            every += [line[0] for line in lines]
            write_leads(tmp_path / folder, f"part-{part}.csv", lines)
    want = {f"D{k}": next(x for x in reversed(every) if int(x.split("-")[1]) % 3 == k) for k in range(3)}
    for size in ("128m", "700", "97"):
        split_size(size)
        leads = read_csv(spark, f"{tmp_path}/*/*.csv")
        assert dict(rows(exclusion_list(leads), "documento_exclusion", "nombre")) == want
        kept = leads.where("documento <> 'D1'").select(*LEADS)  # filters and column choices keep the order
        assert dict(rows(exclusion_list(kept), "documento_exclusion", "nombre")) == {k: v for k, v in want.items() if k != "D1"}


def test_json_and_parquet_order(spark, tmp_path, split_size):
    data = spark.createDataFrame([(i, i % 4) for i in range(500)], "i int, k int").coalesce(1)
    data.write.json(str(tmp_path / "j"))
    data.write.parquet(str(tmp_path / "p"))
    split_size("211")
    for table in (spark.read.schema("i int, k int").json(str(tmp_path / "j")), spark.read.parquet(str(tmp_path / "p"))):
        df, order = dd.order_of(table, "orden_fila")
        assert sorted(rows(dd.keep_first(df, ["k"], order), "k", "i")) == [(k, k) for k in range(4)]
        assert sorted(rows(dd.keep_last(df, ["k"], order), "k", "i")) == [(k, 496 + k) for k in range(4)]


def test_no_order_after_a_shuffle(spark, tmp_path):
    spark.range(9).write.option("header", True).csv(str(tmp_path / "t"))
    table = read_csv(spark, str(tmp_path / "t"))
    for moved in (table.repartition(3), table.join(table.select(F.col("id").alias("x")), F.col("id") == F.col("x")), table.union(table), table.orderBy("id")):
        with pytest.raises(ValueError, match="row order is unknown"):
            dd.order_of(moved, "orden_fila")


def test_bronze_carries_the_order(spark, tmp_path):
    """The later file is the larger one, which Spark reads first; its rows still come second."""
    raw = tmp_path / "raw" / "proyectos.parquet"
    schema = "codigo string, nombre string"
    spark.createDataFrame([("P1", "Primero")], schema).coalesce(1).write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([("P1", "Segundo"), *[(f"Q{i}", "x" * 50 + str(i)) for i in range(3000)]], schema).coalesce(1).write.parquet(str(tmp_path / "y"))
    raw.mkdir(parents=True)
    for name, folder in (("a", "x"), ("b", "y")):
        next((tmp_path / folder).glob("part-*.parquet")).rename(raw / f"{name}.parquet")
    direct = st.silver_projects(read_required(spark, str(raw)))
    path = str(tmp_path / "bronze")
    bronze = wr.with_lineage(wr.with_row_order(read_required(spark, str(raw))))
    bronze.repartition(5).write.parquet(path)
    assert dd.ROW_ORDER in bronze.columns and wr.with_row_order(bronze).columns == bronze.columns
    via = st.silver_projects(read_required(spark, path))
    for out in (direct, via):
        assert dict(rows(out, "codigo_proyecto", "proyecto"))["P1"] == "Primero"
    assert sorted(rows(direct)) == sorted(rows(via))


def test_layers_equal_the_marts_built_on_raw_files(spark, tmp_path):
    from tejado.plans.adapters import view

    base = str(tmp_path / "m")
    for name in md.RAW_TABLES:
        order = "id_proceso" if name == "procesos" else "orden_fila"
        table = view(spark, "/root/testdata/sf0.001", name)
        table.repartitionByRange(4, order).sortWithinPartitions(order).drop(order).write.parquet(f"{base}/raw/{name}.parquet")
    raw = {n: read_required(spark, f"{base}/raw/{n}.parquet") for n in md.RAW_TABLES}
    owners, stock = md.run_all(spark, base)
    _, direct_owners, direct_stock = st.build_marts(raw)
    key = str
    assert sorted(map(key, rows(stock))) == sorted(map(key, rows(direct_stock)))
    assert sorted(map(key, rows(owners))) == sorted(map(key, rows(direct_owners)))


def test_row_positions(spark):
    data = [(i % 7 if i % 11 else None, i % 3) for i in range(2000)] + [(3, 1)] * 500
    df = spark.createDataFrame(data, "a int, b int").repartition(6)
    got = sorted(rows(dd.row_positions(df, ["a", F.col("b").desc()], "place"), "place", "a", "b"))
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, -r[1]))
    assert got == [(i, *r) for i, r in enumerate(want)]
    assert dd.row_positions(df.limit(0), ["a"]).count() == 0


def test_a_second_export_replaces_the_first(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(i, g) for i, g in enumerate(["Ana", "ana", " ", None, "Ben", "007"] * 4)], "i int, asesor string")
    wr.split_by_group(first, "asesor", path)
    assert sorted(rows(wr.read_export(spark, path), "i")) == [(i,) for i in range(24)]
    second = first.where("asesor <> 'Ben'")
    manifest = wr.split_by_group(second, "asesor", path)
    out = wr.read_export(spark, path)
    assert sorted(rows(out, "i")) == sorted(rows(second.select("i")))
    assert out.schema["i"].dataType == first.schema["i"].dataType
    assert dict(rows(manifest, "grupo", "filas")) == dict(rows(out.groupBy("grupo").count())) == {"Ana": 4, "ana": 4, "Sin Asesor": 4, "007": 4}
    assert rows(wr.export_manifest(spark, path).orderBy("grupo")) == rows(manifest.orderBy("grupo"))
    folders = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("v=")]
    assert len(folders) == 1
    for (folder,) in rows(manifest, "carpeta"):
        assert spark.read.parquet(folder).count() == 4


def test_a_broken_export_leaves_the_former_one(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([(1, "Ana"), (2, "Ben")], "i int, asesor string")
    wr.split_by_group(first, "asesor", path)
    poisoned = spark.createDataFrame([(3, "Cid"), (4, "Dan")], "i int, asesor string").withColumn("i", F.when(F.col("i") == 4, F.raise_error("broken")).otherwise(F.col("i")))
    with pytest.raises(Exception, match="broken"):
        wr.split_by_group(poisoned, "asesor", path)
    assert sorted(rows(wr.read_export(spark, path), "i", "grupo")) == [(1, "Ana"), (2, "Ben")]
    (tmp_path / "out" / "v=000009-halfdone" / "rows").mkdir(parents=True)  # a run that stopped before it was entered
    assert sorted(rows(wr.read_export(spark, path), "i")) == [(1,), (2,)]
    wr.split_by_group(first.where("i = 2"), "asesor", path)
    assert rows(wr.read_export(spark, path), "i") == [(2,)]
    with pytest.raises(FileNotFoundError):
        wr.read_export(spark, str(tmp_path / "none"))


def test_unique_labels_compute_the_input_once(spark):
    """Chains of clashing labels; the input is read by one job."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    names = ["a", "a_2", "a", "a_2", "a", "a_3", "a_2_2", "a"] * 2
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string").mapInArrow(count, "i int, n string")
    got = [r[1] for r in sorted(rows(dd.unique_labels(df, "n", "lab", max_len=8, order_by=["i"]), "i", "lab"))]
    used, want = set(), []
    for base in names:
        label, n = base, 2
        while label in used:
            label, n = base[:8 - len(f"_{n}")] + f"_{n}", n + 1
        used.add(label)
        want.append(label)
    assert got == want and seen.value == len(names)
