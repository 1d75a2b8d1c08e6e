"""Steps whose cost had grown too fast with the tables: what they plan, and that the results are the old ones."""

import re
import time

import pytest
from pyspark.sql import functions as F

from tejado.catalog.io_queries import raw_files
from tejado import session
from tejado.functions import keys, text
from tejado.operators import arrays as ar
from tejado.plans import ledger as lg
from tejado.plans import medallion, stock
from tests.conftest import one_col, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_files_grow_with_the_table():
    """JOB-04: three files for small tables; a large one gets more files, not larger tasks."""
    assert [raw_files(n) for n in (0, 10, 750_000, 750_001, 54_000_000)] == [3, 3, 3, 4, 216]


def test_items_of_unique_rows_need_no_sort(spark):
    """AR-01: without an order all equal items stand in one row; they are reduced there, without grouping."""
    base = spark.createDataFrame([("P1", "U1", "U2, U1;U2", "U1|U3|U3", 1), ("P2", None, None, "U9,NONE", 2), ("P3", " U4 ", "", " u4|nan", 3),
                                  ("P4", None, None, None, 4)], "codigo_proforma string, main string, sep string, ven string, x int")
    out = ar.explode_items(base, "main", [("ven", ar.ADD_SALE), ("sep", ar.ADD_RESERVATION)], ["x"])
    assert sorted(rows(out, "codigo_proforma", "codigo_item", "x", "origen_item")) == [
        ("P1", "U1", 1, ar.ADD_RESERVATION), ("P1", "U2", 1, ar.ADD_RESERVATION), ("P1", "U3", 1, ar.ADD_SALE),
        ("P2", "U9", 2, ar.ADD_SALE), ("P3", "U4", 3, ar.PRINCIPAL), ("P3", "u4", 3, ar.ADD_SALE)]
    assert not re.search("Sort|Aggregate|Exchange", plan(out))


@pytest.mark.parametrize("key", [text.ustrip, text.has_text, keys.file_base_name])
def test_native_functions_in_place_of_patterns(spark, key):
    """Steps of every ledger row's keys: no pattern and no split where a native function does the same."""
    made = str(key(F.col("v"))).lower()
    assert not re.search("regexp|rlike|split", made), made


def test_keys_as_before(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace() and c not in range(0x1C, 0x20)]
    assert one_col(spark, [s + "a" + s + "b" + s for s in spaces], text.ustrip) == ["a" + s + "b" for s in spaces]
    assert one_col(spark, ["\x1ca\x1f", "", None, "\u200b"], text.ustrip) == ["\x1ca\x1f", "", None, "\u200b"]
    assert one_col(spark, ["\u3000\n", "", None, "\u200b", " x"], text.has_text, ) == [False, False, False, True, True]
    values = ["f001_13", "F001-#-00013", "x F001/0", "B0010000", "--a__b//", "F001-1|2", "F00-1", "", None, "F001-123456789", "É001-b002 07"]
    assert one_col(spark, values, keys.invoice_canonical_key) == [
        "F001-00000013", "F001-00000013", "F001-00000000", "B001-00000000", "A-B", "F001-00000012", "F00-1", "", "", "F001-123456789", "B002-00000007"]
    assert one_col(spark, ["a/b\\Venta  Ursa-2026.xlsx", "x/", None, " ñ_1 "], keys.company_key) == ["B VENTA URSA 2026 XLSX", "", "", "N 1"]
    assert one_col(spark, [" 00012.0 ", "1.05", "NaN", None, ".0"], keys.doc_key) == ["00012", "15", None, None, None]


def test_masters_compacted_once_for_several_ledgers(spark, monkeypatch):
    """PRJ-13: a second enrichment takes the masters that the first used; the result is the same."""
    calls, whole = [], lg.company_masters
    monkeypatch.setattr(lg, "company_masters", lambda *a, **k: calls.append(1) or whole(*a, **k))
    ledger = spark.createDataFrame([("F001-1", "VENTA URSA 2026.xlsx", 1), (" ", None, 2), ("F001-2", "x LYNX", 3)], "nro_comprobante string, source_file string, n int")
    master = spark.createDataFrame([("F001-00000001", "D", None, "7", "URSA", "m.xlsx", "H1", 1), ("F001-1", None, "T", "8", "URSA", "m.xlsx", "H2", 2)],
                                   "id_comprobante string, tipos_unidad string, u1_tipo string, u1_n string, company string, master_file string, hoja string, orden_fila int")
    compacted = lg.compacted_company_masters(master)
    twice = lg.enrich_by_company(lg.enrich_by_company(ledger, master, masters=compacted), master, masters=compacted)
    assert len(calls) == 1
    assert sorted(map(str, rows(twice))) == sorted(map(str, rows(lg.enrich_by_company(ledger, master))))


def nodes(df) -> list:
    """All nodes of the optimised plan."""
    found = [df._jdf.queryExecution().optimizedPlan()]
    for node in found:
        found += [node.children().apply(i) for i in range(node.children().size())]
    return found


MASTER = "id_comprobante string, tipos_unidad string, u1_tipo string, u1_n string, company string, master_file string, hoja string, orden_fila int"


def test_canonical_key_of_every_ascii_character(spark):
    """SNK-10, JOB-09: one translate in place of the pattern gives the keys of the pattern."""
    values = [chr(c) + "a" + chr(c) * 2 + "F001" + chr(c) + "7" for c in range(128)] + ["_/-", "/_b001--_0", "½-ª", "ｆ００１＿７", "", None]
    s = text.fold_ascii(F.upper("v"))
    old = F.btrim(F.regexp_replace(F.regexp_replace(s, r"[^A-Z0-9_/\-]+", ""), r"[_/\-]+", "-"), F.lit("-"))
    assert one_col(spark, values, keys.canonical_clean) == one_col(spark, values, lambda c: old)
    assert "[^A-Z0-9" not in str(keys.canonical_clean(F.col("v")))


def test_master_keys_are_computed_once(spark):
    """SNK-10: dropping blank keys isn't moved down to the scan, where each use of the key would compute it again."""
    master = spark.createDataFrame([
        ("F001-1", "D", None, "7", "URSA", " ", "H2", 2), ("F001-00000001", " ", "T", "8", "URSA", "m.xlsx", "H1", 1), ("f001/1", None, None, None, "URSA", "n.xlsx", " H1 ", 3),
        (" ", "D", "T", "9", "URSA", "m.xlsx", "H1", 4), ("##", "D", "T", "9", "URSA", "m.xlsx", None, 5), (None, "D", "T", "9", "LYNX", "m.xlsx", "H1", 6),
        ("x 1", None, None, None, None, None, None, None), ("B001-2", None, None, None, " ", None, " ", 7)], MASTER)
    out = lg.company_masters(master)
    filters = [n.condition().toString() for n in nodes(out) if n.nodeName() == "Filter"]
    assert filters and not [f for f in filters if "regexp" in f]
    cols = ["__company", "efac_comprobante_key", "source_company", "efac_expected_master", "efac_source_file", "tipos_unidad_efac", "u1_tipo_efac", "u1_n_efac",
            "efac_match_count", "efac_source_sheet"]
    assert out.columns == cols
    assert sorted(rows(out), key=str) == sorted([
        ("URSA", "F001-00000001", "URSA", "m.xlsx", "m.xlsx", "D", "T", "8", 3, "H1 | H2"),
        (None, "X1", None, None, None, None, None, None, 1, None), (" ", "B001-00000002", None, None, None, None, None, None, 1, None)], key=str)


def test_company_join_goes_by_a_number_and_spreads_what_cannot_match(spark):
    """SNK-10, JOB-09: no second copy of the key is shuffled, and blank or unknown keys don't pile up."""
    master = spark.createDataFrame([("F001-1", "D", None, "7", "URSA", "m.xlsx", "H1", 1), ("F001-2", "E", None, None, "OTHER", "o.xlsx", "H1", 2)], MASTER)
    ledger = spark.createDataFrame([("F001-1", "VENTA URSA 2026.xlsx", 1), (" ", "x ursa", 2), ("F001-1", "x LYNX", 3), ("F001-1", None, 4), (None, None, 5), ("F001-9", "ursa", 6)],
                                   "nro_comprobante string, source_file string, n int")
    out = lg.enrich_by_company(ledger, master)
    join = [n for n in nodes(out) if n.nodeName() == "Join"][0]
    carried = [join.left().output().apply(i).name() for i in range(join.left().output().size())]
    assert "__h" in carried and not {"__jk", "__company"} & set(carried), carried
    got = sorted(rows(out, "n", "efac_comprobante_key", "source_company", "efac_expected_master", "tipos_unidad_efac", "u1_n_efac", "efac_match_count", "efac_match_method"))
    ursa = "MAESTRO_COMPROBANTES_URSA.xlsx"
    assert got == [(1, "F001-00000001", "URSA", "m.xlsx", "D", "7", 1, lg.SOURCE_AWARE), (2, "", "URSA", ursa, None, None, None, None),
                   (3, "F001-00000001", None, None, None, None, None, None), (4, "F001-00000001", None, None, None, None, None, None),
                   (5, "", None, None, None, None, None, None), (6, "F001-00000009", "URSA", ursa, None, None, None, None)]
    kept = lg.enrich_by_company(ledger, master, keep_company=True)
    assert sorted(rows(kept, "n", "__company"), key=lambda r: r[0]) == [(1, "URSA"), (2, "URSA"), (3, "LYNX"), (4, None), (5, None), (6, "URSA")]


def shuffle_files(spark) -> set:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def gone(spark, before: set) -> bool:
    """Whether no shuffle files but those of ``before`` are left (they are removed in the background)."""
    for _ in range(100):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.1)
    return False


def test_written_steps_leave_no_shuffle_files(spark):
    """JOB-08: shuffle files of a step go once its table is written; the session's setting is as it was."""
    before, setting = shuffle_files(spark), spark.conf.get(session.FREE_SHUFFLES, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    out = session.staged(df, "step")
    assert gone(spark, before) and spark.conf.get(session.FREE_SHUFFLES, None) == setting
    assert sorted(rows(out)) == sorted(rows(df))


TIERS = [  # invoice, unit types, file, sheet, order
    ("F001-13", None, "MAESTRO_URSA.xlsx", "H1", 5), ("F001-00013", "D", "MAESTRO_URSA.xlsx", "H2", 7), ("F001-13", "E", "MAESTRO_LYNX.xlsx", "H1", 3),
    ("F001-13", "G", "MAESTRO_LYNX.xlsx", "H0", 4), ("B002-1", " ", "otro.xlsx", "H1", 1), ("B002-1", "X", "MAESTRO_LYNX.xlsx", None, 2), (" ", "Z", "MAESTRO_URSA.xlsx", "H1", 0),
    (None, "Z", "MAESTRO_URSA.xlsx", "H1", 0), ("---", "Y", "MAESTRO_LYNX.xlsx", "H1", 9)]


@pytest.mark.parametrize("in_steps", [False, True])
def test_two_tier_lookups_hold_a_row_per_key(spark, in_steps):
    """JOB-08: the groups of a key and what they say together are one row, not a second table; the matches are the old ones."""
    master = spark.createDataFrame([(a, b, None, None, f, h, o) for a, b, f, h, o in TIERS],
                                   "id_comprobante string, tipos_unidad string, u1_tipo string, u1_n string, master_file string, hoja string, orden_fila int")
    exact, flex = lg.lookups(lg.compacted_master(master))
    assert sorted(r[0] for r in rows(exact, "efac_comp_key_exact")) == ["---", "B002-1", "F001-00013", "F001-13"]
    assert sorted(r[0] for r in rows(flex, "efac_comp_key_flex")) == ["", "B002|1", "F001|13"]
    ledger = [("F001-13", "x ursa", 1), ("F001-13", "x lynx", 2), ("F001-13", None, 3), ("f001-013", "x ursa", 4), ("f001-013", "x cygnus", 5), ("F001-00013", "x lynx", 6),
              ("B002-1", "x ursa", 7), ("B002-1", None, 8), (" ", "x ursa", 9), (None, None, 10), ("---", "x lynx", 11), ("--", "x lynx", 12), ("B002-1", "10 de abril", 13)]
    out = lg.enrich_two_tier(spark.createDataFrame(ledger, "nro_comprobante string, source_file string, n int"), master, in_steps=in_steps)
    assert out.columns == ["nro_comprobante", *lg.TARGETS, *lg.AUDIT, "source_file", "n", *[c for c in lg.CARRIED if c not in lg.AUDIT]]
    u, x = "MAESTRO_URSA.xlsx", "MAESTRO_LYNX.xlsx"
    assert sorted(rows(out, "n", "tipos_unidad_efac", "efac_match_method", "efac_match_count", "efac_source_file", "efac_source_sheet", "efac_group")) == [
        (1, "D", lg.FLEX, 1, u, "H1", "URSA"), (2, "E", lg.EXACT, 2, x, "H1", "LYNX"), (3, "E", lg.EXACT, 3, x, "H1", "LYNX"), (4, "D", lg.FLEX, 2, u, "H1", "URSA"),
        (5, "E", lg.FLEX, 4, x, "H1", "LYNX"), (6, "E", lg.FLEX, 2, x, "H1", "LYNX"), (7, None, None, None, None, None, None), (8, "X", lg.EXACT, 2, "otro.xlsx", "H1", "UNKNOWN"),
        (9, None, None, None, None, None, None), (10, None, None, None, None, None, None), (11, "Y", lg.EXACT, 1, x, "H1", "LYNX"), (12, None, None, None, None, None, None),
        (13, "X", lg.EXACT, 2, "otro.xlsx", "H1", "UNKNOWN")]


def test_layers_leave_no_shuffle_files(spark, tmp_path):
    """JOB-04: the disk holds the layers and one table's shuffles, not those of all tables; facts made in steps are the same."""
    base = str(tmp_path)
    raw = {"unidades": spark.createDataFrame([("U1", "A1", "P1", 100.0), ("U2", "E-2", "P2", 50.0), ("U1", "B1", "P1", 90.0)], "codigo string, nombre string, codigo_proyecto string, precio_venta double"),
           "proyectos": spark.createDataFrame([("P1", "Uno"), ("P1", "Otro"), (None, "Nada")], "codigo string, nombre string"),
           "clientes": spark.createDataFrame([("0001", "Ana", "Paz"), ("0002", "Luz", "Rey"), (None, "Nadie", None)], "documento string, nombres string, apellidos string"),
           "procesos": spark.createDataFrame([
               ("PF1", "Separacion", "Activo", "0001", "U1", "U2", "P1", "0002;0003", None, None), ("PF1", "Venta", "Activo", "0001", "U1", None, "P1", "0002", "0002", "2024-01-02"),
               ("PF2", "Separacion", "Anulado", None, "U2", None, None, None, "0009", None), (None, "Venta", "Activo", "0002", "U2", None, "P2", "0001", None, "2024-01-03"),
               ("PF3", "Venta", None, "0002", "U2", "U1", "P2", "", None, None)],
               "codigo_proforma string, nombre string, estado string, documento_cliente string, codigo_unidad string, codigo_unidades_asignadas string, "
               "codigo_proyecto string, documento_copropietarios string, documento_conyuge string, fecha_fin string")}
    for name, df in raw.items():
        df.coalesce(1).write.parquet(f"{base}/raw/{name}.parquet")
    before = shuffle_files(spark)
    owners, mart = medallion.run_all(spark, base)
    assert gone(spark, before)
    read = {n: spark.read.parquet(f"{base}/bronze/{n}.parquet") for n in raw}
    whole, steps = (stock.process_facts(read["procesos"], read["clientes"], in_steps=x) for x in (False, True))
    assert whole.schema.simpleString() == steps.schema.simpleString() and sorted(rows(whole), key=str) == sorted(rows(steps), key=str)
    got = {r["codigo_proforma"]: (r["con_separacion"], r["con_venta"], r["copropietario_1"], r["dni_coprop_1"], r["dni_coprop_2"]) for r in steps.collect()}
    assert got == {"PF1": (True, True, "Luz Rey", "0002", "0003"), "PF2": (False, False, None, "0009", None), "PF3": (False, True, None, None, None)}
    assert owners.count() == 2 and mart.count() == 2
