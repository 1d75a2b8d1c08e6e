"""Operators: declarative filters, keep-first/last, aggregates, joins, set ops, schema helpers
(FLT-01..08, WD-01..08, AG-02..05, JN-12..14, SE-01/02, PRJ-01..16) and traps T-01..T-04, T-10, T-14, T-20."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tejado.operators import aggregates as ag
from tejado.operators import arrays as ar
from tejado.operators import columns as co
from tejado.operators import dedup as dd
from tejado.operators import filters as fl
from tejado.operators import joins as jn
from tejado.operators import setops as so


@pytest.fixture(scope="module")
def people(spark):
    data = [(1, "Activo", "TZ", " Depósito ", None), (2, "activo ", "np", "Estacionamiento", "  "),
            (3, "Anulado", "TZ", "departamento", "x"), (4, None, None, None, "y")]
    return spark.createDataFrame(data, "id int, estado string, proyecto string, tipo string, nota string")


def test_declarative_filter_ops(people):
    cond = {"estado": {"op": "igual_ci", "valor": "ACTIVO"}, "proyecto": {"op": "en_ci", "valores": ["tz", "NP"]}}
    assert sorted(r[0] for r in rows(fl.declarative_filter(people, cond), "id")) == [1, 2]
    assert sorted(r[0] for r in rows(fl.declarative_filter(people, {"nota": {"op": "vacio"}}), "id")) == [1, 2]
    assert sorted(r[0] for r in rows(fl.declarative_filter(people, {"tipo": {"op": "contiene_ci", "valor": "DEPOS"}}),
                                     "id")) == [1]
    # T-10: null is "distinct"; no_en keeps nulls
    assert sorted(r[0] for r in rows(fl.declarative_filter(people, {"estado": {"op": "distinto", "valor": "Anulado"}}),
                                     "id")) == [1, 2, 4]
    assert sorted(r[0] for r in rows(fl.declarative_filter(people, {"proyecto": {"op": "no_en", "valores": ["TZ"]}}),
                                     "id")) == [2, 4]
    assert sorted(r[0] for r in rows(fl.declarative_filter(people, {"proyecto": ["TZ"], "id": 3}), "id")) == [3]
    with pytest.raises(KeyError):
        fl.declarative_filter(people, {"nope": 1})
    with pytest.raises(ValueError):
        fl.declarative_filter(people, {"id": {"op": "raro"}})


def test_filter_report_and_observation(people):
    rep = fl.filter_report(people, {"estado": {"op": "igual_ci", "valor": "activo"}}).first()
    assert (rep["antes"], rep["despues"], rep["descartadas"], rep["pct_conservado"]) == (4, 2, 2, 50.0)
    out, obs = fl.observed_filter(people, {"estado": {"op": "igual_ci", "valor": "activo"}})
    assert out.count() == 2 and obs.get == {"antes": 4, "despues": 2}


def test_active_if_any(spark, people):
    assert sorted(r[0] for r in rows(fl.active_if_any(people), "id")) == [1, 2]
    none_active = people.where("id in (3, 4)")
    assert sorted(r[0] for r in rows(fl.active_if_any(none_active), "id")) == [3, 4]
    assert "CartesianProduct" not in fl.active_if_any(people)._jdf.queryExecution().executedPlan().toString()


def test_facets_and_search(people):
    assert sorted(r[0] for r in rows(fl.facet_filter(people, {"proyecto": None}), "id")) == [1, 2, 3]  # T-20
    assert sorted(r[0] for r in rows(fl.facet_filter(people, {"proyecto": None}, keep_null=True), "id")) == [1, 2, 3, 4]
    assert [r[0] for r in rows(fl.search_rows(people, "ANULADO"), "id")] == [3]
    assert fl.search_rows(people, "none").count() == 0  # T-25: nulls are not the text "None"


@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first_last_independent_of_partitioning(spark, parts):
    """T-01: results depend on the stated order, not on the physical layout."""
    data = [(k, i, f"v{k}{i}") for k in range(5) for i in range(6)]
    df = spark.createDataFrame(data, "k int, i int, v string").repartition(parts)
    first = sorted(rows(dd.keep_first(df, ["k"], "i"), "k", "v"))
    last = sorted(rows(dd.keep_last(df, ["k"], "i"), "k", "v"))
    assert first == [(k, f"v{k}0") for k in range(5)]
    assert last == [(k, f"v{k}5") for k in range(5)]


def test_keep_first_plans_group_limit(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dd.keep_first(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    # a partial limit before the shuffle: a hot key forwards one row per map task
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_group_size_and_slots(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, "e")], "k int, v string")
    got = sorted(rows(dd.group_size(df, ["k"]), "v", "group_size"))
    assert got == [("a", 2), ("b", 2), ("c", 2), ("d", 2), ("e", 1)]


def test_unique_labels(spark):
    df = spark.createDataFrame([(1, "Proyecto Uno"), (2, "Proyecto Uno"), (3, None), (4, "a/b")], "i int, n string")
    got = dict(rows(dd.unique_labels(df, "n", "lab", max_len=8, order_by=["i"]), "i", "lab"))
    assert got == {1: "Proyecto", 2: "Proyec_2", 3: "SIN_PROY", 4: "a b"}


def test_first_non_null_and_join_unique(spark):
    df = spark.createDataFrame([("k", 1, None, " b "), ("k", 2, "x", "a"), ("k", 3, "y", "b"), ("k", 4, "", None)],
                               "k string, o int, x string, t string")
    r = df.groupBy("k").agg(ag.first_non_null("x", "o").alias("f"), ag.first_non_blank(F.col("x"), F.col("o")).alias("fb"),
                            ag.join_unique("t").alias("j")).first()
    assert (r["f"], r["fb"], r["j"]) == ("x", "x", "a | b")
    cu = ag.concat_unique_first_seen(df, ["k"], "t", "o", "c").first()["c"]
    assert cu == "b | a"  # AG-05: first-seen order


def test_sum_zero_and_null_group_count(spark):
    """T-03 (all-null sum is 0) and T-04 (count of the grouping column is 0 for the null group)."""
    df = spark.createDataFrame([(None, None), (None, None), ("p", 1.0)], "p string, x double")
    got = dict(rows(df.groupBy("p").agg(ag.sum_zero("x").alias("s")), "p", "s"))
    assert got == {None: 0.0, "p": 1.0}
    got = dict(rows(df.groupBy("p").agg(F.count("p").alias("n")), "p", "n"))
    assert got == {None: 0, "p": 1}


def test_explode_items_priority(spark):
    """AR-01 + WD-03 (T-14): the alphabetical origin wins; blank main unit skipped."""
    base = spark.createDataFrame([("P1", "U1", "U2, U1", "U1|U3"), ("P2", "  ", None, "U9")],
                                 "codigo_proforma string, main string, sep string, ven string")
    out = ar.explode_items(base, "main", [("sep", ar.ADD_RESERVATION), ("ven", ar.ADD_SALE)], [])
    got = sorted(rows(out, "codigo_proforma", "codigo_item", "origen_item"))
    assert got == [("P1", "U1", "ADICIONAL_SEPARACION"), ("P1", "U2", "ADICIONAL_SEPARACION"),
                   ("P1", "U3", "ADICIONAL_VENTA"), ("P2", "U9", "ADICIONAL_VENTA")]


def test_m1_join_indicator_and_nulls(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "i int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k2 string, v int")
    got = sorted(rows(jn.left_join_m1(left, right, "k", "k2"), "i", "v", "_merge"))
    assert got == [(1, 10, "both"), (2, None, "left_only"), (3, None, "left_only")]  # T-02
    assert sorted(r[0] for r in rows(jn.unmatched(left, right, "k", "k2"), "i")) == [2, 3]
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k2 string, v int")
    assert len(rows(jn.left_join_m1(left, right, "k", "k2", validate=True))) == 3
    with pytest.raises(Exception, match="not unique on k2: a"):
        jn.left_join_m1(left, dup, "k", "k2", validate=True).collect()
    ns = jn.key_join(left.withColumnRenamed("k", "key"), right.withColumnRenamed("k2", "key"), ["key"], null_safe=True)
    assert sorted(rows(ns, "i", "v")) == [(1, 10), (2, 20), (3, None)]


def test_snapshot_diff_and_union(spark):
    cur = spark.createDataFrame([(1,), (2,), (2,), (4,)], "k int")
    prev = spark.createDataFrame([(1,), (3,)], "k int")
    new, removed = so.snapshot_diff(cur, prev, ["k"])
    assert sorted(rows(new)) == [("2",), ("4",)] and rows(removed) == [("3",)]
    c = so.snapshot_counts(cur, prev, ["k"]).first()
    assert tuple(c) == (3, 2, 2, 1)
    u = so.union_by_name([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")])
    assert sorted(rows(u), key=str) == [(1, None), (None, "x")]


def test_columns_helpers(spark):
    df = spark.createDataFrame([(1, "a")], "`A b` int, `c-D` string")
    assert co.normalize_names(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError):
        co.normalize_names(spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int"))
    e = co.ensure_columns(df, ["x"])
    assert e.columns[-1] == "x" and e.first()["x"] is None
    with pytest.raises(KeyError):
        co.require_columns(df, ["zz"])
    t = spark.createDataFrame([(None, "v"), (None, "w")], "a string, b string")
    assert rows(t.select(co.first_existing(t, ["a", "b", "c"]))) == rows(t.select(F.col("b").cast("string"))) and co.pick_first_existing(t, ["c", "a"]) == "a"
    assert co.select_columns(t, ["b", "zz"], ["a", "b"]).columns == ["b", "zz", "a"]
    assert co.place_after(spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, n int, m int"), "a", ["n", "b"]).columns \
        == ["a", "n", "b", "m"]
    m = spark.createDataFrame([("None",), ("nan",), ("ok",)], "s string")
    assert rows(co.clean_missing_markers(m)) == [(None,), (None,), ("ok",)]
    assert co.find_column(spark.createDataFrame([(1,)], "`N° Comprobante` int"), ["nro_comprobante"]) == "N° Comprobante"


def test_calculated_columns_registry(spark):
    reg = co.CalculatedColumns()
    assert reg.available() == ["flag_tiene_coprop", "precio_venta_miles", "total_coprops"]
    df = spark.createDataFrame([("1", None, "3", "2500")], "dni_coprop_1 string, dni_coprop_2 string, dni_coprop_3 string, "
                                                           "precio_venta string")
    out = reg.apply(df, ["flag_tiene_coprop", "total_coprops", "precio_venta_miles", "desconocida"]).first()
    assert (out["flag_tiene_coprop"], out["total_coprops"], out["precio_venta_miles"], out["desconocida"]) == \
        ("Sí", 2, 2.5, None)


def test_unmatchable_keys_spread_and_never_match(spark):
    """A blank key held by most rows is salted: rows spread over partitions, none matches, none is lost."""
    left = spark.createDataFrame([(i, "" if i % 3 else "A") for i in range(300)], "i int, k string")
    right = spark.createDataFrame([("A", 1), ("", 2)], "k string, v int")
    salted = left.withColumn("jk", jn.spread_unmatchable(F.col("k"), ["i", "k"]))
    parts = salted.repartition(8, "jk").groupBy(F.spark_partition_id().alias("p")).count().count()
    assert parts > 1
    out = jn.left_join_nonnull(left, right, "k", ["i"])
    assert out.count() == 300
    assert out.where("v IS NOT NULL").count() == 100 and out.where("v = 2").count() == 0


def test_unique_labels_skip_taken_ones(spark):
    names = ["Proyecto Uno", "Proyecto Dos", "Proyec_2", "Proyecto Tres", "Otro", None, "  "]
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string")
    got = [r[1] for r in sorted(rows(dd.unique_labels(df, "n", "lab", max_len=8, default="SIN", order_by=["i"]), "i", "lab"))]
    used, expected = set(), []
    for name in names:  # the rule, one name after the other
        base = " ".join((name or "SIN").split())[:8] or "SIN"
        label, n = base, 2
        while label in used:
            label, n = base[:8 - len(f"_{n}")] + f"_{n}", n + 1
        used.add(label)
        expected.append(label)
    assert got == expected and len(set(got)) == len(got)


def test_explode_items_one_row_per_key_and_item(spark):
    base = spark.createDataFrame([("P", "U1", "U2", "bob", 2), ("P", "U1", "U2", "ann", 1), ("P", "U2", None, "cid", 3)],
                                 "codigo_proforma string, main string, sep string, who string, o int")
    out = ar.explode_items(base, "main", [("sep", ar.ADD_RESERVATION)], ["who"], order="o")
    assert sorted(rows(out, "codigo_item", "origen_item", "who")) == [("U1", ar.PRINCIPAL, "ann"), ("U2", ar.ADD_RESERVATION, "ann")]


def test_row_order_is_never_guessed(spark, tmp_path):
    rows_ = [("a", 1), ("b", 2), ("a", 3)]
    spark.createDataFrame(rows_, "k string, v int").coalesce(1).write.parquet(str(tmp_path / "t"))
    df, order = dd.order_of(spark.read.parquet(str(tmp_path / "t")), "orden_fila")
    assert sorted(rows(dd.keep_last(df, ["k"], order), "k", "v")) == [("a", 3), ("b", 2)]
    with pytest.raises(ValueError, match="row order is unknown"):
        dd.order_of(spark.createDataFrame(rows_, "k string, v int").groupBy("k").count(), "orden_fila")


def test_display_headers_differ_without_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert co.rename_for_display(df, {"a": "Estado", "b": "estado", "c": "ESTADO"}).columns == ["Estado", "estado (2)", "ESTADO (3)"]
