"""Queries for survey rows otherwise exercised only inside larger jobs: FLT-10, JN-14, PRJ-06/07/09/13/14,
SNK-09, WD-06, SC-35."""

from __future__ import annotations

from pyspark.sql import functions as F

from tejado.catalog import register
from tejado.catalog.ledger_queries import CTE_COMPANY
from tejado.catalog.sales_queries import CTE_RECEIVABLES, CTE_SALES, RECEIVABLES
from tejado.catalog.sqlfn import dockey, with_ctes
from tejado.catalog.stock_queries import CTE_STOCK, STOCK, STOCK_VIEWS, sources
from tejado.operators import columns as co
from tejado.operators import dedup as dd
from tejado.operators.joins import same_key
from tejado.plans import dashboard as db
from tejado.plans import ledger as lg
from tejado.plans import receivables as rc
from tejado.plans import sales as sl
from tejado.plans import stock as st
from tejado.plans.adapters import read_base, view
from tejado.functions.keys import doc_key
from tejado.session import scratch_path
from tejado.sinks import writers as wr
from tejado.sources.readers import read_csv

PROJECTS = ["Edificio Módena Brand#3", "  edificio modena BRAND#5 ", ""]


@register("flt10_project_filter", with_ctes(STOCK_VIEWS, CTE_RECEIVABLES[:-1] + [("rdf", f"""
SELECT ic.*, p.proyecto, c.cliente, c.medio_captacion, c.celulares, c.email
FROM ritems_cat ic LEFT JOIN sp p ON p.codigo_proyecto = ic.codigo_proyecto
LEFT JOIN rcli c ON c.documento_cliente = ic.documento_cliente
WHERE ic.categoria IN ('DEPA', 'ESTAC', 'DEPO')
  AND p.proyecto_norm IN ('EDIFICIO MODENA BRAND#3', 'EDIFICIO MODENA BRAND#5')""")]) + RECEIVABLES)
def flt10(spark, sf):
    """FLT-10: receivables for a project list given with accents, case and blanks (normalised on the driver)."""
    return rc.receivables(sources(spark, sf), projects=PROJECTS)


@register("jn14_document_match", with_ctes(STOCK_VIEWS, CTE_SALES) + f"""
SELECT codigo_proforma, codigo_item, dni_comprador, coalesce(dni_comprador = {dockey('documento_cliente')}, false)
  AS flag_dni_match FROM (
  SELECT i.codigo_proforma, i.codigo_item, i.documento_cliente, c.dni_comprador
  FROM sitems i LEFT JOIN sc c ON c.documento_cliente = i.documento_cliente) q""")
def jn14(spark, sf):
    """JN-14: does the client's document equal the process document (both normalised, SC-05)?"""
    base = sl.sales_base(sources(spark, sf)).select("codigo_proforma", "codigo_item", "documento_cliente")
    cli = st.silver_clients(view(spark, sf, "clientes")).select("documento_cliente", "dni_comprador")
    df = base.join(cli, "documento_cliente", "left")
    return df.select("codigo_proforma", "codigo_item", "dni_comprador",
                     same_key(F.col("dni_comprador"), doc_key("documento_cliente")).alias("flag_dni_match"))


# Fixed values (test shaping): the invoice master with the headers of the source workbooks.
MASTER_HEADERS = {"id_comprobante": "N° Comprobante", "tipos_unidad": "Tipos Unidad", "u1_tipo": "U1 Tipo",
                  "u1_n": "U1 N", "proyecto": "Proyecto", "concepto": "Concepto"}


@register("prj07_standardize_headers", with_ctes(["master"], []) + """
SELECT id_comprobante AS nro_comprobante_efac, tipos_unidad AS tipos_unidad_efac, u1_tipo AS u1_tipo_efac,
  u1_n AS u1_n_efac, proyecto AS "Proyecto", concepto AS "Concepto" FROM master""")
def prj07(spark, sf):
    """PRJ-06 + PRJ-07: find the invoice column by rule and rename workbook headers to standard names."""
    m = view(spark, sf, "master").select(*[F.col(k).alias(v) for k, v in MASTER_HEADERS.items()])
    assert co.find_column(m, ["ID Comprobante", "N° Comprobante", "Comprobante"]) == "N° Comprobante"
    return co.standardize_master_columns(m)


@register("prj13_rerun_idempotent", with_ctes(["ledger", "master"], CTE_COMPANY)
          + "SELECT * EXCLUDE (audit_company) FROM by_company")
def prj13(spark, sf):
    """PRJ-13: enriching an already enriched ledger drops the earlier columns first, so the result is unchanged. The
    masters are compacted once, for both."""
    led, mas = view(spark, sf, "ledger"), view(spark, sf, "master")
    compacted = lg.compacted_company_masters(mas)
    return lg.enrich_by_company(lg.enrich_by_company(led, mas, masters=compacted), mas, masters=compacted)


@register("prj14_resolve_suffixed", with_ctes(["unidades", "proyectos"], []) + """
SELECT u.codigo, coalesce(u.codigo_proyecto, p.codigo) AS codigo_proyecto
FROM unidades u LEFT JOIN proyectos p ON p.nombre = 'Edificio Módena ' || u.proyecto""")
def prj14(spark, sf):
    """PRJ-14: one logical column from its join-suffix variants (left value first, then the right)."""
    u = view(spark, sf, "unidades").select("codigo", F.col("codigo_proyecto").alias("codigo_proyecto_x"),
                                           F.concat(F.lit("Edificio Módena "), F.col("proyecto")).alias("k"))
    p = view(spark, sf, "proyectos").select(F.col("codigo").alias("codigo_proyecto_y"), F.col("nombre").alias("k"))
    joined = u.join(p, "k", "left").drop("k")
    return co.resolve_suffixed(joined, "codigo_proyecto")


_SHOWN = {**st.STOCK_HEADERS, "estado_comercial": "Estado comercial (2)"}  # the second header of a name, by the rule


@register("prj09_display_headers", with_ctes(STOCK_VIEWS, CTE_STOCK + [("stock", STOCK)])
          + "SELECT " + ", ".join(f'{c} AS "{h}"' for c, h in _SHOWN.items()) + " FROM stock")
def prj09(spark, sf):
    """PRJ-09: the stock mart with its display headers; of two that differ only in case the second gets a number."""
    return co.rename_for_display(st.build_marts(sources(spark, sf))[2], st.STOCK_HEADERS)


@register("snk09_report_bundle", with_ctes(STOCK_VIEWS, CTE_STOCK + [("stock", STOCK)]) + """
SELECT proyecto, estado_comercial, count(codigo) AS unidades,
  round(coalesce(sum(precio_de_lista_actual), 0), 2) AS valor_lista_actual FROM stock GROUP BY 1, 2""")
def snk09(spark, sf):
    """SNK-09: detail, summary and per-project parts of one run written as one bundle. The mart is computed once, for the
    detail; the summary is made from it, the parts too, and what is returned is the summary of the parts as read back."""
    base = scratch_path(spark, "snk09")
    detail = spark.read.parquet(wr.write_bundle({"detalle": st.build_marts(sources(spark, sf))[2]}, base)["detalle"])
    summary = spark.read.parquet(wr.write_bundle({"resumen": db.stock_summary(detail)}, base)["resumen"])
    wr.split_by_group(detail, "proyecto", f"{base}/por_proyecto", default="SIN_PROYECTO")
    parts = db.stock_summary(wr.read_export(spark, f"{base}/por_proyecto")).select(*summary.columns)
    return parts.intersect(summary)


@register("wd06_file_order", "SELECT o_orderkey, row_number() OVER () - 1 AS fila FROM orders")
def wd06(spark, sf):
    """WD-06: file row order from ``_metadata`` carried as a column; of one Parquet file, the rows' index in it."""
    o = dd.with_file_order(read_base(spark, sf, "orders"))
    return o.select("o_orderkey", F.col("row_order.place").alias("fila"))


@register("wd06_csv_order", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1 AS fila FROM orders")
def wd06_csv(spark, sf):
    """WD-06: the order of rows in CSV files of several folders with equal file names, as places from 0. Every task writes
    one file into each status folder; paths go before the places in a file."""
    base = scratch_path(spark, "wd06csv")
    orders = read_base(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    orders.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderstatus", "o_orderkey") \
        .write.partitionBy("o_orderstatus").option("header", True).csv(base)
    rows = dd.with_file_order(read_csv(spark, f"{base}/*/*.csv", "o_orderkey long"))
    return dd.row_positions(rows, ["row_order"], "fila").select("o_orderkey", "fila")


_PLACE = "row_number() OVER (ORDER BY {}) - 1 AS fila"


@register("so01_sorted_stock", with_ctes(STOCK_VIEWS, CTE_STOCK + [("stock", STOCK)])
          + "SELECT codigo, proyecto, " + _PLACE.format(", ".join(f"{c} NULLS LAST" for c in st.STOCK_ORDER)) + " FROM stock")
def so01(spark, sf):
    """SO-01: the stock mart in display order, as each row's place."""
    mart = st.build_marts(sources(spark, sf))[2].select(*st.STOCK_ORDER)
    return dd.row_positions(mart, st.STOCK_ORDER, "fila").select("codigo", "proyecto", "fila")


@register("so02_sorted_receivables", with_ctes(STOCK_VIEWS, CTE_RECEIVABLES + [("cobrar", RECEIVABLES)])
          + "SELECT codigo_proyecto, documento_cliente, total_venta_items, " + _PLACE.format(
              "proyecto NULLS LAST, total_venta_items DESC NULLS LAST, codigo_proyecto NULLS LAST, documento_cliente NULLS LAST")
          + " FROM cobrar")
def so02(spark, sf):
    """SO-02: receivables by project, the largest total first, as each row's place."""
    rows = rc.receivables(sources(spark, sf)).select("proyecto", "codigo_proyecto", "documento_cliente", "total_venta_items")
    return dd.row_positions(rows, rc.receivables_order(), "fila").drop("proyecto")


@register("sc35_kpi_text", with_ctes(STOCK_VIEWS, CTE_STOCK + [("stock", STOCK)]) + """
SELECT format('{:,}', count(*)) AS total_unidades,
  format('{:,}', count(*) FILTER (WHERE estado_comercial = 'Disponible')) AS disponibles,
  format('{:,}', count(*) FILTER (WHERE estado_comercial = 'Vendido')) AS vendidas,
  'S/ ' || format('{:,}', CAST(round(coalesce(sum(precio_de_lista_actual), 0), 0) AS BIGINT)) AS valor_lista,
  'S/ ' || format('{:,}', CAST(round(coalesce(sum(precio_de_lista_actual) FILTER (WHERE estado_comercial = 'Disponible'),
    0), 0) AS BIGINT)) AS valor_disponible
FROM stock""")
def sc35(spark, sf):
    """SC-35: KPI row as display text (``S/ 1,234``, thousands separators)."""
    return db.stock_kpi_text(db.stock_kpis(st.build_marts(sources(spark, sf))[2]))



_DIRECT = ("SELECT *, CASE WHEN documento_conyuge IS NOT NULL THEN 'Cónyuge de ' || documento_cliente END AS copropietario1, "
           "documento_conyuge AS dni_cotitular_1, documento_copropietarios AS doc_coprop_2 FROM {p}")


@register("ar03_coowners_direct", with_ctes(["procesos"], [("d", _DIRECT.format(p="procesos"))]) + f"""
SELECT codigo_proforma,
  arg_min(copropietario1, id_proceso) FILTER (WHERE copropietario1 IS NOT NULL) AS copropietario_1,
  arg_min({dockey('dni_cotitular_1')}, id_proceso) FILTER (WHERE {dockey('dni_cotitular_1')} IS NOT NULL) AS dni_coprop_1,
  CAST(NULL AS VARCHAR) AS copropietario_2,
  arg_min({dockey('doc_coprop_2')}, id_proceso) FILTER (WHERE {dockey('doc_coprop_2')} IS NOT NULL) AS dni_coprop_2,
  CAST(NULL AS VARCHAR) AS copropietario_3, CAST(NULL AS VARCHAR) AS dni_coprop_3
FROM d GROUP BY codigo_proforma""")
def ar03(spark, sf):
    """AR-03: co-owners from direct columns (aliases picked per slot), merged per proforma."""
    direct = spark.sql(_DIRECT.format(p="{p}"), p=view(spark, sf, "procesos"))
    return sl.coowners_from_columns(direct)
