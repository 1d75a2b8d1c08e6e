"""Receivables (JOB-05) and sales catalogue (JOB-06) queries."""

from __future__ import annotations

from tejado.catalog import register
from tejado.catalog.sqlfn import dockey, first_row, nt, num, split_codes, type_sales, ustrip, with_ctes
from tejado.catalog.stock_queries import CTE_SILVER, STOCK_VIEWS, sources
from tejado.plans import receivables as rc
from tejado.plans import sales as sl

# ---------------------------------------------------------------- receivables
SEPR = f"""
SELECT fecha_inicio AS fecha_separacion, codigo_proforma, documento_cliente, codigo_unidad AS codigo_principal,
  codigo_proyecto, coalesce(usuario_separacion, usuario, asesor) AS usuario_separacion, estado, tipo_financiamiento,
  codigo_unidades_asignadas AS adicionales_sep_raw, id_proceso
FROM procesos WHERE {nt('nombre')} = 'SEPARACION' AND {nt('estado')} = 'ACTIVO' AND codigo_proforma IS NOT NULL"""
RBASE = "SELECT s.*, v.fecha_minuta, v.adicionales_ven_raw FROM sepr s LEFT JOIN sven v ON v.codigo_proforma = s.codigo_proforma"


def _items0(base, common, seps):
    return f"""
SELECT {common}, {ustrip('codigo_principal')} AS codigo_item, 'PRINCIPAL' AS origen_item FROM {base}
WHERE codigo_principal IS NOT NULL AND {ustrip('codigo_principal')} <> ''
UNION ALL SELECT {common}, unnest({split_codes('adicionales_sep_raw', seps)}), 'ADICIONAL_SEPARACION' FROM {base}
UNION ALL SELECT {common}, unnest({split_codes('adicionales_ven_raw', seps)}), 'ADICIONAL_VENTA' FROM {base}"""


_RCOMMON = ("codigo_proforma, documento_cliente, codigo_proyecto, usuario_separacion, fecha_separacion, fecha_minuta, "
            "tipo_financiamiento")
RUNITS = first_row(f"""
SELECT codigo AS codigo_item, nombre AS item_nombre, tipo_unidad, {num('precio_venta')} AS precio_venta,
  {nt('tipo_unidad')} AS tipo_unidad_norm, orden_fila FROM unidades""", "codigo_item", "orden_fila")
_TN = "coalesce(u.tipo_unidad_norm, '')"
RITEMS_CAT = f"""
SELECT i.*, u.item_nombre, u.tipo_unidad, u.precio_venta, u.tipo_unidad_norm,
  CASE WHEN {_TN} IN ('DEPARTAMENTO FLAT', 'DEPARTAMENTO DUPLEX', 'DEPARTAMENTO TRIPLEX') THEN 'DEPA'
       WHEN starts_with({_TN}, 'ESTACIONAMIENTO') THEN 'ESTAC' WHEN {_TN} = 'DEPOSITO' THEN 'DEPO' ELSE 'OTRO' END AS categoria
FROM ritems i JOIN runits u ON u.codigo_item = i.codigo_item"""
RCLI = first_row(f"""
SELECT documento AS documento_cliente, {dockey('documento')} AS documento_cliente_norm,
  coalesce(cliente, {ustrip("coalesce(nombres, '') || ' ' || coalesce(apellidos, '')")}) AS cliente,
  medio_captacion, celulares, email, orden_fila FROM clientes""", "documento_cliente", "orden_fila")
RDF = """
SELECT ic.*, p.proyecto, c.cliente, c.medio_captacion, c.celulares, c.email
FROM ritems_cat ic LEFT JOIN sp p ON p.codigo_proyecto = ic.codigo_proyecto
LEFT JOIN rcli c ON c.documento_cliente = ic.documento_cliente
WHERE ic.categoria IN ('DEPA', 'ESTAC', 'DEPO')"""


def _ju(expr, cond="TRUE"):
    t = ustrip(expr)
    return f"nullif(string_agg(DISTINCT {t}, ' | ' ORDER BY {t}) FILTER (WHERE ({cond}) AND {t} <> ''), '')"


def _tot(cond):
    return f"round(coalesce(sum(CASE WHEN {cond} THEN coalesce(precio_venta, 0) ELSE 0 END), 0), 2)"


RECEIVABLES = f"""
SELECT proyecto, codigo_proyecto, documento_cliente, {dockey('documento_cliente')} AS documento_cliente_norm,
  max(cliente) AS cliente, max(medio_captacion) AS medio_captacion, max(celulares) AS celulares, max(email) AS email,
  max(usuario_separacion) AS asesor, {_ju('codigo_proforma')} AS codigo_proformas,
  {_ju('tipo_financiamiento')} AS tipos_financiamiento, {_ju('item_nombre', "categoria = 'DEPA'")} AS departamentos,
  {_ju('item_nombre', "categoria = 'ESTAC'")} AS estacionamientos, {_ju('item_nombre', "categoria = 'DEPO'")} AS depositos,
  {_tot("categoria = 'DEPA'")} AS total_departamentos, {_tot("categoria = 'ESTAC'")} AS total_estacionamientos,
  {_tot("categoria = 'DEPO'")} AS total_depositos, {_tot('TRUE')} AS total_venta_items,
  min(fecha_separacion) AS primera_separacion, max(fecha_minuta) AS ultima_minuta
FROM rdf GROUP BY proyecto, codigo_proyecto, documento_cliente"""

CTE_RECEIVABLES = CTE_SILVER + [("sepr", SEPR), ("rbase", RBASE), ("ritems0", _items0("rbase", _RCOMMON + ", id_proceso", "[,]")),
                                # one row per (proforma, item): by origin, then in file order
                                ("ritems", "SELECT * EXCLUDE (id_proceso) FROM " + first_row(
                                    "SELECT * FROM ritems0", "codigo_proforma, codigo_item", "origen_item, id_proceso")),
                                ("runits0", RUNITS), ("runits", "SELECT * EXCLUDE (orden_fila) FROM runits0"),
                                ("ritems_cat", RITEMS_CAT), ("rcli0", RCLI),
                                ("rcli", "SELECT * EXCLUDE (orden_fila) FROM rcli0"), ("rdf", RDF)]


@register("job05_receivables", with_ctes(STOCK_VIEWS, CTE_RECEIVABLES) + RECEIVABLES)
def job05_receivables(spark, sf):
    """JOB-05 with JN-07, AG-04, AG-06, AG-07, SC-11d, FLT-15, SO-02."""
    return rc.receivables(sources(spark, sf))


@register("job05_items_audit", with_ctes(STOCK_VIEWS, CTE_RECEIVABLES) + "SELECT * FROM ritems_cat")
def job05_items(spark, sf):
    """JOB-05 audit table: JN-01, AR-01 (comma-only split, T-18), JN-03, SC-11d."""
    return rc.items(sources(spark, sf))


@register("ag13_item_mix", with_ctes(STOCK_VIEWS, CTE_RECEIVABLES)
          + "SELECT categoria, count(*) AS cantidad FROM ritems_cat GROUP BY categoria")
def ag13_item_mix(spark, sf):
    """AG-13: rows per item category (null included)."""
    return rc.item_mix(rc.items(sources(spark, sf)))


# ---------------------------------------------------------------- sales catalogue
SSEP_S = first_row("""
SELECT fecha_inicio AS fecha_separacion, codigo_proforma, documento_cliente, codigo_unidad AS codigo_principal,
  codigo_proyecto, coalesce(usuario_separacion, usuario, asesor) AS usuario_separacion, tipo_financiamiento,
  codigo_unidades_asignadas AS adicionales_sep_raw, id_proceso FROM sep1""", "codigo_proforma", "id_proceso DESC")
SBASE = """
SELECT s.* EXCLUDE (id_proceso), v.fecha_minuta, v.adicionales_ven_raw,
  CASE WHEN v.fecha_minuta IS NOT NULL THEN 'Venta con minuta' ELSE 'Separación sin minuta' END AS estado_operacion
FROM ssep_s s LEFT JOIN sven v ON v.codigo_proforma = s.codigo_proforma"""
_SCOMMON = ("codigo_proforma, documento_cliente, codigo_proyecto, fecha_separacion, fecha_minuta, tipo_financiamiento, "
            "estado_operacion")
SUNITS = first_row(f"""
SELECT codigo AS codigo_item, nombre AS item_nombre, tipo_unidad AS tipo_unidad_raw,
  {num('precio_base_proforma')} AS precio_base_proforma, {num('precio_base_proforma')} AS precio_lista_al_comprar,
  {num('precio_venta')} AS precio_venta, {type_sales('tipo_unidad')} AS tipo_unidad, orden_fila FROM unidades""",
                   "codigo_item", "orden_fila")
_RAW = ustrip("coalesce(u.item_nombre, i.codigo_item)")
_TR = f"coalesce({nt('u.tipo_unidad_raw')}, '')"
NUM_UNIDAD = (f"CASE WHEN {_RAW} IS NULL OR {_RAW} = '' THEN NULL "
              f"WHEN {_TR} LIKE '%DEPARTAMENTO%' OR {_TR} IN ('FLAT', 'DUPLEX', 'TRIPLEX') THEN {_RAW} "
              f"WHEN len(regexp_extract_all({_RAW}, '(\\d+)', 1)) > 0 THEN regexp_extract_all({_RAW}, '(\\d+)', 1)[-1] "
              f"ELSE {_RAW} END")
SALES = f"""
SELECT p.proyecto, u.tipo_unidad, {NUM_UNIDAD} AS num_unidad, c.comprador,
  coalesce(c.dni_comprador, {dockey('i.documento_cliente')}) AS dni_comprador,
  cp.copropietario_1, cp.dni_coprop_1, cp.copropietario_2, cp.dni_coprop_2, cp.copropietario_3, cp.dni_coprop_3,
  u.precio_lista_al_comprar, u.precio_venta, i.codigo_proforma, i.codigo_item, i.origen_item, i.fecha_minuta,
  CASE WHEN cp.dni_coprop_1 IS NOT NULL OR cp.dni_coprop_2 IS NOT NULL OR cp.dni_coprop_3 IS NOT NULL
       THEN 'Sí' ELSE 'No' END AS flag_tiene_coprop,
  CAST((cp.dni_coprop_1 IS NOT NULL)::INT + (cp.dni_coprop_2 IS NOT NULL)::INT + (cp.dni_coprop_3 IS NOT NULL)::INT
       AS BIGINT) AS total_coprops,
  u.precio_venta / 1000 AS precio_venta_miles
FROM sitems i LEFT JOIN sunits u ON u.codigo_item = i.codigo_item
LEFT JOIN sp p ON p.codigo_proyecto = i.codigo_proyecto
LEFT JOIN sc c ON c.documento_cliente = i.documento_cliente
LEFT JOIN cop cp ON cp.codigo_proforma = i.codigo_proforma"""
CTE_SALES = CTE_SILVER + [("ssep_s", SSEP_S), ("sbase", SBASE), ("sitems0", _items0("sbase", _SCOMMON, "[,;|]")),
                          ("sitems", f"SELECT {_SCOMMON}, codigo_item, min(origen_item) AS origen_item FROM sitems0 GROUP BY ALL"),
                          ("sunits0", SUNITS), ("sunits", "SELECT * EXCLUDE (orden_fila) FROM sunits0")]
SALES_EXTRA = ["codigo_proforma", "codigo_item", "origen_item", "fecha_minuta", "flag_tiene_coprop", "total_coprops",
               "precio_venta_miles"]


@register("job06_sales", with_ctes(STOCK_VIEWS, CTE_SALES) + SALES)
def job06_sales(spark, sf):
    """JOB-06 with JN-01, SC-11b, SC-13, SC-32, SC-33, PRJ-08, PRJ-15/16."""
    return sl.sales(sources(spark, sf), extra=SALES_EXTRA)


@register("ag10_sales_by_project", with_ctes(STOCK_VIEWS, CTE_SALES) + f"""
SELECT proyecto, CAST(count(proyecto) AS BIGINT) AS items_vendidos,
  CAST(count(DISTINCT dni_comprador) AS BIGINT) AS compradores,
  round(coalesce(sum(precio_venta), 0), 2) AS precio_venta_total
FROM ({SALES}) q GROUP BY proyecto""")
def ag10_sales_by_project(spark, sf):
    """AG-10: items (T-04: count of the project column), distinct buyers, total per project."""
    from tejado.plans.dashboard import sales_summary
    return sales_summary(sl.sales(sources(spark, sf), extra=SALES_EXTRA, sort=False))
