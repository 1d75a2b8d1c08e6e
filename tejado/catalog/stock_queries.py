"""Stock, owners and silver-table queries (JOB-01..03 and the operators inside them)."""

from __future__ import annotations

from tejado.catalog import register
from tejado.catalog.sqlfn import client_name, dockey, first_row, nt, num, pct, split_codes, type_stock, ustrip, with_ctes
from tejado.plans import stock as st
from tejado.plans.adapters import view

STOCK_VIEWS = ["unidades", "proyectos", "clientes", "procesos"]


def sources(spark, sf):
    return {n: view(spark, sf, n) for n in STOCK_VIEWS}


# ---------------------------------------------------------------- DuckDB fragments
SU = first_row(f"""
SELECT codigo, codigo AS codigo_item, codigo_proyecto, proyecto AS proyecto_from_unidades, torre,
  nullif({ustrip('nombre')}, '') AS nombre, tipo_unidad AS tipo_de_unidad,
  {type_stock('tipo_unidad')} AS tipo_de_unidad_norm, estado_comercial AS estado_comercial_raw,
  {num('precio_venta')} AS precio_venta_unidad, {num('precio_base_proforma')} AS precio_lista_al_comprar_unidad,
  coalesce({num('precio_lista_actual')}, {num('precio_base_proforma')}) AS precio_de_lista_actual,
  {pct('descuento_actual')} AS descuento_actual_raw, {num('monto_descuento')} AS monto_actual_dscto_raw, orden_fila
FROM unidades""", "codigo", "orden_fila")
SU_SEL = "SELECT * EXCLUDE (orden_fila) FROM su0"

SP = "SELECT * EXCLUDE (orden_fila) FROM " + first_row(
    f"SELECT codigo AS codigo_proyecto, nombre AS proyecto, {nt('nombre')} AS proyecto_norm, orden_fila FROM proyectos",
    "codigo_proyecto", "orden_fila")

SC = first_row(f"""
SELECT documento AS documento_cliente, {dockey('documento')} AS dni_comprador,
  {client_name('cliente', 'nombres', 'apellidos')} AS comprador, orden_fila FROM clientes""",
               "documento_cliente", "orden_fila")

SEP0 = f"SELECT * FROM procesos WHERE {nt('nombre')} = 'SEPARACION' AND codigo_proforma IS NOT NULL"
SEP1 = (f"SELECT * FROM sep0 WHERE (SELECT max(CASE WHEN {nt('estado')} = 'ACTIVO' THEN 1 ELSE 0 END) FROM sep0) = 0 "
        f"OR coalesce({nt('estado')} = 'ACTIVO', false)")
SSEP = first_row("""
SELECT fecha_inicio AS fecha_separacion, codigo_proforma, documento_cliente, codigo_unidad AS codigo_principal,
  codigo_proyecto, tipo_financiamiento, codigo_unidades_asignadas AS adicionales_sep_raw, id_proceso FROM sep1""",
                 "codigo_proforma", "id_proceso DESC")
SSEP_SEL = "SELECT * EXCLUDE (id_proceso) FROM ssep0"
SVEN = f"""
SELECT codigo_proforma, max(fecha_fin) AS fecha_minuta,
  arg_min(codigo_unidades_asignadas, id_proceso) FILTER (WHERE codigo_unidades_asignadas IS NOT NULL) AS adicionales_ven_raw
FROM procesos WHERE {nt('nombre')} = 'VENTA' AND codigo_proforma IS NOT NULL GROUP BY codigo_proforma"""

NAMES = first_row(f"""
SELECT {dockey('documento')} AS doc_key, {client_name('cliente', 'nombres', 'apellidos')} AS nombre_doc, orden_fila
FROM clientes WHERE {dockey('documento')} IS NOT NULL""", "doc_key", "orden_fila")

COP_PARTS = f"""
SELECT codigo_proforma, id_proceso, 1 AS src, unnest({split_codes('documento_copropietarios')}) AS raw,
  generate_subscripts({split_codes('documento_copropietarios')}, 1) AS pos FROM procesos WHERE codigo_proforma IS NOT NULL
UNION ALL
SELECT codigo_proforma, id_proceso, 2 AS src, unnest({split_codes('documento_conyuge')}) AS raw,
  generate_subscripts({split_codes('documento_conyuge')}, 1) AS pos FROM procesos WHERE codigo_proforma IS NOT NULL"""
COP_DOCS = f"""
SELECT codigo_proforma, id_proceso, {dockey('raw')} AS doc, min(src * 1000000 + pos) AS o
FROM cop_parts WHERE {dockey('raw')} IS NOT NULL GROUP BY codigo_proforma, id_proceso, {dockey('raw')}"""
COP_SLOTS = """
SELECT *, row_number() OVER (PARTITION BY codigo_proforma, id_proceso ORDER BY o) AS slot FROM cop_docs"""
COP = "SELECT codigo_proforma, " + ", ".join(
    f"arg_min(n.nombre_doc, id_proceso) FILTER (WHERE slot = {i} AND n.nombre_doc IS NOT NULL) AS copropietario_{i}, "
    f"arg_min(doc, id_proceso) FILTER (WHERE slot = {i}) AS dni_coprop_{i}" for i in (1, 2, 3)) + """
FROM cop_slots LEFT JOIN names n ON n.doc_key = cop_slots.doc WHERE slot <= 3 GROUP BY codigo_proforma"""

BASE = """
SELECT s.*, v.fecha_minuta, v.adicionales_ven_raw FROM ssep s JOIN sven v ON v.codigo_proforma = s.codigo_proforma"""
_COMMON = "codigo_proforma, documento_cliente, codigo_proyecto, fecha_separacion, fecha_minuta, tipo_financiamiento"
ITEMS0 = f"""
SELECT {_COMMON}, {ustrip('codigo_principal')} AS codigo_item, 'PRINCIPAL' AS origen_item FROM base
WHERE codigo_principal IS NOT NULL AND {ustrip('codigo_principal')} <> ''
UNION ALL SELECT {_COMMON}, unnest({split_codes('adicionales_sep_raw')}), 'ADICIONAL_SEPARACION' FROM base
UNION ALL SELECT {_COMMON}, unnest({split_codes('adicionales_ven_raw')}), 'ADICIONAL_VENTA' FROM base"""
ITEMS = f"SELECT {_COMMON}, codigo_item, min(origen_item) AS origen_item FROM items0 GROUP BY ALL"

OWN1 = """
SELECT coalesce(p.proyecto, u.proyecto_from_unidades) AS proyecto,
  coalesce(u.tipo_de_unidad, u.tipo_de_unidad_norm) AS tipo_de_unidad,
  nullif(regexp_replace(coalesce(u.nombre, i.codigo_item), '^\\s+|\\s+$', '', 'g'), '') AS nombre,
  u.codigo, c.comprador, c.dni_comprador,
  cp.copropietario_1, cp.dni_coprop_1, cp.copropietario_2, cp.dni_coprop_2, cp.copropietario_3, cp.dni_coprop_3,
  u.precio_lista_al_comprar_unidad AS precio_lista_al_comprar, u.precio_venta_unidad AS precio_venta,
  i.codigo_proforma, i.fecha_separacion, i.fecha_minuta, i.origen_item,
  row_number() OVER (PARTITION BY u.codigo, i.codigo_proforma ORDER BY i.codigo_item DESC, i.origen_item DESC) AS rn
FROM items i
LEFT JOIN su u ON u.codigo_item = i.codigo_item
LEFT JOIN sp p ON p.codigo_proyecto = coalesce(i.codigo_proyecto, u.codigo_proyecto)
LEFT JOIN sc c ON c.documento_cliente = i.documento_cliente
LEFT JOIN cop cp ON cp.codigo_proforma = i.codigo_proforma"""
OWNERS = "SELECT * EXCLUDE (rn) FROM own1 WHERE rn = 1"

ONE = first_row("""
SELECT codigo, comprador, dni_comprador, copropietario_1, dni_coprop_1, copropietario_2, dni_coprop_2,
  copropietario_3, dni_coprop_3, precio_venta, codigo_proforma FROM owners WHERE codigo IS NOT NULL""",
                "codigo", "codigo_proforma DESC")
_OWNER = "(o.comprador IS NOT NULL OR o.dni_comprador IS NOT NULL OR o.precio_venta IS NOT NULL)"
_RAW = nt("u.estado_comercial_raw")
_TIPO = "coalesce(u.tipo_de_unidad, u.tipo_de_unidad_norm)"
_PCT = (f"(CASE WHEN u.precio_de_lista_actual IS NULL THEN NULL ELSE coalesce(u.descuento_actual_raw, "
        f"u.monto_actual_dscto_raw / nullif(u.precio_de_lista_actual, 0), "
        f"CASE WHEN coalesce(lower({_TIPO}) LIKE '%departamento%', false) THEN 0.08 ELSE 0.0 END) END)")
STOCK = f"""
SELECT coalesce(p.proyecto, u.proyecto_from_unidades) AS proyecto, u.torre, u.nombre, {_TIPO} AS tipo_de_unidad,
  u.codigo, u.estado_comercial_raw,
  CASE WHEN {_OWNER} THEN 'Vendido' WHEN coalesce(regexp_matches({_RAW}, 'DISP|LIBRE|STOCK'), false) THEN 'Disponible'
       WHEN coalesce(regexp_matches({_RAW}, 'VEND|SEPAR|MINUTA|PROCESO DE VENTA'), false) THEN 'Vendido'
       ELSE 'Disponible' END AS estado_comercial,
  o.comprador, o.dni_comprador, o.copropietario_1, o.dni_coprop_1, o.copropietario_2, o.dni_coprop_2,
  o.copropietario_3, o.dni_coprop_3, u.precio_lista_al_comprar_unidad AS precio_lista_al_comprar, o.precio_venta,
  u.precio_de_lista_actual, {_PCT} AS descuento_actual,
  coalesce(u.monto_actual_dscto_raw, u.precio_de_lista_actual * {_PCT}) AS monto_actual_dscto
FROM su u LEFT JOIN sp p ON p.codigo_proyecto = u.codigo_proyecto LEFT JOIN one o ON o.codigo = u.codigo"""

CTE_SILVER = [("su0", SU), ("su", SU_SEL), ("sp", SP), ("sc0", SC), ("sc", "SELECT * EXCLUDE (orden_fila) FROM sc0"),
              ("sep0", SEP0), ("sep1", SEP1), ("ssep0", SSEP), ("ssep", SSEP_SEL), ("sven", SVEN),
              ("names0", NAMES), ("names", "SELECT * EXCLUDE (orden_fila) FROM names0"),
              ("cop_parts", COP_PARTS), ("cop_docs", COP_DOCS), ("cop_slots", COP_SLOTS), ("cop", COP)]
CTE_OWNERS = CTE_SILVER + [("base", BASE), ("items0", ITEMS0), ("items", ITEMS), ("own1", OWN1), ("owners", OWNERS)]
CTE_STOCK = CTE_OWNERS + [("one", ONE)]


def _sql(ctes, final):
    return with_ctes(STOCK_VIEWS, ctes) + final


# ---------------------------------------------------------------- registrations
@register("job03_stock", _sql(CTE_STOCK, STOCK))
def job03_stock(spark, sf):
    """Flagship: the full stock mart (every unit, owner, status, discount)."""
    s, own, stock = st.build_marts(sources(spark, sf))
    return stock


@register("job02_owners", _sql(CTE_OWNERS, "SELECT * FROM owners"))
def job02_owners(spark, sf):
    s = st.silver(sources(spark, sf))
    return st.owners(s)


@register("job01_silver_unidades", _sql(CTE_SILVER, "SELECT * FROM su"))
def job01_silver_units(spark, sf):
    return st.silver_units(view(spark, sf, "unidades"))


@register("job01_silver_proyectos", _sql(CTE_SILVER, "SELECT * FROM sp"))
def job01_silver_projects(spark, sf):
    return st.silver_projects(view(spark, sf, "proyectos"))


@register("job01_silver_clientes", _sql(CTE_SILVER, "SELECT * FROM sc"))
def job01_silver_clients(spark, sf):
    return st.silver_clients(view(spark, sf, "clientes"))


@register("job01_silver_separaciones", _sql(CTE_SILVER, "SELECT * FROM ssep"))
def job01_silver_reservations(spark, sf):
    """FLT-07/08 + WD-02: active reservations, last per proforma."""
    return st.silver_reservations(view(spark, sf, "procesos"))


@register("ag01_silver_ventas", _sql(CTE_SILVER, "SELECT * FROM sven"))
def ag01_sales(spark, sf):
    """AG-01 + AG-02: last signing date and first non-null packed list per proforma."""
    return st.silver_sales(view(spark, sf, "procesos"))


@register("ar02_silver_copropietarios", _sql(CTE_SILVER, "SELECT * FROM cop"))
def ar02_coowners(spark, sf):
    """AR-02 + WD-07 + JN-08 + AG-08: co-owner slots per proforma (proformas with documents)."""
    out = st.silver_coowners(view(spark, sf, "procesos"), view(spark, sf, "clientes"))
    return out.where("dni_coprop_1 IS NOT NULL")


@register("ar01_items", _sql(CTE_OWNERS, "SELECT * FROM items"))
def ar01_items(spark, sf):
    """AR-01 + WD-03 + JN-02: items of every sold proforma, one per (proforma, item)."""
    from tejado.operators.arrays import ADD_RESERVATION, ADD_SALE, explode_items
    s = st.silver(sources(spark, sf))
    base = s["silver_separaciones"].join(s["silver_ventas"], on="codigo_proforma", how="inner")
    common = ["documento_cliente", "codigo_proyecto", "fecha_separacion", "fecha_minuta", "tipo_financiamiento"]
    return explode_items(base, "codigo_principal",
                         [("adicionales_sep_raw", ADD_RESERVATION), ("adicionales_ven_raw", ADD_SALE)], common)
