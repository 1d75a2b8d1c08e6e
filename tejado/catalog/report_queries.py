"""Parking audit (JOB-07), delivery lists (JOB-12) and mart quality (JOB-15) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tejado.catalog import register
from tejado.catalog.sqlfn import first_row, nc, strict_doc, ustrip, with_ctes
from tejado.catalog.stock_queries import CTE_STOCK, STOCK, STOCK_VIEWS, sources
from tejado.functions.contacts import DOMAIN_TYPOS, EMAIL_STRICT, KNOWN_DOMAINS
from tejado.plans import deliveries as dl
from tejado.plans import parking as pk
from tejado.plans import quality as qa
from tejado.plans import stock as st
from tejado.plans.adapters import view
from tejado.session import scratch_path

# ---------------------------------------------------------------- JOB-07
PROJECTS = [f"BRAND#{i}" for i in range(1, 11)]
_IN = ", ".join(f"'{p.lower()}'" for p in PROJECTS)
_T = nc("tipo_unidad_principal")
REL = f"""
SELECT *, CASE WHEN starts_with({_T}, 'departamento') THEN 'departamento'
  WHEN starts_with({_T}, 'estacionamiento') THEN 'estacionamiento' WHEN starts_with({_T}, 'cochera') THEN 'estacionamiento'
  WHEN starts_with({_T}, 'deposito') THEN 'deposito' WHEN starts_with({_T}, 'local comercial') THEN 'local comercial'
  ELSE 'otro' END AS tipo_unidad_homologado
FROM procesos WHERE {nc('estado')} = 'activo' AND {nc('codigo_proyecto')} IN ({_IN})"""
RISK = (f"SELECT * FROM rel WHERE tipo_unidad_homologado = 'estacionamiento' AND "
        f"(codigo_unidades_asignadas IS NULL OR {ustrip('codigo_unidades_asignadas')} = '')")
CTE_PARK = [("rel", REL), ("risk", RISK)]


def _park(spark, sf):
    procesos = view(spark, sf, "procesos")
    rel = pk.relevant_processes(procesos, PROJECTS)
    return procesos, rel, pk.parking_at_risk(rel), pk.active_flats(rel)


@register("job07_parking_at_risk", with_ctes(["procesos"], CTE_PARK) + "SELECT * FROM risk")
def job07_at_risk(spark, sf):
    """JOB-07 / FLT-16: FLT-01..05 (igual_ci, en_ci, vacio, equality), SC-11c."""
    return _park(spark, sf)[2]


@register("job07_active_flats", with_ctes(["procesos"], CTE_PARK)
          + "SELECT * FROM rel WHERE tipo_unidad_homologado = 'departamento'")
def job07_flats(spark, sf):
    return _park(spark, sf)[3]


@register("flt06_filter_report", with_ctes(["procesos"], CTE_PARK) + """
SELECT 'proyectos activos relevantes' AS filtro, a.antes, d.despues, a.antes - d.despues AS descartadas,
  CASE WHEN a.antes > 0 THEN round(d.despues * 100.0 / a.antes, 2) ELSE 0.0 END AS pct_conservado
FROM (SELECT count(*) AS antes FROM procesos) a, (SELECT count(*) AS despues FROM rel) d""")
def flt06_report(spark, sf):
    """FLT-06: rows before/after/dropped/% kept of the scope filter, one pass."""
    return pk.scope_report(view(spark, sf, "procesos"), PROJECTS)


@register("ar04_at_risk_by_project", with_ctes(["procesos"], CTE_PARK)
          + "SELECT nombre_proyecto, count(*) AS cantidad FROM risk GROUP BY 1")
def ar04_by_project(spark, sf):
    """AR-04 unfolded: the per-project counts of the run summary map."""
    return pk.at_risk_by_project(_park(spark, sf)[2])


@register("snk07_run_summary", with_ctes(["procesos"], CTE_PARK) + """
SELECT (SELECT count(*) FROM procesos) AS filas_procesos_originales,
  (SELECT count(*) FROM rel) AS filas_procesos_activos_relevantes,
  (SELECT count(*) FROM risk) AS filas_cocheras_activas_sin_unidad_asignada,
  (SELECT count(*) FROM rel WHERE tipo_unidad_homologado = 'departamento') AS filas_departamentos_activos,
  coalesce(nombre_proyecto, 'None') AS proyecto, count(*) AS cocheras FROM risk GROUP BY coalesce(nombre_proyecto, 'None')""")
def snk07_summary(spark, sf):
    """SNK-07 + AR-04: the run summary written and read back, its per-project map unfolded into rows."""
    path = scratch_path(spark, "snk07")
    pk.run_summary(view(spark, sf, "procesos"), PROJECTS).write.parquet(path)
    row = spark.read.parquet(path)
    return row.select(*[c for c in row.columns if c.startswith("filas_")], F.explode("cocheras_por_proyecto").alias("proyecto", "cocheras"))


# ---------------------------------------------------------------- JOB-12
_D = "coalesce(regexp_replace(celulares, '[^0-9]', '', 'g'), '')"
_D1 = f"(CASE WHEN starts_with({_D}, '51') AND length({_D}) = 11 THEN substr({_D}, 3) ELSE {_D} END)"
_D2 = f"(CASE WHEN starts_with({_D1}, '0051') AND length({_D1}) = 13 THEN substr({_D1}, 5) ELSE {_D1} END)"
OWN = f"""
SELECT documento, celulares, email, telefono, nombres, apellidos, orden_fila, c AS celular_clean,
  length(c) AS celular_len, coalesce(length(c) = 9 AND starts_with(c, '9'), false) AS celular_ok
FROM (SELECT *, CASE WHEN celulares IS NULL THEN NULL ELSE nullif({_D2}, '') END AS c FROM clientes
      WHERE estado = 'Propietario') q"""
LOOKUP_COLS = ["celulares", "celular_clean", "email", "telefono", "nombres"]
OWN_LK = first_row(f"SELECT {strict_doc('documento', 8)} AS documento_key, * FROM own WHERE {strict_doc('documento', 8)} IS NOT NULL",
                   "documento_key", "orden_fila")
ENT = f"SELECT *, {strict_doc('dni', 8)} AS dni_key FROM entregas"
DEL1 = ("SELECT e.*, o.documento_key, " + ", ".join(f"o.{c}" for c in LOOKUP_COLS)
        + ", CASE WHEN o.documento_key IS NOT NULL THEN 'both' ELSE 'left_only' END AS _merge "
        "FROM ent e LEFT JOIN own_lk o ON o.documento_key = e.dni_key")
PROJECT = "Edificio Módena Brand#3"
SEPS = f"""
SELECT nombre_proyecto, tipo_unidad_principal, codigo_unidad, documento_cliente, nombres_usuario, id_proceso
FROM procesos WHERE {nc('nombre_proyecto')} = '{PROJECT.lower().replace('ó', 'o')}' AND {nc('estado')} = 'activo'
  AND {nc('nombre')} = 'separacion'"""
SEP_LK = first_row(f"SELECT {strict_doc('documento_cliente', 8)} AS documento_key_sep, documento_cliente, nombres_usuario, "
                   f"codigo_unidad, id_proceso FROM seps WHERE {strict_doc('documento_cliente', 8)} IS NOT NULL",
                   "documento_key_sep", "id_proceso")
DEL2 = """
SELECT d.*, s.documento_key_sep, s.documento_cliente, s.nombres_usuario, s.codigo_unidad,
  CASE WHEN s.documento_key_sep IS NOT NULL THEN 'both' ELSE 'left_only' END AS merge_propietarios
FROM del1 d LEFT JOIN sep_lk s ON s.documento_key_sep = d.dni_key"""
_NUM = "regexp_replace(" + ustrip("numero_unidad") + ", '\\.0$', '')"
CODES = (f"SELECT *, CASE WHEN coalesce(upper({ustrip('tipo')}) = 'ESTACIONAMIENTO', false) THEN 'FX-E' || {_NUM} "
         f"ELSE 'FX-' || {_NUM} END AS codigo_unidad_entrega FROM entregas_proceso")
PEND = first_row(f"SELECT {strict_doc('codigo_unidad')} AS unidad_key_sep, nombres_usuario, documento_cliente, id_proceso "
                 f"FROM seps WHERE {strict_doc('codigo_unidad')} IS NOT NULL", "unidad_key_sep", "id_proceso")
PENDING = f"""
SELECT c.*, {strict_doc('c.codigo_unidad_entrega')} AS unidad_key, s.unidad_key_sep, s.nombres_usuario, s.documento_cliente,
  CASE WHEN s.unidad_key_sep IS NOT NULL THEN 'both' ELSE 'left_only' END AS _merge
FROM codes c LEFT JOIN pend s ON s.unidad_key_sep = {strict_doc('c.codigo_unidad_entrega')}"""
DEL_VIEWS = ["clientes", "entregas", "procesos", "entregas_proceso"]
CTE_DEL = [("own", OWN), ("own_lk0", OWN_LK), ("own_lk", "SELECT * EXCLUDE (orden_fila) FROM own_lk0"),
           ("ent", ENT), ("del1", DEL1), ("seps", SEPS), ("sep_lk0", SEP_LK),
           ("sep_lk", "SELECT * EXCLUDE (id_proceso) FROM sep_lk0"), ("del2", DEL2), ("codes", CODES),
           ("pend0", PEND), ("pend", "SELECT * EXCLUDE (id_proceso) FROM pend0"), ("pending", PENDING)]


def _owners(spark, sf, fix_emails=False):
    return dl.owners(view(spark, sf, "clientes"), fix_emails=fix_emails)


_EM = f"replace(replace(regexp_replace(lower({ustrip('email')}), '\\s+', '', 'g'), ',', '.'), '..', '.')"
_DOM = f"trim(string_split({_EM}, '@')[-1], '.')"
_NEAR = ", ".join(f"{{'d': 2 * levenshtein({_DOM}, '{k}') - abs(length({_DOM}) - {len(k)}), 'i': {i}, 'k': '{k}'}}" for i, k in enumerate(KNOWN_DOMAINS))
_FIXED = (f"(CASE {_DOM} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in DOMAIN_TYPOS.items()) + " ELSE coalesce("
          f"list_sort(list_filter([{_NEAR}], lambda x: x.d * 100 <= 12 * (length({_DOM}) + length(x.k))))[1].k, {_DOM}) END)")
EMAIL = (f"(CASE WHEN email IS NULL THEN NULL WHEN NOT contains({_EM}, '@') THEN {_EM} "
         f"ELSE trim(split_part({_EM}, '@', 1), '.') || '@' || {_FIXED} END)")


@register("sc19_owner_phones", with_ctes(DEL_VIEWS, CTE_DEL) + "SELECT * FROM own")
def sc19_owner_phones(spark, sf):
    """FLT-17 + SC-19 (notebook variant: 51 and 0051 prefixes) + SC-20 flags."""
    return _owners(spark, sf)


@register("job12_owner_contacts", with_ctes(DEL_VIEWS, CTE_DEL) + f"""
SELECT own.*, {EMAIL} AS email_clean, coalesce(regexp_matches({EMAIL}, '{EMAIL_STRICT}'), false) AS email_ok FROM own""")
def job12_owner_contacts(spark, sf):
    """SC-22 + SC-23: owners' e-mails cleaned, domains mended by the typo table, else to a known one by edit distance."""
    return _owners(spark, sf, fix_emails=True)


@register("jn12_deliveries_owners", with_ctes(DEL_VIEWS, CTE_DEL) + "SELECT * FROM del1")
def jn12_deliveries_owners(spark, sf):
    """JN-12: deliveries ⟕ owners (strict 8-digit key, SC-06) with indicator."""
    return dl.deliveries_with_owners(view(spark, sf, "entregas"), _owners(spark, sf), LOOKUP_COLS)


@register("job12_deliveries", with_ctes(DEL_VIEWS, CTE_DEL) + "SELECT * FROM del2")
def job12_deliveries(spark, sf):
    """JOB-12: deliveries ⟕ owners ⟕ active reservations of one project."""
    first = dl.deliveries_with_owners(view(spark, sf, "entregas"), _owners(spark, sf), LOOKUP_COLS)
    return dl.deliveries_with_reservations(first, dl.reservations_for(view(spark, sf, "procesos"), PROJECT))


@register("jn15_pending_by_unit", with_ctes(DEL_VIEWS, CTE_DEL) + "SELECT * FROM pending")
def jn15_pending(spark, sf):
    """JN-15 + SC-14: second list ⟕ reservations by the digits of the unit code."""
    return dl.pending_by_unit(view(spark, sf, "entregas_proceso"), dl.reservations_for(view(spark, sf, "procesos"), PROJECT))


@register("jn13_unmatched_deliveries", with_ctes(DEL_VIEWS, CTE_DEL)
          + "SELECT * FROM ent e WHERE NOT EXISTS (SELECT 1 FROM own_lk o WHERE o.documento_key = e.dni_key)")
def jn13_unmatched(spark, sf):
    """JN-13: deliveries without an owner (left anti join)."""
    return dl.unmatched_deliveries(view(spark, sf, "entregas"), _owners(spark, sf))


# ---------------------------------------------------------------- JOB-15
MONEY = ["precio_lista_al_comprar", "precio_venta", "precio_de_lista_actual", "descuento_actual", "monto_actual_dscto"]
QCOLS = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT (SELECT count(*) FROM stock) AS filas, '{c}' AS columna, count(*) FILTER (WHERE {c} IS NULL) AS nulos, "
    + (f"count({c}) AS no_nulos_num, round(coalesce(sum({c}), 0), 2) AS suma" if c in MONEY
       else "CAST(NULL AS BIGINT) AS no_nulos_num, CAST(NULL AS DOUBLE) AS suma") + " FROM stock"
    for c in st.STOCK_COLS) + ") q"
QSUM = f"""
SELECT count(*) AS filas, {len(st.STOCK_COLS)} AS columnas, '' AS faltantes, '' AS extra,
  count(*) FILTER (WHERE abs(monto_actual_dscto - precio_de_lista_actual * descuento_actual) > 0.05) AS montos_inconsistentes
FROM stock"""
CTE_Q = CTE_STOCK + [("stock", STOCK)]


def _stock(spark, sf):
    return st.build_marts(sources(spark, sf))[2]


@register("job15_quality_columns", with_ctes(STOCK_VIEWS, CTE_Q) + QCOLS)
def job15_columns(spark, sf):
    """AG-25: nulls per expected column, non-null count and sum per money column."""
    return qa.column_report(_stock(spark, sf))


@register("job15_quality_summary", with_ctes(STOCK_VIEWS, CTE_Q) + QSUM)
def job15_summary(spark, sf):
    """AG-25 + SE-04 + SC-36: shape, schema difference and inconsistent discount amounts."""
    return qa.summary(_stock(spark, sf))


@register("so03_available_sample", with_ctes(STOCK_VIEWS, CTE_Q) + """
SELECT * FROM stock WHERE estado_comercial = 'Disponible'
ORDER BY proyecto NULLS LAST, tipo_de_unidad NULLS LAST, nombre NULLS LAST, codigo NULLS LAST LIMIT 5""")
def so03_sample(spark, sf):
    """SO-03: top five available units in a stated order (the report's sample, a top-k)."""
    return qa.available_sample(_stock(spark, sf))
