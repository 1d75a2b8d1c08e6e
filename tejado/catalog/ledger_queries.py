"""Ledger enrichment queries (JOB-08, JOB-09 and the key functions inside them)."""

from __future__ import annotations

from tejado.catalog import register
from tejado.catalog.sqlfn import (company_of, first_non_blank, group_of, inv_canon, inv_flex, inv_key, ustrip,
                                  with_ctes)
from tejado.plans import ledger as lg
from tejado.plans.adapters import view

TARGETS = ["tipos_unidad_efac", "u1_tipo_efac", "u1_n_efac"]
CARRIED = ["efac_comprobante_raw", "efac_source_file", "efac_source_sheet", "efac_group", "efac_proyecto",
           "efac_estado_proyecto", "efac_descripcion_xml", "efac_concepto"]
LEDGER_COLS = ["nro_comprobante", "source_file", "tablon_file", "l_orderkey", "l_linenumber", "l_partkey", "monto"]

MROWS = f"""
SELECT id_comprobante AS efac_comprobante_raw, {inv_key('id_comprobante')} AS ex, {inv_flex('id_comprobante')} AS fx,
  tipos_unidad AS tipos_unidad_efac, u1_tipo AS u1_tipo_efac, u1_n AS u1_n_efac, proyecto AS efac_proyecto,
  estado_proyecto AS efac_estado_proyecto, descripcion_xml AS efac_descripcion_xml,
  concepto AS efac_concepto, master_file AS efac_source_file, hoja AS efac_source_sheet,
  coalesce({group_of('master_file')}, 'UNKNOWN') AS efac_group, orden_fila
FROM master WHERE {inv_key('id_comprobante')} <> ''"""


def _lookup(key, cols, count_col):
    vals = ", ".join(f"{first_non_blank(c, 'orden_fila')} AS {c}" for c in cols)
    return (f"SELECT efac_group AS grp, {key}, {vals}, count(*) AS {count_col} FROM mrows GROUP BY efac_group, {key} "
            f"UNION ALL SELECT 'ALL' AS grp, {key}, {vals}, count(*) AS {count_col} FROM mrows GROUP BY {key}")


LEX = _lookup("ex", TARGETS + CARRIED, "cnt_ex")
LFX = _lookup("fx", TARGETS + CARRIED, "cnt_fx")
LED = f"""
SELECT l.*, {inv_key('l.nro_comprobante')} AS k_ex, {inv_flex('l.nro_comprobante')} AS k_fx, coalesce(g.g, 'ALL') AS grp
FROM ledger l LEFT JOIN (SELECT DISTINCT efac_group AS g FROM mrows) g ON g.g = {group_of('l.source_file')}"""
M1 = """
SELECT led.*, """ + ", ".join(f"e.{c} AS {c}_e" for c in TARGETS + CARRIED) + """, e.cnt_ex
FROM led LEFT JOIN lex e ON e.grp = led.grp AND e.ex = led.k_ex AND led.k_ex <> ''"""
_ANY_E = " OR ".join(f"m1.{c}_e IS NOT NULL" for c in TARGETS)
_ANY_C = " OR ".join(f"coalesce(m1.{c}_e, f.{c}) IS NOT NULL" for c in TARGETS)
TWO_TIER = ("SELECT " + ", ".join(f"m1.{c}" for c in LEDGER_COLS) + ", "
            + ", ".join(f"coalesce(m1.{c}_e, f.{c}) AS {c}" for c in TARGETS + CARRIED)
            + f", CASE WHEN {_ANY_E} THEN 'EXACT_COMPROBANTE' WHEN {_ANY_C} THEN 'FLEX_SERIE_NUMERO' END AS efac_match_method"
            + ", coalesce(m1.cnt_ex, f.cnt_fx) AS efac_match_count"
            + "\nFROM m1 LEFT JOIN lfx f ON f.grp = m1.grp AND f.fx = m1.k_fx AND m1.k_fx <> ''")
CTE_TWO_TIER = [("mrows", MROWS), ("lex", LEX), ("lfx", LFX), ("led", LED), ("m1", M1), ("two_tier", TWO_TIER)]


@register("job08_ledger_two_tier", with_ctes(["ledger", "master"], CTE_TWO_TIER) + "SELECT * FROM two_tier")
def job08_two_tier(spark, sf):
    """JOB-08: JN-09 exact then flexible key, JN-11 routing by group, AG-15 compaction, SC-15/16/18."""
    return lg.enrich_two_tier(view(spark, sf, "ledger"), view(spark, sf, "master"), in_steps=True)


@register("ag16_two_tier_audit", with_ctes(["ledger", "master"], CTE_TWO_TIER) + """
SELECT source_file, CAST(count(*) AS BIGINT) AS rows, CAST(count(efac_match_method) AS BIGINT) AS matched,
  CAST(count(*) - count(efac_match_method) AS BIGINT) AS unmatched,
  round(count(efac_match_method) / count(*), 6) AS match_rate
FROM two_tier GROUP BY source_file""")
def ag16_two_tier_audit(spark, sf):
    """AG-16: match audit per ledger file."""
    return lg.match_summary(lg.enrich_two_tier(view(spark, sf, "ledger"), view(spark, sf, "master")), ["source_file"])


# ---------------------------------------------------------------- company-aware
CM_ROWS = f"""
SELECT company AS source_company, master_file AS efac_expected_master, master_file AS efac_source_file,
  hoja AS efac_source_sheet, {inv_canon('id_comprobante')} AS k, tipos_unidad AS tipos_unidad_efac,
  u1_tipo AS u1_tipo_efac, u1_n AS u1_n_efac, orden_fila
FROM master WHERE {inv_canon('id_comprobante')} <> ''"""
_CM_VALS = ["source_company", "efac_expected_master", "efac_source_file"] + TARGETS
CM = ("SELECT source_company AS comp, k, " + ", ".join(f"{first_non_blank(c, 'orden_fila')} AS {c}" for c in _CM_VALS)
      + ", count(*) AS efac_match_count FROM cm_rows GROUP BY source_company, k")
CM_SHEETS = f"""
SELECT comp, k, string_agg(sh, ' | ' ORDER BY o) AS efac_source_sheet FROM (
  SELECT source_company AS comp, k, {ustrip('efac_source_sheet')} AS sh, min(orden_fila) AS o FROM cm_rows
  WHERE efac_source_sheet IS NOT NULL AND {ustrip('efac_source_sheet')} <> '' GROUP BY ALL) q GROUP BY comp, k"""
_EXPECTED = ("CASE led2.comp WHEN 'URSA' THEN 'MAESTRO_COMPROBANTES_URSA.xlsx' "
             "WHEN '10_DE_ABRIL' THEN 'MAESTRO_COMPROBANTES_10_DE_ABRIL.xlsx' "
             "WHEN 'LYNX' THEN 'MAESTRO_COMPROBANTES_LYNX.xlsx' WHEN 'CYGNUS' THEN 'MAESTRO_COMPROBANTES_CYGNUS.xlsx' END")
LED2 = f"""
SELECT l.*, {inv_canon('l.nro_comprobante')} AS efac_comprobante_key, {company_of('l.source_file')} AS comp
FROM ledger l"""
BY_COMPANY = ("SELECT " + ", ".join(f"led2.{c}" for c in LEDGER_COLS) + """, led2.efac_comprobante_key,
  CASE WHEN h.comp IS NOT NULL THEN coalesce(m.source_company, led2.comp) END AS source_company,
  CASE WHEN h.comp IS NOT NULL THEN coalesce(m.efac_expected_master, """ + _EXPECTED + """) END AS efac_expected_master,
  m.efac_source_file, sh.efac_source_sheet, m.efac_match_count, m.tipos_unidad_efac, m.u1_tipo_efac, m.u1_n_efac,
  CASE WHEN m.tipos_unidad_efac IS NOT NULL OR m.u1_tipo_efac IS NOT NULL OR m.u1_n_efac IS NOT NULL
       THEN 'SOURCE_FILE_PLUS_COMPROBANTE' END AS efac_match_method,
  coalesce(led2.comp, 'SIN_COMPANY') AS audit_company
FROM led2 LEFT JOIN (SELECT DISTINCT comp FROM cm) h ON h.comp = led2.comp
LEFT JOIN cm m ON m.comp = led2.comp AND m.k = led2.efac_comprobante_key
LEFT JOIN cm_sheets sh ON sh.comp = led2.comp AND sh.k = led2.efac_comprobante_key""")
CTE_COMPANY = [("cm_rows", CM_ROWS), ("cm", CM), ("cm_sheets", CM_SHEETS), ("led2", LED2), ("by_company", BY_COMPANY)]


@register("job09_ledger_by_company", with_ctes(["ledger", "master"], CTE_COMPANY)
          + "SELECT * EXCLUDE (audit_company) FROM by_company")
def job09_by_company(spark, sf):
    """JOB-09: JN-10 one join on (company, canonical key); SC-17, SC-18, AG-05, AG-15."""
    return lg.enrich_by_company(view(spark, sf, "ledger"), view(spark, sf, "master"))


@register("ag16_company_audit", with_ctes(["ledger", "master"], CTE_COMPANY) + """
SELECT tablon_file, audit_company AS source_company, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(efac_match_method) AS BIGINT) AS matched_rows,
  CAST(count(*) - count(efac_match_method) AS BIGINT) AS unmatched_rows,
  round(count(efac_match_method) / count(*), 6) AS match_rate,
  CASE audit_company WHEN 'URSA' THEN 'MAESTRO_COMPROBANTES_URSA.xlsx'
    WHEN '10_DE_ABRIL' THEN 'MAESTRO_COMPROBANTES_10_DE_ABRIL.xlsx' WHEN 'LYNX' THEN 'MAESTRO_COMPROBANTES_LYNX.xlsx'
    WHEN 'CYGNUS' THEN 'MAESTRO_COMPROBANTES_CYGNUS.xlsx' END AS expected_master
FROM by_company GROUP BY tablon_file, audit_company""")
def ag16_company_audit(spark, sf):
    """AG-16 (company-aware audit)."""
    enriched = lg.enrich_by_company(view(spark, sf, "ledger"), view(spark, sf, "master"), keep_company=True)
    return lg.company_audit(enriched)


@register("ag24_majority_company", with_ctes(["ledger"], []) + f"""
SELECT company, CAST(n AS BIGINT) AS rows FROM (
  SELECT {company_of('source_file')} AS company, count(*) AS n FROM ledger
  WHERE {company_of('source_file')} IS NOT NULL GROUP BY 1) q
ORDER BY n DESC, company LIMIT 1""")
def ag24_majority_company(spark, sf):
    """AG-24: most frequent company of the ledger's source files (one partial aggregate)."""
    return lg.majority_company(view(spark, sf, "ledger"))
