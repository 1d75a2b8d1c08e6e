"""Lead audit (JOB-10) and exclusion list (JOB-11) queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.catalog import register
from tejado.catalog.sqlfn import ustrip, with_ctes
from tejado.functions.rules import EXCLUSION_RULES
from tejado.plans import leads as ld
from tejado.plans.adapters import view
from tejado.session import scratch_path
from tejado.sources.readers import read_csv

# the audited month of the lead feed (all of it lies in January 2024)
PROJECT, START, END = "purchase", "2024-01-01", "2024-01-30"


def _digits(x):
    return f"coalesce(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


def _phone(x):
    d = _digits(x)
    return f"(CASE WHEN starts_with({d}, '51') AND length({d}) = 11 THEN substr({d}, 3) ELSE {d} END)"


def _upper_fixed(x):
    return f"translate(upper({ustrip(f'coalesce({x}, {chr(39)}{chr(39)})')}), 'ÁÉÍÓÚÜ', 'AEIOUU')"


_TEXT = f"({_upper_fixed('estado_lead')} || ' ' || {_upper_fixed('observacion')})"
REASON = "(CASE " + " ".join(
    f"WHEN {' OR '.join(f'contains({_TEXT}, {chr(39)}{p}{chr(39)})' for p in phrases)} THEN '{reason}'"
    for reason, phrases in EXCLUSION_RULES) + " END)"

_CORREO = ustrip("coalesce(correo, '')")
_EMAIL_OK = f"coalesce(regexp_matches(lower({_CORREO}), '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false)"
_PHONE_OK = f"regexp_matches({_phone('telefono')}, '^9[0-9]{{8}}$')"
LDET = f"""
SELECT *, coalesce({ustrip('correo')}, '') AS correo_limpio, {_digits('telefono')} AS telefono_limpio,
  {_EMAIL_OK} AS tiene_correo, {_PHONE_OK} AS tiene_telefono
FROM leads
WHERE {ustrip("upper(coalesce(proyecto, 'NAN'))")} = '{PROJECT.upper()}'
  AND fecha_registro >= TIMESTAMP '{START}' AND fecha_registro <= TIMESTAMP '{END}'"""
LDET2 = """
SELECT *, CASE WHEN tiene_correo AND tiene_telefono THEN 'OK: correo y teléfono'
  WHEN NOT tiene_correo AND tiene_telefono THEN 'Falta correo' WHEN tiene_correo AND NOT tiene_telefono THEN 'Falta teléfono'
  ELSE 'Falta correo y teléfono' END AS estado_contactabilidad FROM ldet"""
CTE_LEADS = [("ldet", LDET), ("ldet2", LDET2)]


def _detail(spark, sf):
    return ld.lead_audit_detail(view(spark, sf, "leads"), PROJECT, START, END)


@register("job10_lead_audit", with_ctes(["leads"], CTE_LEADS) + "SELECT * FROM ldet2")
def job10_lead_audit(spark, sf):
    """JOB-10 detail: FLT-13 scope, SC-19/20/21 checks, SC-26 state."""
    return _detail(spark, sf)


@register("flt14_missing_contacts", with_ctes(["leads"], CTE_LEADS)
          + "SELECT * FROM ldet2 WHERE NOT (tiene_correo AND tiene_telefono)")
def flt14_missing(spark, sf):
    return ld.missing_contacts(_detail(spark, sf))


_PCT = "CASE WHEN t.total > 0 THEN round({v} / t.total, 6) ELSE 0.0 END"
AG17 = f"""
SELECT * FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE tiene_correo) AS correo, count(*) FILTER (WHERE tiene_telefono) AS tel,
    count(*) FILTER (WHERE tiene_correo AND tiene_telefono) AS ambos,
    count(*) FILTER (WHERE NOT (tiene_correo AND tiene_telefono)) AS faltan FROM ldet2) t,
LATERAL (VALUES
  (1, 'Proyecto auditado', '{PROJECT}', NULL::DOUBLE), (2, 'Periodo inicio', '{START}', NULL::DOUBLE),
  (3, 'Periodo fin', '{END}', NULL::DOUBLE),
  (4, 'Total leads revisados', CAST(t.total AS VARCHAR), {_PCT.format(v='t.total')}),
  (5, 'Leads con correo válido', CAST(t.correo AS VARCHAR), {_PCT.format(v='t.correo')}),
  (6, 'Leads con teléfono válido', CAST(t.tel AS VARCHAR), {_PCT.format(v='t.tel')}),
  (7, 'Leads con correo y teléfono', CAST(t.ambos AS VARCHAR), {_PCT.format(v='t.ambos')}),
  (8, 'Leads con faltante de correo o teléfono', CAST(t.faltan AS VARCHAR), {_PCT.format(v='t.faltan')})
) v(orden, indicador, valor, porcentaje_sobre_total)"""


@register("ag17_lead_summary", with_ctes(["leads"], CTE_LEADS)
          + f"SELECT orden, indicador, valor, porcentaje_sobre_total FROM ({AG17}) q")
def ag17_lead_summary(spark, sf):
    """AG-17: eight indicators in long form with % of total."""
    return ld.lead_summary(_detail(spark, sf), PROJECT, START, END)


@register("ag18_state_counts", with_ctes(["leads"], CTE_LEADS)
          + "SELECT estado_contactabilidad, count(*) AS cantidad FROM ldet2 GROUP BY 1")
def ag18_state_counts(spark, sf):
    return ld.state_counts(_detail(spark, sf))


EX0 = f"""
SELECT *, {_phone('telefono')} AS telefono_exclusion, lower({ustrip("coalesce(correo, '')")}) AS correo_exclusion,
  {ustrip("coalesce(documento, '')")} AS documento_exclusion, {REASON} AS motivo_exclusion FROM leads"""
EXCL = """
SELECT nombre, documento_exclusion, correo_exclusion, telefono_exclusion, proyecto, fecha_registro, motivo_exclusion,
  estado_lead, observacion FROM (
  SELECT *, row_number() OVER (PARTITION BY documento_exclusion, correo_exclusion, telefono_exclusion
                               ORDER BY orden_fila DESC) AS rn
  FROM ex0 WHERE motivo_exclusion IS NOT NULL) q WHERE rn = 1"""
CTE_EXCL = [("ex0", EX0), ("excl", EXCL)]


INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def ordered_csv(df, order, base):
    """The rows in ``order`` as CSV files, without that column: folders by range, so that path and file order is row order."""
    ranges = df.repartitionByRange(5, order).withColumn("tramo", F.spark_partition_id()).sortWithinPartitions("tramo", order)
    exact = {"timestampNTZFormat": INSTANT, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    ranges.drop(order).write.options(header=True, **exact).partitionBy("tramo").csv(base)


@register("job11_exclusion_list", with_ctes(["leads"], CTE_EXCL) + "SELECT * FROM excl")
def job11_exclusion(spark, sf):
    """JOB-11: SC-24 reason, SC-25 keys, WD-04 composite keep-last. The leads are CSV files in several folders without an
    order column, written in the view's order; "last" is the last in path and file order (WD-06)."""
    base = scratch_path(spark, "job11")
    leads = view(spark, sf, "leads")
    ordered_csv(leads, "orden_fila", base)
    plain = T.StructType([f for f in leads.schema if f.name != "orden_fila"])
    return ld.exclusion_list(read_csv(spark, f"{base}/*/*.csv", plain, timestampNTZFormat=INSTANT))


@register("ag19_reason_counts", with_ctes(["leads"], CTE_EXCL)
          + "SELECT motivo_exclusion, count(*) AS cantidad FROM excl GROUP BY 1")
def ag19_reasons(spark, sf):
    return ld.reason_counts(ld.exclusion_list(view(spark, sf, "leads")))


@register("ag19_project_reason_counts", with_ctes(["leads"], CTE_EXCL)
          + "SELECT proyecto, motivo_exclusion, count(*) AS cantidad FROM excl GROUP BY 1, 2")
def ag19_project_reasons(spark, sf):
    return ld.project_reason_counts(ld.exclusion_list(view(spark, sf, "leads")))
