"""Lead contactability audit (JOB-10) and exclusion list (JOB-11).

Both are row-wise validation plus small aggregates: one narrow pass for the
detail tables, one aggregate pass for each summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.contacts import clean_text, digits, exclusion_email, is_email, is_mobile, phone_key
from tejado.functions.dates import as_timestamp
from tejado.functions.rules import contact_state, exclusion_reason
from tejado.functions.text import ustrip
from tejado.operators.columns import ensure_columns, require_columns
from tejado.operators.dedup import keep_last, order_of
from tejado.operators.filters import date_window


def lead_scope(leads: DataFrame, project: str, start: str, end: str, inclusive_end_day: bool = False) -> DataFrame:
    """FLT-13: upper-trimmed project equals ``project``; date between start and end (midnight, T-15)."""
    require_columns(leads, ["proyecto", "fecha_registro", "correo", "telefono"])
    df = leads.withColumn("fecha_registro", as_timestamp(leads, "fecha_registro"))
    proj = ustrip(F.upper(F.coalesce(F.col("proyecto").cast("string"), F.lit("NAN"))))
    return date_window(df.where(proj == project.upper()), "fecha_registro", start, end, inclusive_end_day)


def lead_audit_detail(leads: DataFrame, project: str, start: str, end: str) -> DataFrame:
    """JOB-10 detail: cleaned contacts, validity flags (SC-19..21) and contact state (SC-26)."""
    df = lead_scope(leads, project, start, end)
    return df.select(
        "*",
        clean_text("correo").alias("correo_limpio"),
        F.coalesce(digits("telefono"), F.lit("")).alias("telefono_limpio"),
        is_email("correo").alias("tiene_correo"),
        is_mobile(F.coalesce(F.col("telefono"), F.lit(""))).alias("tiene_telefono"),
    ).withColumn("estado_contactabilidad", contact_state(F.col("tiene_correo"), F.col("tiene_telefono")))


def missing_contacts(detail: DataFrame) -> DataFrame:
    """FLT-14: not (valid e-mail and valid phone)."""
    return detail.where(~(F.col("tiene_correo") & F.col("tiene_telefono")))


def lead_summary(detail: DataFrame, project: str, start: str, end: str) -> DataFrame:
    """AG-17: eight labelled indicators in long form; numeric ones with % of the total (0 when empty)."""
    e, p = F.col("tiene_correo"), F.col("tiene_telefono")
    one = detail.agg(F.count(F.lit(1)).alias("total"), F.count_if(e).alias("correo"), F.count_if(p).alias("tel"),
                     F.count_if(e & p).alias("ambos"), F.count_if(~(e & p)).alias("faltan"))

    def row(i, label, value, numeric):
        pct = (F.when(F.col("total") > 0, F.round(value.cast("double") / F.col("total"), 6)).otherwise(F.lit(0.0))
               if numeric else F.lit(None).cast("double"))
        return F.struct(F.lit(i).alias("orden"), F.lit(label).alias("indicador"), value.cast("string").alias("valor"),
                        pct.alias("porcentaje_sobre_total"))

    rows = [row(1, "Proyecto auditado", F.lit(project), False), row(2, "Periodo inicio", F.lit(start), False),
            row(3, "Periodo fin", F.lit(end), False), row(4, "Total leads revisados", F.col("total"), True),
            row(5, "Leads con correo válido", F.col("correo"), True),
            row(6, "Leads con teléfono válido", F.col("tel"), True),
            row(7, "Leads con correo y teléfono", F.col("ambos"), True),
            row(8, "Leads con faltante de correo o teléfono", F.col("faltan"), True)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def state_counts(detail: DataFrame) -> DataFrame:
    """AG-18: rows per contact state."""
    return detail.groupBy("estado_contactabilidad").agg(F.count(F.lit(1)).alias("cantidad"))


EXCLUSION_COLS = ["nombre", "documento_exclusion", "correo_exclusion", "telefono_exclusion", "proyecto",
                  "fecha_registro", "motivo_exclusion", "estado_lead", "observacion"]


def exclusion_list(leads: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    """JOB-11: contacts with an exclusion reason (SC-24), keys cleaned (SC-25), last row per
    (document, e-mail, phone) in file order (WD-04; blanks are values)."""
    leads, order_col = order_of(leads, order_col)
    df = ensure_columns(leads, ["nombre", "documento", "correo", "telefono", "proyecto", "estado_lead", "observacion",
                                "fecha_registro"], default="")
    df = df.select(
        "*",
        phone_key("telefono").alias("telefono_exclusion"),
        exclusion_email("correo").alias("correo_exclusion"),
        clean_text("documento").alias("documento_exclusion"),
        exclusion_reason(F.col("estado_lead"), F.col("observacion")).alias("motivo_exclusion"),
    ).where(F.col("motivo_exclusion").isNotNull())
    last = keep_last(df, ["documento_exclusion", "correo_exclusion", "telefono_exclusion"], order_col)
    return last.select(*EXCLUSION_COLS)


def reason_counts(excl: DataFrame) -> DataFrame:
    """AG-19: exclusions per reason."""
    return excl.groupBy("motivo_exclusion").agg(F.count(F.lit(1)).alias("cantidad"))


def project_reason_counts(excl: DataFrame) -> DataFrame:
    """AG-19: exclusions per project × reason."""
    return excl.groupBy("proyecto", "motivo_exclusion").agg(F.count(F.lit(1)).alias("cantidad"))
