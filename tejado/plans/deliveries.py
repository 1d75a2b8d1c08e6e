"""Delivery-list completion (JOB-12): owners' contacts, delivery ⋈ owners, delivery ⋈ reservations.

Every lookup side is reduced to one row per key first,
so the left joins never multiply delivery rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.contacts import clean_emails, is_email_strict, phone_key
from tejado.functions.keys import doc_key_strict, unit_code_from_type
from tejado.operators.dedup import keep_first
from tejado.operators.filters import declarative_filter
from tejado.operators.joins import left_join_m1, unmatched

OWNER_CONTACT = ["documento", "celulares", "email", "telefono", "nombres", "apellidos"]


def owners(clientes: DataFrame, fix_emails: bool = True, order_col: str = "orden_fila") -> DataFrame:
    """FLT-17 + SC-19/20 (+ SC-22/23): owners with cleaned phone, its length and validity (and e-mail)."""
    df = clientes.where(F.col("estado") == "Propietario").select(*OWNER_CONTACT, order_col)
    cel = phone_key("celulares", drop_51=True, drop_0051=True, empty_as_null=True)
    df = df.withColumn("celular_clean", F.when(F.col("celulares").isNotNull(), cel))
    df = df.withColumn("celular_len", F.length("celular_clean"))
    df = df.withColumn("celular_ok", F.coalesce((F.col("celular_len") == 9) & F.col("celular_clean").startswith("9"),
                                                F.lit(False)))
    if fix_emails:
        df = clean_emails(df, "email", "email_clean").withColumn("email_ok", is_email_strict(F.col("email_clean")))
    return df


def owner_lookup(own: DataFrame, cols: list[str], order_col: str = "orden_fila") -> DataFrame:
    """Owners keyed by the strict 8-digit document, first row per key."""
    df = own.withColumn("documento_key", doc_key_strict("documento", require_len=8)).where(
        F.col("documento_key").isNotNull())
    return keep_first(df, ["documento_key"], order_col).select("documento_key", *cols)


def deliveries_with_owners(entregas: DataFrame, own: DataFrame, cols: list[str]) -> DataFrame:
    """JN-12: delivery ⟕ owners on the strict document key with a ``_merge`` indicator."""
    e = entregas.withColumn("dni_key", doc_key_strict("dni", require_len=8))
    return left_join_m1(e, owner_lookup(own, cols), "dni_key", "documento_key", "_merge")


def reservations_for(procesos: DataFrame, project: str, stage: str = "Separacion", active: str = "Activo",
                     order_col: str = "id_proceso") -> DataFrame:
    """Active reservations of one project (case/accent-insensitive match on the names)."""
    cond = {"nombre_proyecto": {"op": "igual_ci", "valor": project}, "estado": {"op": "igual_ci", "valor": active},
            "nombre": {"op": "igual_ci", "valor": stage}}
    cols = ["nombre_proyecto", "tipo_unidad_principal", "codigo_unidad", "documento_cliente", "nombres_usuario"]
    return declarative_filter(procesos, cond).select(*cols, order_col)


def deliveries_with_reservations(delivered: DataFrame, seps: DataFrame, order_col: str = "id_proceso") -> DataFrame:
    """JN-12 second step: ⟕ reservations by the strict document of the client."""
    s = seps.withColumn("documento_key_sep", doc_key_strict("documento_cliente", require_len=8)).where(
        F.col("documento_key_sep").isNotNull())
    s = keep_first(s, ["documento_key_sep"], order_col).select(
        "documento_key_sep", F.col("documento_cliente"), "nombres_usuario", "codigo_unidad")
    return left_join_m1(delivered, s, "dni_key", "documento_key_sep", "merge_propietarios")


def pending_by_unit(entregas_proceso: DataFrame, seps: DataFrame, order_col: str = "id_proceso") -> DataFrame:
    """JN-15: second list keyed by the digits of the built unit code (SC-14) ⟕ reservations by the same key."""
    p = entregas_proceso.withColumn("codigo_unidad_entrega", unit_code_from_type(F.col("tipo"), F.col("numero_unidad")))
    p = p.withColumn("unidad_key", doc_key_strict("codigo_unidad_entrega"))
    s = seps.withColumn("unidad_key_sep", doc_key_strict("codigo_unidad")).where(F.col("unidad_key_sep").isNotNull())
    s = keep_first(s, ["unidad_key_sep"], order_col).select("unidad_key_sep", "nombres_usuario", "documento_cliente")
    return left_join_m1(p, s, "unidad_key", "unidad_key_sep", "_merge")


def unmatched_deliveries(entregas: DataFrame, own: DataFrame) -> DataFrame:
    """JN-13: deliveries without an owner."""
    e = entregas.withColumn("dni_key", doc_key_strict("dni", require_len=8))
    return unmatched(e, owner_lookup(own, []), "dni_key", "documento_key")


def unit_prefix_codes(entregas_proceso: DataFrame) -> DataFrame:
    """SC-14 alone."""
    return entregas_proceso.select("tipo", "numero_unidad",
                                   unit_code_from_type(F.col("tipo"), F.col("numero_unidad")).alias("codigo_unidad"))

