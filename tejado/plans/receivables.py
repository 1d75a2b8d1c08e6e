"""Receivables by client and project, with its item audit table (JOB-05).

The reference builds seven group-bys and re-merges six of them; here it is one
``groupBy(project, project code, client).agg(...)`` with conditional aggregates
(JN-07, AG-06, AG-07): one shuffle, partial aggregation on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.dates import as_timestamp
from tejado.functions.keys import doc_key
from tejado.functions.numbers import to_number
from tejado.functions.rules import receivable_category
from tejado.functions.text import norm_text, ustrip
from tejado.operators.aggregates import join_unique, sum_zero
from tejado.operators.arrays import ADD_RESERVATION, ADD_SALE, explode_items
from tejado.operators.columns import ensure_columns
from tejado.operators.dedup import keep_first, order_of
from tejado.operators.filters import project_filter, stage_filter
from tejado.operators.joins import left_join_nonnull
from tejado.plans.stock import silver_projects, silver_sales

# Receivables keep these item categories.
KEPT_CATEGORIES = ["DEPA", "ESTAC", "DEPO"]
# Output column order of the receivables list (20).
RECEIVABLES_COLS = ["proyecto", "codigo_proyecto", "documento_cliente", "documento_cliente_norm", "cliente",
                    "medio_captacion", "celulares", "email", "asesor", "codigo_proformas", "tipos_financiamiento",
                    "departamentos", "estacionamientos", "depositos", "total_departamentos", "total_estacionamientos",
                    "total_depositos", "total_venta_items", "primera_separacion", "ultima_minuta"]


def reservations(procesos: DataFrame, order_col: str = "id_proceso") -> DataFrame:
    """FLT-07: active reservations (no de-duplication by proforma, T-18); advisor falls back
    from the reservation user to the user, then the advisor column."""
    procesos, order_col = order_of(procesos, order_col)
    p = ensure_columns(procesos, ["fecha_inicio", "codigo_proforma", "documento_cliente", "codigo_unidad",
                                  "codigo_proyecto", "usuario_separacion", "usuario", "asesor", "estado",
                                  "tipo_financiamiento", "codigo_unidades_asignadas", "nombre"])
    sep = stage_filter(p, "SEPARACION", status_col="estado", status="ACTIVO")
    return sep.select(
        as_timestamp(p, "fecha_inicio").alias("fecha_separacion"),
        F.col("codigo_proforma").cast("string").alias("codigo_proforma"),
        F.col("documento_cliente").cast("string").alias("documento_cliente"),
        F.col("codigo_unidad").cast("string").alias("codigo_principal"),
        F.col("codigo_proyecto").cast("string").alias("codigo_proyecto"),
        F.coalesce("usuario_separacion", "usuario", "asesor").cast("string").alias("usuario_separacion"),
        F.col("estado").cast("string").alias("estado"),
        F.col("tipo_financiamiento").cast("string").alias("tipo_financiamiento"),
        F.col("codigo_unidades_asignadas").cast("string").alias("adicionales_sep_raw"),
        F.col(order_col).alias("__ord"))


def clients(clientes: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    clientes, order_col = order_of(clientes, order_col)
    c = ensure_columns(clientes, ["documento", "nombres", "apellidos", "cliente", "medio_captacion", "celulares",
                                  "email"])
    full = ustrip(F.concat(F.coalesce("nombres", F.lit("")), F.lit(" "), F.coalesce("apellidos", F.lit(""))))
    out = c.select(F.col("documento").cast("string").alias("documento_cliente"),
                   doc_key("documento").alias("documento_cliente_norm"),
                   F.coalesce(F.col("cliente").cast("string"), full).alias("cliente"),
                   F.col("medio_captacion").cast("string").alias("medio_captacion"),
                   F.col("celulares").cast("string").alias("celulares"),
                   F.col("email").cast("string").alias("email"),
                   F.col(order_col).alias("__ord"))
    return keep_first(out, ["documento_cliente"], "__ord").drop("__ord")


def units(unidades: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    unidades, order_col = order_of(unidades, order_col)
    u = ensure_columns(unidades, ["codigo", "nombre", "tipo_unidad", "precio_venta"])
    out = u.select(F.col("codigo").cast("string").alias("codigo_item"),
                   F.col("nombre").cast("string").alias("item_nombre"),
                   F.col("tipo_unidad").cast("string").alias("tipo_unidad"),
                   to_number("precio_venta").alias("precio_venta"),
                   norm_text("tipo_unidad").alias("tipo_unidad_norm"),
                   F.col(order_col).alias("__ord"))
    return keep_first(out, ["codigo_item"], "__ord").drop("__ord")


def items(sources: dict[str, DataFrame]) -> DataFrame:
    """Item audit table: every reserved item with its unit, category and price (inner join, T-27)."""
    base = reservations(sources["procesos"]).join(silver_sales(sources["procesos"]), on="codigo_proforma", how="left")
    common = ["documento_cliente", "codigo_proyecto", "usuario_separacion", "fecha_separacion", "fecha_minuta",
              "tipo_financiamiento"]
    codes = explode_items(base, "codigo_principal",
                          [("adicionales_sep_raw", ADD_RESERVATION), ("adicionales_ven_raw", ADD_SALE)],
                          common, separators=",", order="__ord")
    out = codes.join(units(sources["unidades"]), on="codigo_item", how="inner")
    return out.withColumn("categoria", receivable_category(F.col("tipo_unidad_norm")))


def receivables(sources: dict[str, DataFrame], projects=None, items_df: DataFrame | None = None,
                sort: bool = False) -> DataFrame:
    """JOB-05: one row per (project, project code, client)."""
    it = items_df if items_df is not None else items(sources)
    df = it.join(silver_projects(sources["proyectos"]), on="codigo_proyecto", how="left")
    df = project_filter(df, "proyecto_norm", projects)
    df = df.where(F.col("categoria").isin(KEPT_CATEGORIES))
    df = left_join_nonnull(df, clients(sources["clientes"]), "documento_cliente", ["codigo_proforma", "codigo_item"], blank_matches=True)
    price = F.coalesce(F.col("precio_venta"), F.lit(0.0))

    def by_cat(cat):
        return F.when(F.col("categoria") == cat, F.col("item_nombre"))

    def total(cat):
        return F.round(sum_zero(F.when(F.col("categoria") == cat, price).otherwise(F.lit(0.0))), 2)

    keys = ["proyecto", "codigo_proyecto", "documento_cliente"]
    out = df.groupBy(*keys).agg(
        F.max("cliente").alias("cliente"), F.max("medio_captacion").alias("medio_captacion"),
        F.max("celulares").alias("celulares"), F.max("email").alias("email"),
        F.max("usuario_separacion").alias("asesor"),
        F.min("fecha_separacion").alias("primera_separacion"), F.max("fecha_minuta").alias("ultima_minuta"),
        join_unique("codigo_proforma").alias("codigo_proformas"),
        join_unique("tipo_financiamiento").alias("tipos_financiamiento"),
        join_unique(by_cat("DEPA")).alias("departamentos"),
        join_unique(by_cat("ESTAC")).alias("estacionamientos"),
        join_unique(by_cat("DEPO")).alias("depositos"),
        total("DEPA").alias("total_departamentos"), total("ESTAC").alias("total_estacionamientos"),
        total("DEPO").alias("total_depositos"), F.round(sum_zero(price), 2).alias("total_venta_items"))
    out = out.withColumn("documento_cliente_norm", doc_key("documento_cliente")).select(*RECEIVABLES_COLS)
    return out.orderBy(*receivables_order()) if sort else out


def receivables_order() -> list:
    """SO-02: by project, the largest total first; equal totals by project code and client."""
    return [F.col("proyecto").asc_nulls_last(), F.col("total_venta_items").desc_nulls_last(),
            F.col("codigo_proyecto").asc_nulls_last(), F.col("documento_cliente").asc_nulls_last()]


def item_mix(items_df: DataFrame) -> DataFrame:
    """AG-13 on the audit table: rows per category, null included."""
    return items_df.groupBy("categoria").agg(F.count(F.lit(1)).alias("cantidad"))
