"""Sales by project and unit, with configurable columns (JOB-06).

Reservations are left-joined to sales, so pending reservations stay in with
"Separación sin minuta". Columns are chosen by name (PRJ-08) after optional
calculated columns (PRJ-15/16).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.keys import doc_key
from tejado.functions.numbers import to_number
from tejado.functions.rules import operation_status, unit_number, unit_type_sales
from tejado.operators.arrays import ADD_RESERVATION, ADD_SALE, explode_items
from tejado.operators.columns import CalculatedColumns, ensure_columns, select_columns
from tejado.operators.dedup import keep_first, order_of
from tejado.operators.filters import project_filter
from tejado.operators.joins import left_join_nonnull
from tejado.plans.stock import COOWNERS, process_facts, silver_clients, silver_projects

# Default exported columns, and the optional ones a user may add by name.
DEFAULT_COLUMNS = ["proyecto", "tipo_unidad", "num_unidad", "comprador", "dni_comprador", "copropietario_1",
                   "dni_coprop_1", "copropietario_2", "dni_coprop_2", "copropietario_3", "dni_coprop_3",
                   "precio_lista_al_comprar", "precio_venta"]
OPTIONAL_COLUMNS = ["codigo_proforma", "codigo_item", "codigo_proyecto", "fecha_separacion", "fecha_minuta",
                    "tipo_financiamiento", "origen_item", "precio_base_proforma", "precio_venta_miles",
                    "flag_tiene_coprop", "total_coprops"]
# Display headers of the sales catalogue.
HEADERS = {
    "proyecto": "Proyecto", "tipo_unidad": "Tipo Unidad", "num_unidad": "N° Unidad", "comprador": "Comprador",
    "dni_comprador": "DNI Comprador", "copropietario_1": "Copropietario 1", "dni_coprop_1": "DNI Coprop. 1",
    "copropietario_2": "Copropietario 2", "dni_coprop_2": "DNI Coprop. 2", "copropietario_3": "Copropietario 3",
    "dni_coprop_3": "DNI Coprop. 3", "precio_lista_al_comprar": "Precio Lista al Comprar",
    "precio_venta": "Precio Venta", "codigo_proforma": "Código Proforma", "codigo_item": "Código Item",
    "codigo_proyecto": "Código Proyecto", "fecha_separacion": "Fecha Separación", "fecha_minuta": "Fecha Minuta",
    "tipo_financiamiento": "Tipo Financiamiento", "origen_item": "Origen Item",
    "precio_base_proforma": "Precio Base Proforma", "precio_venta_miles": "Precio Venta Miles",
    "flag_tiene_coprop": "Tiene Coprop.", "total_coprops": "Total Coprops",
}


def units(unidades: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    unidades, order_col = order_of(unidades, order_col)
    u = ensure_columns(unidades, ["codigo", "nombre", "tipo_unidad", "precio_venta", "precio_base_proforma"])
    out = u.select(F.col("codigo").cast("string").alias("codigo_item"),
                   F.col("nombre").cast("string").alias("item_nombre"),
                   F.col("tipo_unidad").cast("string").alias("tipo_unidad_raw"),
                   to_number("precio_base_proforma").alias("precio_base_proforma"),
                   to_number("precio_base_proforma").alias("precio_lista_al_comprar"),
                   to_number("precio_venta").alias("precio_venta"),
                   unit_type_sales("tipo_unidad").alias("tipo_unidad"),
                   F.col(order_col).alias("__ord"))
    return keep_first(out, ["codigo_item"], "__ord").drop("__ord")


# Alias patterns per co-owner slot ``{i}``, first existing column wins.
COOWNER_NAME_PATTERNS = ["copropietario_{i}", "copropietario{i}", "coprop_{i}", "copropietario_{i}_nombre",
                         "nombre_copropietario_{i}", "cotitular_{i}", "cotitular{i}"]
COOWNER_DOC_PATTERNS = ["dni_coprop_{i}", "dni_copropietario_{i}", "documento_copropietario_{i}", "doc_coprop_{i}",
                        "dni_cotitular_{i}", "documento_cotitular_{i}"]


def coowners_from_columns(procesos: DataFrame, order_col: str = "id_proceso", slots: int = 3) -> DataFrame:
    """AR-03 + AG-08: co-owners already spread over columns; per slot the first existing alias
    (PRJ-05), documents normalised (SC-05), then first non-null per slot and proforma."""
    from tejado.operators.aggregates import first_non_null
    from tejado.operators.columns import pick_first_existing
    procesos, order_col = order_of(procesos, order_col)
    p = ensure_columns(procesos, ["codigo_proforma"])
    cols = [F.col("codigo_proforma").cast("string").alias("codigo_proforma"),
            F.col(order_col).alias("__ord")]
    for i in range(1, slots + 1):
        name = pick_first_existing(p, [t.format(i=i) for t in COOWNER_NAME_PATTERNS])
        doc = pick_first_existing(p, [t.format(i=i) for t in COOWNER_DOC_PATTERNS])
        cols.append((F.col(name).cast("string") if name else F.lit(None).cast("string")).alias(f"copropietario_{i}"))
        cols.append((doc_key(F.col(doc)) if doc else F.lit(None).cast("string")).alias(f"dni_coprop_{i}"))
    rows = p.select(*cols)
    names = [f"{k}_{i}" for i in range(1, slots + 1) for k in ("copropietario", "dni_coprop")]
    return rows.groupBy("codigo_proforma").agg(*[first_non_null(n, "__ord").alias(n) for n in names])


def sales_base(sources: dict[str, DataFrame], projects=None) -> DataFrame:
    """Every (proforma, item) of active reservations, sold or pending, with unit, client and co-owners."""
    base = process_facts(sources["procesos"], sources["clientes"]).where("con_separacion")
    base = base.withColumn("estado_operacion", operation_status(F.col("fecha_minuta")))
    common = ["documento_cliente", "codigo_proyecto", "fecha_separacion", "fecha_minuta", "tipo_financiamiento",
              "estado_operacion", *COOWNERS]
    codes = explode_items(base, "codigo_principal",
                          [("adicionales_sep_raw", ADD_RESERVATION), ("adicionales_ven_raw", ADD_SALE)], common)
    df = codes.join(units(sources["unidades"]), on="codigo_item", how="left")
    df = df.join(silver_projects(sources["proyectos"]), on="codigo_proyecto", how="left")
    df = left_join_nonnull(df, silver_clients(sources["clientes"]), "documento_cliente", ["codigo_proforma", "codigo_item"], blank_matches=True)
    df = project_filter(df, "proyecto_norm", projects)
    return df.select(
        "*", unit_number(F.col("item_nombre"), F.col("codigo_item"), F.col("tipo_unidad_raw")).alias("num_unidad"),
        F.coalesce(F.col("dni_comprador"), doc_key("documento_cliente")).alias("__dni"),
    ).drop("dni_comprador").withColumnRenamed("__dni", "dni_comprador")


def sales(sources: dict[str, DataFrame], projects=None, columns: list[str] | None = None,
          extra: list[str] | None = None, registry: CalculatedColumns | None = None, sort: bool = False) -> DataFrame:
    """JOB-06: the sales catalogue with the requested columns."""
    df = sales_base(sources, projects)
    if sort:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in ["proyecto", "tipo_unidad", "num_unidad"]])
    reg = registry or CalculatedColumns()
    df = reg.apply(df, [c for c in (extra or []) if c in reg.available() or c not in df.columns])
    return select_columns(df, columns or DEFAULT_COLUMNS, extra)
