"""Dashboard data: facets, search, KPIs and mixes over the marts (JOB-18, AG-09..13).

Each KPI row is one global aggregate (partial aggregation on every task, a
single tiny final merge); summaries are one ``groupBy`` each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.numbers import money_text, number_text, to_number
from tejado.operators.aggregates import sum_zero
from tejado.operators.filters import facet_filter, search_rows


def filter_stock(df: DataFrame, projects=None, statuses=None, types=None, search: str | None = None) -> DataFrame:
    """FLT-11 + FLT-12: facets (``None`` = all values, null facets still drop, T-20), then search."""
    facets = {}
    for col, chosen in (("proyecto", projects), ("estado_comercial", statuses), ("tipo_de_unidad", types)):
        if col in df.columns:
            facets[col] = chosen
    return search_rows(facet_filter(df, facets), search) if search else facet_filter(df, facets)


def stock_kpis(stock: DataFrame) -> DataFrame:
    """AG-11: total units, available, sold, list value, available list value (one pass)."""
    price = to_number("precio_de_lista_actual")
    avail = F.col("estado_comercial") == "Disponible"
    return stock.agg(
        F.count(F.lit(1)).alias("total_unidades"),
        F.count_if(avail).alias("disponibles"),
        F.count_if(F.col("estado_comercial") == "Vendido").alias("vendidas"),
        F.round(sum_zero(price), 2).alias("valor_lista"),
        F.round(sum_zero(F.when(avail, price)), 2).alias("valor_disponible"))


def stock_kpi_text(kpis: DataFrame) -> DataFrame:
    """SC-35 over the KPI row: ``S/ 1,234`` money and ``1,234`` counts."""
    return kpis.select(number_text("total_unidades").alias("total_unidades"),
                       number_text("disponibles").alias("disponibles"), number_text("vendidas").alias("vendidas"),
                       money_text("valor_lista").alias("valor_lista"),
                       money_text("valor_disponible").alias("valor_disponible"))


def stock_summary(stock: DataFrame) -> DataFrame:
    """AG-09: per project × status, units (non-null code) and list value (all-null sums to 0)."""
    return (stock.groupBy("proyecto", "estado_comercial")
                 .agg(F.count("codigo").alias("unidades"),
                      F.round(sum_zero(to_number("precio_de_lista_actual")), 2).alias("valor_lista_actual")))


def status_mix(stock: DataFrame) -> DataFrame:
    """AG-13: units per status, null included."""
    return stock.groupBy("estado_comercial").agg(F.count(F.lit(1)).alias("unidades"))


def sales_kpis(sales: DataFrame) -> DataFrame:
    """AG-12: total sale, items, distinct projects, distinct buyers."""
    return sales.agg(F.round(sum_zero(to_number("precio_venta")), 2).alias("total_venta"),
                     F.count(F.lit(1)).alias("items"),
                     F.count_distinct("proyecto").alias("proyectos"),
                     F.count_distinct("dni_comprador").alias("compradores"))


def sales_summary(sales: DataFrame, sort: bool = False) -> DataFrame:
    """AG-10: per project, items (count of the project column: 0 for the null project, T-04),
    distinct buyers, total; by total descending."""
    out = (sales.groupBy("proyecto")
                .agg(F.count("proyecto").alias("items_vendidos"),
                     F.count_distinct("dni_comprador").alias("compradores"),
                     F.round(sum_zero(to_number("precio_venta")), 2).alias("precio_venta_total")))
    return out.orderBy(F.col("precio_venta_total").desc_nulls_last()) if sort else out


def type_mix(sales: DataFrame) -> DataFrame:
    """AG-13: items per unit type, null included."""
    return sales.groupBy("tipo_unidad").agg(F.count(F.lit(1)).alias("items"))
