"""Mart quality report (JOB-15, AG-25, SC-36, SE-04, SO-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.numbers import inconsistent_amount, to_number
from tejado.operators.setops import head, schema_diff
from tejado.plans.stock import STOCK_COLS

MONEY_COLS = ["precio_lista_al_comprar", "precio_venta", "precio_de_lista_actual", "descuento_actual",
              "monto_actual_dscto"]


def column_report(stock: DataFrame, expected=None) -> DataFrame:
    """AG-25: per expected column: nulls; for money columns also non-null count and sum. One pass."""
    expected = expected or STOCK_COLS
    present = [c for c in expected if c in stock.columns]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(present):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n{i}"))
        if c in MONEY_COLS:
            x = to_number(F.col(c))
            aggs += [F.count(x).alias(f"v{i}"), F.round(F.coalesce(F.sum(x), F.lit(0.0)), 2).alias(f"s{i}")]
        else:
            aggs += [F.lit(None).cast("long").alias(f"v{i}"), F.lit(None).cast("double").alias(f"s{i}")]
    one = stock.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("columna"), F.col(f"n{i}").alias("nulos"), F.col(f"v{i}").alias("no_nulos_num"),
                       F.col(f"s{i}").alias("suma")) for i, c in enumerate(present)]
    return one.select(F.col("__rows").alias("filas"), F.explode(F.array(*structs)).alias("s")).select("filas", "s.*")


def summary(stock: DataFrame, expected=None) -> DataFrame:
    """One row: rows, columns, missing/extra column lists (SE-04), inconsistent discount amounts (SC-36)."""
    expected = expected or STOCK_COLS
    missing, extra = schema_diff(stock, expected)
    bad = inconsistent_amount(to_number("monto_actual_dscto"), to_number("precio_de_lista_actual"),
                              to_number("descuento_actual"))
    return stock.agg(F.count(F.lit(1)).alias("filas"), F.count_if(bad).alias("montos_inconsistentes")).select(
        "filas", F.lit(len(stock.columns)).alias("columnas"), F.lit(", ".join(missing)).alias("faltantes"),
        F.lit(", ".join(extra)).alias("extra"), "montos_inconsistentes")


def available_sample(stock: DataFrame, n: int = 5, order_by=("proyecto", "tipo_de_unidad", "nombre", "codigo")) -> DataFrame:
    """SO-03: the first ``n`` available units in a stated order (a top-k, not a scan cap)."""
    return head(stock.where(F.col("estado_comercial") == "Disponible"), n, list(order_by))
