"""Filters and predicates (FLT-01..18).

A declarative condition dict folds into one ``Column`` and one ``filter``, so
Catalyst pushes the plain comparisons into the parquet scan. Literals for the
case/accent-insensitive operators are folded on the driver once.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.functions.text import fold_text, is_blank, norm_compare, norm_compare_literal, norm_text
from tejado.operators.columns import require_columns


def condition(df: DataFrame, column: str, cond: Any) -> Column:
    """One FLT-01 condition as a boolean Column.

    A null result drops the row inside ``filter`` just like false, so positive
    conditions stay bare: plain comparisons and ``IN`` lists then reach the
    Parquet scan as pushed filters. Negated ones carry their own null guard.
    """
    c = F.col(column)
    if isinstance(cond, Mapping):
        op = cond.get("op")
        if op == "vacio":
            out = is_blank(c)
        elif op == "no_vacio":
            out = ~is_blank(c)
        elif op == "igual":
            out = c == F.lit(cond.get("valor"))
        elif op == "distinto":
            out = ~c.eqNullSafe(F.lit(cond.get("valor")))  # null counts as distinct (T-10)
        elif op == "en":
            out = c.isin(list(cond.get("valores", [])))
        elif op == "no_en":
            out = ~F.coalesce(c.isin(list(cond.get("valores", []))), F.lit(False))
        elif op == "igual_ci":
            out = norm_compare(c) == norm_compare_literal(cond.get("valor", ""))
        elif op == "en_ci":
            out = norm_compare(c).isin(sorted({norm_compare_literal(v) for v in cond.get("valores", [])}))
        elif op == "contiene_ci":
            out = norm_compare(c).contains(norm_compare_literal(cond.get("valor", "")))
        else:
            raise ValueError(f"unknown operator for {column!r}: {op!r}")
    elif isinstance(cond, (list, tuple, set, frozenset)):
        out = c.isin(list(cond))
    else:
        out = c == F.lit(cond)
    return out


def build_predicate(df: DataFrame, conditions: Mapping[str, Any]) -> Column:
    """FLT-01..05: all conditions ANDed; unknown columns raise."""
    require_columns(df, conditions.keys())
    pred = F.lit(True)
    for column, cond in conditions.items():
        pred = pred & condition(df, column, cond)
    return pred


def declarative_filter(df: DataFrame, conditions: Mapping[str, Any]) -> DataFrame:
    """FLT-01: one ``filter`` from a condition dict."""
    return df.filter(build_predicate(df, conditions))


def observed_filter(df: DataFrame, conditions: Mapping[str, Any], name: str = "filtro"):
    """FLT-06: filter plus an ``Observation`` with rows before/after, filled by the first action.

    No extra pass over the data: the counts ride along the same job.
    """
    pred = build_predicate(df, conditions)
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("antes"), F.count_if(pred).alias("despues"))
    return observed.filter(pred), obs


def filter_report(df: DataFrame, conditions: Mapping[str, Any], name: str = "filtro") -> DataFrame:
    """FLT-06 as a one-row table: before, after, dropped, % kept."""
    pred = build_predicate(df, conditions)
    agg = df.agg(F.count(F.lit(1)).alias("antes"), F.count_if(pred).alias("despues"))
    return agg.select(
        F.lit(name).alias("filtro"), "antes", "despues",
        (F.col("antes") - F.col("despues")).alias("descartadas"),
        F.when(F.col("antes") > 0, F.round(F.col("despues") * 100.0 / F.col("antes"), 2))
         .otherwise(F.lit(0.0)).alias("pct_conservado"))


def stage_filter(df: DataFrame, stage: str, stage_col: str = "nombre", key_col: str = "codigo_proforma",
                 status_col: str | None = None, status: str | None = None) -> DataFrame:
    """FLT-07 / FLT-09: normalised stage name equals ``stage``, key not null, optional status."""
    pred = (norm_text(F.col(stage_col)) == stage) & F.col(key_col).isNotNull()
    if status_col:
        pred = pred & (norm_text(F.col(status_col)) == status)
    return df.filter(pred)


def active_if_any(df: DataFrame, status_col: str = "estado", active: str = "ACTIVO") -> DataFrame:
    """FLT-08: keep active rows if any row is active, else keep all (a global condition, T-16).

    The "any active" flag is a scalar subquery over a partial aggregate: one
    value computed once, no join and no ``collect`` on the driver.
    """
    is_active = F.coalesce(norm_text(F.col(status_col)) == active, F.lit(False))
    any_active = df.agg(F.max(is_active.cast("int"))).scalar()
    return df.filter((F.coalesce(any_active, F.lit(0)) == 0) | is_active)


def normalize_project_list(projects) -> list[str] | None:
    """FLT-10: normalised project names; None, empty or all-blank -> no filter."""
    if projects is None:
        return None
    if isinstance(projects, str):
        projects = [projects]
    out = [fold_text(p) for p in projects if p is not None]
    return sorted(set(filter(None, out))) or None


def project_filter(df: DataFrame, norm_col: str, projects) -> DataFrame:
    """FLT-10: keep rows whose normalised project is in the list; no list -> no filter."""
    norms = normalize_project_list(projects)
    return df if norms is None else df.filter(F.col(norm_col).isin(norms))


def facet_filter(df: DataFrame, facets: Mapping[str, Any], keep_null: bool = False) -> DataFrame:
    """FLT-11: keep the selected values per facet. A facet set to ``None`` means "all", but rows
    with a null facet still drop (T-20) unless ``keep_null``."""
    pred = F.lit(True)
    for column, values in facets.items():
        c = F.col(column)
        if values is None:
            cond = c.isNotNull() if not keep_null else F.lit(True)
        else:
            cond = F.coalesce(c.isin(list(values)), F.lit(False))
            if keep_null:
                cond = cond | c.isNull()
        pred = pred & cond
    return df.filter(pred)


def shown_text(field: T.StructField) -> Column:
    """A value as text, in one form whatever the engine: numbers in decimal notation with one to six places (whole types
    without), never with an exponent; booleans as true and false; dates and times in ISO order; other types as Spark casts them."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.regexp_replace(c.cast("decimal(38,6)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    return c.cast("string")


def search_rows(df: DataFrame, term: str, cols: list[str] | None = None) -> DataFrame:
    """FLT-12: case-insensitive literal search over the text of every column of the row (nulls skipped, T-25)."""
    if not term or not str(term).strip():
        return df
    text = F.lower(F.concat_ws(" ", *[shown_text(df.schema[c]) for c in (cols or df.columns)]))
    return df.filter(text.contains(str(term).strip().lower()))


def date_window(df: DataFrame, col: str, start: str, end: str, inclusive_end_day: bool = False) -> DataFrame:
    """FLT-13 date part: ``start <= col <= end``; ``end`` is midnight unless ``inclusive_end_day`` (T-15)."""
    lo = F.to_timestamp_ntz(F.lit(start))
    hi = F.to_timestamp_ntz(F.lit(end))
    if inclusive_end_day:
        return df.filter((F.col(col) >= lo) & (F.col(col) < F.date_add(hi.cast("date"), 1).cast("timestamp_ntz")))
    return df.filter((F.col(col) >= lo) & (F.col(col) <= hi))

