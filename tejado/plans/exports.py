"""Split export by advisor (JOB-17) and anonymised samples (JOB-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tejado.operators.columns import find_column_loose
from tejado.sinks.writers import export_samples, split_by_group


def export_by_advisor(df: DataFrame, path: str, group_col: str = "asesor", default: str = "Sin Asesor") -> DataFrame:
    """JOB-17: PRJ-06 finds the advisor column by loose name, SNK-05 writes one folder per advisor
    (null/blank -> ``Sin Asesor``, SC-34 labels) and returns the manifest sorted by rows."""
    col = find_column_loose(df, group_col)
    return split_by_group(df, col, path, default=default)


def samples(tables: dict[str, tuple[DataFrame, list[str]]], path: str, n: int = 20) -> list[dict]:
    """JOB-14: first ``n`` rows of each table in key order, sensitive columns anonymised, as CSV."""
    return export_samples(tables, path, n)
