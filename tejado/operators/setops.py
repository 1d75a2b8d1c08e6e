"""Unions, snapshot difference, schema difference, sorts and heads (SE-01..04, SO-01..03)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """SE-01: union of pieces with unequal columns (missing ones become null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def snapshot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()


def snapshot_diff(current: DataFrame, previous: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """SE-02: (new, removed) keys, compared as text and de-duplicated (two anti joins)."""
    cur, prev = snapshot_keys(current, keys), snapshot_keys(previous, keys)
    return cur.join(prev, on=keys, how="left_anti"), prev.join(cur, on=keys, how="left_anti")


def snapshot_counts(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """AG-26: current, previous, new and removed key counts in one row.

    A full outer join of the two distinct key sets, counted in one pass.
    """
    cur = snapshot_keys(current, keys).withColumn("__c", F.lit(1))
    prev = snapshot_keys(previous, keys).withColumn("__p", F.lit(1))
    both = cur.join(prev, on=[cur[k].eqNullSafe(prev[k]) for k in keys], how="full")
    return both.agg(F.count("__c").alias("actuales"), F.count("__p").alias("anteriores"),
                    F.count_if(F.col("__p").isNull()).alias("nuevos"),
                    F.count_if(F.col("__c").isNull()).alias("eliminados"))


def schema_diff(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """SE-04: (missing, extra) column names."""
    have = set(df.columns)
    return [c for c in expected if c not in have], [c for c in df.columns if c not in set(expected)]


def head(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """SO-03: first ``n`` rows in a stated order (a top-k; Spark plans TakeOrderedAndProject)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)
