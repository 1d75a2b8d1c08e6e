"""Join operators (JN-07, JN-12..14) and the join rules used by the jobs.

All joins are equi-joins. No explicit ``broadcast`` hint is given for tables
whose size grows with the data: the planner's size check
(``spark.sql.autoBroadcastJoinThreshold``) and AQE's runtime statistics pick
broadcast when a side is actually small and a shuffle join otherwise. Only
tables of fixed size (rule lists, one-row aggregates) are broadcast by hand.

Null keys never match by default (a client without a document is not the
owner of every undocumented sale, T-02); ``null_safe=True`` uses ``<=>``, which
still plans as a hash or sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.functions._util import col_of


def key_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
             null_safe: bool = False) -> DataFrame:
    """Equi-join on same-named keys, keeping one copy of each key column."""
    if not null_safe:
        return left.join(right, on=keys, how=how)
    cond = [left[k].eqNullSafe(right[k]) for k in keys]
    joined = left.join(right, on=cond, how=how)
    keep = [F.coalesce(left[k], right[k]).alias(k) if how in ("full", "outer", "right") else left[k] for k in keys]
    rest = [left[c] for c in left.columns if c not in keys] + [right[c] for c in right.columns if c not in keys]
    return joined.select(*keep, *rest)


def spread_unmatchable(key, salt_cols: list[str], unmatchable=None) -> Column:
    """Join key where rows that can never match (null or blank key) get a unique, never-matching value.

    Such rows would otherwise all hash into one shuffle partition (a hot key).
    The value is ``'#'`` + a hash of the row, and real keys never start with
    ``'#'`` (callers' keys are normalised to ``[A-Z0-9|-]`` or digits), so no
    false match is possible and no row is dropped; the plan is not duplicated.
    """
    key = col_of(key)
    bad = key.isNull() | (key == "") if unmatchable is None else unmatchable
    salt = F.concat(F.lit("#"), F.xxhash64(*[F.col(c) for c in salt_cols]).cast("string"))
    return F.when(bad, salt).otherwise(key)


def left_join_nonnull(left: DataFrame, right: DataFrame, key: str, salt_cols: list[str] | None = None,
                      blank_matches: bool = False) -> DataFrame:
    """Left join on ``key`` where rows with a null or blank key are spread, not piled on one partition.

    ``blank_matches``: blank keys are values like any other; only null ones are spread.
    """
    unmatchable = F.col(key).isNull() if blank_matches else None
    salted = left.withColumn("__jk", spread_unmatchable(F.col(key), salt_cols or left.columns, unmatchable))
    r = right.withColumnRenamed(key, "__rk")
    out = salted.join(r, on=salted["__jk"] == r["__rk"], how="left")
    return out.drop("__jk", "__rk")


def left_join_m1(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                 indicator: str | None = "_merge", validate: bool = False) -> DataFrame:
    """JN-12: m:1 left join with a ``both`` / ``left_only`` indicator column.

    The caller has reduced the right side to one row per key (WD-01). ``validate`` checks that inside the plan: the query
    fails, when it runs, on a key that repeats.
    """
    r = right.withColumn("__hit", F.lit(True))
    if validate:
        sizes = right.groupBy(F.col(right_on).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
        repeated = F.raise_error(F.concat(F.lit(f"right side is not unique on {right_on}: "), F.col("__k").cast("string")))
        r = r.join(sizes, on=F.col(right_on) == F.col("__k")).withColumn("__hit", F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(True)).drop("__k", "__n")
    out = left.join(r, on=left[left_on] == r[right_on], how="left")
    if indicator:
        out = out.withColumn(indicator, F.when(F.col("__hit"), F.lit("both")).otherwise(F.lit("left_only")))
    return out.drop("__hit")


def unmatched(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """JN-13: rows of ``left`` without a partner (``left_anti``)."""
    return left.join(right, on=left[left_on] == right[right_on], how="left_anti")


def same_key(a, b) -> Column:
    """JN-14: ``a == b`` with null -> false."""
    return F.coalesce(col_of(a) == col_of(b), F.lit(False))
