"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tejado.session import scratch_path

#: White space as the operators define it: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
#: A character that is not white space.
INK = r"[^\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the maximal runs of non-space characters; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def squeeze(text: Column) -> Column:
    """The text without any white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in at most eight partitions for each core of the cluster, without a shuffle: a write then makes no more files.

    Where executors come and go (dynamic allocation) the cores at hand tell nothing, and ``df`` stays as it is.
    """
    context = df.sparkSession.sparkContext
    if context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return df
    return df.coalesce(8 * context.defaultParallelism)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    few_files(df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_1, name_2, ... that no column of ``df`` has (without regard to case)."""
    taken = {c.lower() for c in df.columns}
    out, n = name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def bounded_sample(df: DataFrame, by: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (all, if it has no more), chosen by a hash of ``by``: reruns choose the same."""
    n = df.count()
    return df if n <= rows else df.where(F.pmod(F.xxhash64(by, F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * (rows / n)))
