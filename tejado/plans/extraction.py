"""Warehouse pulls and the daily extraction cache (JOB-13, SRC-05, SRC-06, SNK-08).

A run ledger (one JSON row per extraction: table, date, time, rows, format,
path) replaces the per-table marker files; "fresh" means a ledger row dated
today whose data folder still exists. Row counts come from the written files.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IDENTIFIER = re.compile(r"^[A-Za-z0-9_]+$")
LEDGER_SCHEMA = "tabla string, fecha_extraccion date, extraido_en timestamp, filas long, formato string, ruta string"


def safe_identifier(name: str) -> str:
    """SRC-05 allow-list check on schema and table identifiers."""
    if not IDENTIFIER.match(name or ""):
        raise ValueError(f"unsafe identifier: {name!r}")
    return name


def jdbc_table(spark: SparkSession, url: str, schema: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """SRC-05: full-table pull over JDBC, split into ``num_partitions`` range reads when a numeric
    partition column is given (parallel fetch instead of one ``fetchall``)."""
    ident = f'"{safe_identifier(schema)}"."{safe_identifier(table)}"'
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, ident, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, ident, properties=props)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).json(ledger_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def _exists(spark: SparkSession, path: str, fmt: str) -> bool:
    try:
        spark.read.format(fmt).load(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def daily_extract(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], raw_dir: str, ledger_path: str,
                  fmt: str = "parquet", force: bool = False, today: _dt.date | None = None) -> DataFrame:
    """SRC-06: copy each source table unless a ledger row dated today exists and its data is there.

    Returns one status row per table: (tabla, estado, filas, ruta) with
    ``skipped_cache_today`` or ``extracted``.
    """
    today = today or _dt.datetime.now(_dt.timezone.utc).date()
    ledger = read_ledger(spark, ledger_path)
    # the ledger holds one row per table and day: a small table, fine to bring to the driver
    fresh = {r["tabla"]: r for r in ledger.where(F.col("fecha_extraccion") == F.lit(today))
             .groupBy("tabla").agg(F.max_by(F.struct("filas", "ruta"), "extraido_en").alias("u"))
             .select("tabla", "u.*").collect()}
    status = []
    for name, make in sources.items():
        safe_identifier(name)
        path = f"{raw_dir.rstrip('/')}/{name}.{fmt}"
        hit = fresh.get(name)
        if hit is not None and not force and _exists(spark, hit["ruta"], fmt):
            status.append((name, "skipped_cache_today", hit["filas"], hit["ruta"]))
            continue
        make().write.mode("overwrite").format(fmt).save(path)
        rows = spark.read.format(fmt).load(path).count()
        stamp = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        spark.createDataFrame([(name, today, stamp, rows, fmt, path)], LEDGER_SCHEMA) \
             .write.mode("append").json(ledger_path)
        status.append((name, "extracted", rows, path))
    return spark.createDataFrame(status, "tabla string, estado string, filas long, ruta string")
