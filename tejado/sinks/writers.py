"""Writers (SNK-01..11).

Everything writes through ``DataFrameWriter`` to the given folder; callers on a
cluster pass folders on shared storage. Where several outputs hold the same
rows, the later ones are made from the first as written.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.functions.contacts import anonymise_frame
from tejado.functions.text import safe_label, ustrip
from tejado.operators.dedup import ROW_ORDER, straight_from_files, unique_labels, with_file_order
from tejado.session import staged


def with_lineage(df: DataFrame, prefix: str = "_bronze") -> DataFrame:
    """SNK-02: load time and source file of every row (file-backed DataFrames only)."""
    return df.select("*", F.current_timestamp().alias(f"{prefix}_loaded_at"),
                     F.col("_metadata.file_path").alias(f"{prefix}_source_file"))


def with_row_order(df: DataFrame) -> DataFrame:
    """The rows' order in their files as a column (``ROW_ORDER``) that later layers carry; a table that has it keeps it.

    Spark writes and reads files in an order of its own (large ones first), so without this a rewritten table has lost
    which row came first. One narrow pass: no sort, no shuffle.
    """
    return df if ROW_ORDER in df.columns else with_file_order(df, ROW_ORDER)


def cast_void(df: DataFrame) -> DataFrame:
    """SNK-04: untyped (void / null-literal) columns become strings so every format can store them."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> list[str]:
    """SNK-01 / SNK-03: ``parquet``, ``csv`` or ``both`` (the CSV copy is made from the Parquet one); unknown -> error."""
    if fmt not in ("parquet", "csv", "both"):
        raise ValueError(f"unknown output format {fmt!r}")
    df = cast_void(df)
    if fmt == "csv":
        df.write.mode(mode).option("header", True).csv(path)
        return [path]
    df.write.mode(mode).parquet(path)
    if fmt == "parquet":
        return [path]
    df.sparkSession.read.schema(df.schema).parquet(path).write.mode(mode).option("header", True).csv(path + "_csv")
    return [path + "_csv", path]


# Printable characters that Spark writes as %XX in the folder names of partitions; % first.
ESCAPED = "%\"#'*/:=?\\{[]^"


def _folder_name(label) -> Column:
    """A label as Spark writes it in a partition folder's name."""
    for c in ESCAPED:
        label = F.replace(label, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return label


VERSIONS = "_versiones"
VERSION_SCHEMA = "numero long, carpeta string, grupos long, filas long"


def _versions(spark, base: str) -> list:
    """The finished versions of an export, oldest first (a few rows: old ones are dropped from the folder, not from here)."""
    try:
        return spark.read.schema(VERSION_SCHEMA).json(f"{base}/{VERSIONS}").orderBy(F.col("numero").desc(), "carpeta").limit(100).collect()[::-1]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []


def _drop_folders(spark, base: str, keep: str) -> None:
    """Removes all version folders but ``keep``; any store that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in store.listStatus(path):
        name = f.getPath().getName()
        if name.startswith("v=") and name != keep:
            store.delete(f.getPath(), True)


def split_by_group(df: DataFrame, group_col: str, path: str, default: str = "Sin Asesor", max_len: int = 80,
                   rows_per_file: int = 1_000_000) -> DataFrame:
    """SNK-05: one folder per value of the group column (stripped; null/blank -> ``default``) plus a manifest.

    Values make the groups; the label (illegal characters replaced, cut, made unique without regard to case) only names
    the folder. Rows are dealt by label and, in groups of over ``rows_per_file`` rows, by a hash, so a group gets as many
    files as it needs and no more. Returns the manifest (grupo, filas, etiqueta, carpeta), most rows first.

    Every run writes a whole new version folder (rows and manifest) and then appends one row to the list of versions,
    which makes it the current one; the folders of the versions before go last. So a second run replaces the first,
    groups that have vanished included, and a run broken midway leaves the former export as it was
    (:func:`read_export`, :func:`export_manifest`). One run at a time per folder.

    The input is computed once: unless it is read straight from files, it is written to the scratch folder first.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    before = _versions(spark, base)
    number = before[-1]["numero"] + 1 if before else 1
    version = f"v={number:06d}-{uuid.uuid4().hex[:8]}"
    src = df if straight_from_files(df) else staged(df, "export-rows")
    value = F.coalesce(F.nullif(ustrip(F.col(f"`{group_col}`").cast("string")), F.lit("")), F.lit(default))
    counts = src.groupBy(value.alias("grupo")).agg(F.count(F.lit(1)).alias("filas"))  # one row per group
    counts = counts.withColumn("__label", F.lower(safe_label(F.col("grupo"), max_len=max_len - 6, default=default)))
    labels = unique_labels(counts, "__label", "__unique", max_len=max_len, order_by=["grupo"])
    shown = F.concat(safe_label(F.col("grupo"), max_len=max_len - 6, default=default), F.substring("__unique", F.length("__label") + 1, F.lit(max_len)))
    table = labels.select("grupo", "filas", shown.alias("etiqueta"))
    folder = F.concat(F.lit(f"{base}/{version}/rows/__grupo="), _folder_name(F.col("etiqueta")))
    table.withColumn("carpeta", folder).write.parquet(f"{base}/{version}/manifest")
    manifest = spark.read.parquet(f"{base}/{version}/manifest")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]), F.ceil(F.col("filas") / rows_per_file))
    rows = src.withColumn("__value", value).join(manifest.select(F.col("grupo").alias("__value"), "filas", F.col("etiqueta").alias("__grupo")), "__value")
    rows = rows.withColumn("__salt", salt).repartition("__grupo", "__salt")
    rows.select(*[f"`{c}`" for c in df.columns], "__grupo").write.partitionBy("__grupo").parquet(f"{base}/{version}/rows")
    total = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum("filas"), F.lit(0))).first()
    spark.createDataFrame([(number, version, *total)], VERSION_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/{VERSIONS}")
    _drop_folders(spark, base, keep=version)
    return manifest.orderBy(F.col("filas").desc(), F.col("grupo"))


def _current(spark, path: str) -> str:
    base = path.rstrip("/")
    finished = _versions(spark, base)
    if not finished:
        raise FileNotFoundError(f"no finished export in {path}")
    return f"{base}/{finished[-1]['carpeta']}"


def export_manifest(spark, path: str) -> DataFrame:
    """The manifest of the current version of a :func:`split_by_group` folder."""
    return spark.read.parquet(f"{_current(spark, path)}/manifest")


def read_export(spark, path: str) -> DataFrame:
    """The rows of the current version, each with its ``grupo``."""
    current = _current(spark, path)
    found = spark.read.parquet(f"{current}/rows")
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name == "__grupo" else f.dataType) for f in found.schema])
    labels = spark.read.parquet(f"{current}/manifest").select(F.col("etiqueta").alias("__grupo"), "grupo")
    return spark.read.schema(as_text).parquet(f"{current}/rows").join(labels, "__grupo").drop("__grupo")


def write_versioned(df: DataFrame, base: str, ledger_path: str, name: str, stamp: str | None = None) -> str:
    """SNK-06: never overwrite in place: write ``<base>/v=<stamp>`` and append a pointer row to the run ledger."""
    stamp = stamp or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    target = f"{base.rstrip('/')}/v={stamp}"
    df.write.mode("errorifexists").parquet(target)
    spark = df.sparkSession
    row = spark.createDataFrame([(name, stamp, target)], "tabla string, version string, ruta string")
    row.write.mode("append").json(ledger_path)
    return target


def current_version(spark, ledger_path: str, name: str) -> str | None:
    """Path of the latest version of ``name`` from the ledger (max_by over the version stamp)."""
    led = spark.read.schema("tabla string, version string, ruta string").json(ledger_path)
    row = led.where(F.col("tabla") == name).agg(F.max_by("ruta", "version").alias("ruta")).first()
    return row["ruta"] if row else None


LOG_SCHEMA = "ts timestamp, libreria string, paso string, estado string, mensaje string, metricas string, fecha date"
PARTS = "_partes"
POINTER = "_puntero"
POINTER_SCHEMA = "numero long, partes array<string>"
MOST_PARTS = 10


def log_event(spark, path: str, library: str, step: str, status: str, message: str = "", metrics: dict | None = None,
              compact_after: int = 100):
    """SNK-08: append one event to a JSON-lines run log partitioned by date.

    Every event is a small file of its own; when ``compact_after`` of them have gathered, they are grouped into one part
    (:func:`compact_log`). Read the log with :func:`read_log`.
    """
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(now, library, step, status, message, json.dumps(metrics or {}, sort_keys=True),
                                  now.date())], LOG_SCHEMA)
    row.coalesce(1).write.mode("append").partitionBy("fecha").json(path)
    if len(spark.read.schema(LOG_SCHEMA).json(path).inputFiles()) >= compact_after:
        compact_log(spark, path)


def _live_parts(spark, path: str) -> tuple[int, list[str]]:
    """Number of the latest pointer, and the parts that it names."""
    try:
        last = spark.read.schema(POINTER_SCHEMA).json(f"{path}/{POINTER}").agg(F.max_by(F.struct("numero", "partes"), "numero")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        last = None
    return (last["numero"], list(last["partes"])) if last else (0, [])


def _loose_events(spark, path: str, parts: list[str]) -> DataFrame:
    """Events in small files that no live part has taken in, with the file they are in (``__file``)."""
    events = spark.read.schema(LOG_SCHEMA).json(path).withColumn("__file", F.col("_metadata.file_path"))
    if parts:
        taken = spark.read.schema("__file string").parquet(*[f"{path}/{PARTS}/{p}/files" for p in parts])
        events = events.join(taken, "__file", "left_anti")
    return events


def compact_log(spark, path: str) -> None:
    """Groups the small files of a run log into a part; ten parts become one.

    A part holds the events and the names of the files that they came from. One row appended to the pointer makes it
    live; the small files go afterwards. Broken off before that row, the part counts for nothing; after it, the small files
    left are known to be taken in. Events that arrive meanwhile are in files that no part names. One compaction at a time.
    """
    path = path.rstrip("/")
    number, parts = _live_parts(spark, path)
    loose = _loose_events(spark, path, parts)
    files = [r["__file"] for r in loose.select("__file").distinct().collect()]  # about compact_after names
    if not files:
        return
    events = loose.where(F.col("__file").isin(files)).drop("__file")
    merged = parts if len(parts) + 1 >= MOST_PARTS else []
    names = list(files)
    if merged:
        events = events.unionByName(spark.read.schema(LOG_SCHEMA).parquet(*[f"{path}/{PARTS}/{p}/events" for p in merged]))
        there = {r[0] for r in spark.read.schema(LOG_SCHEMA).json(path).select("_metadata.file_path").distinct().collect()}
        taken = spark.read.schema("__file string").parquet(*[f"{path}/{PARTS}/{p}/files" for p in merged])
        names += [r["__file"] for r in taken.where(F.col("__file").isin(sorted(there))).collect()]  # whose removal had failed
    part = uuid.uuid4().hex
    events.coalesce(4).write.parquet(f"{path}/{PARTS}/{part}/events")
    spark.createDataFrame([(f,) for f in names], "__file string").coalesce(1).write.parquet(f"{path}/{PARTS}/{part}/files")
    live = [*[p for p in parts if p not in merged], part]
    spark.createDataFrame([(number + 1, live)], POINTER_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/{POINTER}")
    jvm = spark._jvm
    gone = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in names] + [jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTS}/{p}") for p in merged]
    store = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for g in gone:
        store.delete(g, True)


def read_log(spark, path: str) -> DataFrame:
    """All events of a run log, from its parts and from the small files that are in none."""
    path = path.rstrip("/")
    _, parts = _live_parts(spark, path)
    loose = _loose_events(spark, path, parts).drop("__file")
    return loose.unionByName(spark.read.schema(LOG_SCHEMA).parquet(*[f"{path}/{PARTS}/{p}/events" for p in parts])) if parts else loose


def write_bundle(parts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, str]:
    """SNK-09: several outputs of one run (summary, detail, per-group parts) into one folder each."""
    out = {}
    for name, df in parts.items():
        target = f"{path.rstrip('/')}/{name}"
        write_table(df, target, fmt)
        out[name] = target
    return out


def rebuild_master(enriched: DataFrame, path: str, company_col: str = "source_company") -> None:
    """SNK-10: the master ledger is the enriched ledger itself, written partitioned by company."""
    enriched.withColumn("__empresa", F.coalesce(F.col(company_col), F.lit("SIN_COMPANY"))) \
            .write.mode("overwrite").partitionBy("__empresa").parquet(path)


def sample_rows(df: DataFrame, order_by: list[str], n: int = 20) -> DataFrame:
    """SNK-11 core: the first ``n`` rows in a stated order, anonymised (SC-27). A sampling feature."""
    return anonymise_frame(df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n))


def export_samples(tables: dict[str, tuple[DataFrame, list[str]]], path: str, n: int = 20) -> list[dict]:
    """SNK-11: anonymised samples per table as CSV; a failing table is reported, not fatal."""
    report = []
    for name, (df, order_by) in tables.items():
        try:
            sample_rows(df, order_by, n).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
            report.append({"tabla": name, "estado": "ok"})
        except Exception as e:  # noqa: BLE001 - reported per table
            report.append({"tabla": name, "estado": f"error: {type(e).__name__}: {e}"[:300]})
    return report
