"""Readers (SRC-01..04, SRC-07..10).

Every reader returns a lazy DataFrame; existence checks rely on Spark's own
``PATH_NOT_FOUND`` error, so they work the same on local disks and on the
cluster's shared storage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.functions.keys import company_from_name, file_base_name
from tejado.functions.text import norm_ascii
from tejado.operators.columns import normalize_names, require_columns


class MissingTable(FileNotFoundError):
    pass


def _missing(err: Exception) -> bool:
    text = str(err)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def read_required(spark: SparkSession, path: str, fmt: str = "parquet", normalize: bool = True, **options) -> DataFrame:
    """SRC-01 / SRC-10: a table that must exist; names normalised (PRJ-01)."""
    try:
        df = spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as e:
        if _missing(e):
            raise MissingTable(f"required table not found: {path}") from e
        raise
    return normalize_names(df) if normalize else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """SRC-04: header row; a UTF-8 BOM on the first header is dropped by Spark's CSV reader. ``options``: Spark's own."""
    reader = spark.read.options(**{"header": True, "encoding": "UTF-8", **options})
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    return reader.csv(path)


def read_optional(spark: SparkSession, base: str, name: str, schema: T.StructType | str | None = None,
                  formats=("parquet", "csv")) -> DataFrame:
    """SRC-02: try ``<base>/<name>.parquet``, then ``.csv``; none -> an empty table (with ``schema``)."""
    for fmt in formats:
        path = f"{base.rstrip('/')}/{name}.{fmt}"
        try:
            df = read_csv(spark, path, schema) if fmt == "csv" else spark.read.format(fmt).load(path)
            return normalize_names(df)
        except AnalysisException as e:
            if not _missing(e):
                raise
    return spark.createDataFrame([], schema if schema is not None else T.StructType([]))


# File suffix -> Spark source.
FORMATS = {"parquet": "parquet", "csv": "csv", "json": "json", "orc": "orc"}


def read_by_extension(spark: SparkSession, path: str, required: list[str] | None = None,
                      schema: T.StructType | str | None = None) -> DataFrame:
    """SRC-03: source chosen by the path's extension; unknown extensions raise; required columns checked."""
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if ext not in FORMATS:
        raise ValueError(f"unsupported format {ext!r} for {path}; use one of {sorted(FORMATS)}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = read_csv(spark, path, schema) if ext == "csv" else reader.format(FORMATS[ext]).load(path)
    df = normalize_names(df)
    if required:
        require_columns(df, required)
    return df


def read_tagged(spark: SparkSession, path: str, glob: str | None = None, fmt: str = "parquet",
                company_from: str = "folder") -> DataFrame:
    """SRC-07: many files in one scan, each row tagged with its source file and inferred company.

    ``company_from="folder"`` reads the company from the parent folder name,
    ``"file"`` from the file name (SC-18).
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    fpath = F.col("_metadata.file_path")
    folder = F.element_at(F.split(fpath, "/"), -2)
    source = folder if company_from == "folder" else file_base_name(fpath)
    return df.select("*", F.col("_metadata.file_name").alias("source_file"),
                     company_from_name(source).alias("company"))


def read_grid(spark: SparkSession, path: str, marker: str = "COMPROBANTE", max_rows: int = 30,
              technical_first: tuple[str, ...] = ("ID_COMPROBANTE", "ID COMPROBANTE")) -> DataFrame:
    """SRC-08 + SRC-09: headerless CSV grids -> table.

    Per file, the header is the first row with a cell containing ``marker``, else the first row; all-blank rows drop; a
    technical second header (first cell ``ID_COMPROBANTE``) right after the header drops. Every file's cells go by its
    own header, so files may have their columns in any order; a name that a file lacks is null there. A marker that
    stands only after ``max_rows`` rows raises.

    Positions come from per-file aggregates over a row id (no window holds a whole file in one task); the joins carry one
    row per file. Only the distinct headers reach the driver.
    """
    raw = spark.read.option("header", False).csv(path)
    cells = raw.columns
    raw = raw.select(F.array(*cells).alias("__cells"), F.col("_metadata.file_path").alias("__file"),
                     F.monotonically_increasing_id().alias("__id"))
    has_marker = F.exists("__cells", lambda c: F.coalesce(norm_ascii(c).contains(marker), F.lit(False)))
    mark = F.when(has_marker, F.col("__id"))
    files = raw.groupBy("__file").agg(F.min("__id").alias("__first"), F.min(mark).alias("__mark"),
                                      F.min_by("__cells", mark).alias("__named"), F.min_by("__cells", "__id").alias("__top"))
    # ids of a file's first rows follow each other (they are in one split), so a late marker shows as a large difference
    late = F.col("__mark") - F.col("__first") >= max_rows
    names = F.transform(F.coalesce("__named", "__top"), lambda h, i: F.coalesce(
        F.nullif(F.trim(h), F.lit("")), F.concat(F.lit("col_"), i.cast("string"))))
    files = files.select("__file", F.coalesce("__mark", "__first").alias("__hdr"), names.alias("__names"), F.coalesce(late, F.lit(False)).alias("__late"))
    layouts = files.select("__names", "__late").distinct().collect()  # one row per distinct header
    if any(r["__late"] for r in layouts):
        raise ValueError(f"a cell with {marker!r} stands only after the first {max_rows} rows of a file in {path}")
    header = list(dict.fromkeys(n for r in sorted(layouts, key=lambda r: r["__names"]) for n in r["__names"]))
    body = raw.join(files, "__file").where((F.col("__id") > F.col("__hdr")) & F.exists("__cells", lambda c: c.isNotNull()))
    second = body.groupBy("__file").agg(F.min("__id").alias("__second"))
    body = body.join(second, "__file")
    tech = (F.col("__id") == F.col("__second")) & F.coalesce(norm_ascii(F.get("__cells", 0)).isin(*technical_first), F.lit(False))
    at = lambda n: F.get("__cells", F.array_position("__names", n).cast("int") - 1)
    return body.where(~tech).select(*[F.when(F.array_contains("__names", n), at(n)).alias(n) for n in header])
