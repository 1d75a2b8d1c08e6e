"""Source / sink round trips (SRC-01..10, SNK-01..11) and the jobs built on them (JOB-04, 13, 14, 17).

Each query writes the driver's tables into a fresh folder under the session's
``spark.checkpoint.dir`` (shared storage on a cluster) and returns what the
reader gives back, so the oracle is plain SQL on the source table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from tejado.catalog import register
from tejado.catalog.ledger_queries import CTE_COMPANY
from tejado.catalog.sqlfn import ustrip, with_ctes
from tejado.catalog.stock_queries import CTE_STOCK, STOCK, STOCK_VIEWS
from tejado.plans import exports as ex
from tejado.plans import extraction as xt
from tejado.plans import medallion as md
from tejado.plans.adapters import VIEWS, read_base, view
from tejado.session import scratch_path, staged
from tejado.sinks import writers as wr
from tejado.sources import readers as rd


@register("src01_required_parquet", "SELECT * FROM part")
def src01(spark, sf):
    """SNK-01 write (messy headers) + SRC-01 required read with PRJ-01 names; SRC-10 reload."""
    path = scratch_path(spark, "src01") + "/part.parquet"
    messy = read_base(spark, sf, "part").toDF("P Partkey", " P-Name", "p.Brand", "P_Type", "P Size ", "P-RetailPrice")
    wr.write_table(messy, path, "parquet")
    return rd.read_required(spark, path)


@register("src02_optional_csv", "SELECT * FROM supplier")
def src02(spark, sf):
    """SNK-03 (csv) + SRC-02: no parquet for the name, so the CSV copy is read (header, typed schema)."""
    base = scratch_path(spark, "src02")
    sup = read_base(spark, sf, "supplier")
    wr.write_table(sup, f"{base}/supplier.csv", "csv")
    return rd.read_optional(spark, base, "supplier", schema=sup.schema)


@register("snk03_both_formats", "SELECT * FROM customer")
def snk03(spark, sf):
    """SNK-03 ``both``: one persisted base, a CSV and a Parquet copy; SRC-03 reads by extension."""
    base = scratch_path(spark, "snk03")
    cust = read_base(spark, sf, "customer")
    wr.write_table(cust, f"{base}/customer.parquet", "both")
    return rd.read_by_extension(spark, f"{base}/customer.parquet", required=["c_custkey", "c_name"])


@register("snk04_untyped_column", "SELECT *, CAST(NULL AS VARCHAR) AS sin_tipo FROM supplier")
def snk04(spark, sf):
    """SNK-04: a column that is only nulls has no type; it is written as text and read back so."""
    path = scratch_path(spark, "snk04")
    wr.write_table(read_base(spark, sf, "supplier").withColumn("sin_tipo", F.lit(None)), path)
    return rd.read_required(spark, path)


# Fixed values (test shaping): ledger folder per order status.
STATUS_FOLDER = {"F": "tablon_URSA", "O": "tablon_LYNX", "P": "tablon_CYGNUS"}
STATUS_COMPANY = {"F": "URSA", "O": "LYNX", "P": "CYGNUS"}


@register("src07_tagged_union", "SELECT *, CASE o_orderstatus " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_COMPANY.items()) + " END AS company, 'part' AS source_file FROM orders")
def src07(spark, sf):
    """SRC-07 + SE-01: files of three folders read in one scan, rows tagged with their file and company (SC-18). Spark
    names the files, so the check is on the constant beginning of their names."""
    base = scratch_path(spark, "src07")
    o = read_base(spark, sf, "orders")
    for status, folder in STATUS_FOLDER.items():
        o.where(F.col("o_orderstatus") == status).write.mode("overwrite").parquet(f"{base}/{folder}")
    return rd.read_tagged(spark, base, glob="*.parquet").withColumn("source_file", F.substring_index("source_file", "-", 1))


@register("src08_grid_header", """
SELECT CAST(s_suppkey AS VARCHAR) AS "N° Comprobante", s_name AS "Proveedor", CAST(s_nationkey AS VARCHAR) AS "Nacion"
FROM supplier""")
def src08(spark, sf):
    """SRC-08 + SRC-09: headerless grids (title lines, header with COMPROBANTE, technical row, blank row, data) written
    as four CSV files, one with two columns swapped, and read back as a table."""
    path = scratch_path(spark, "src08")
    s = read_base(spark, sf, "supplier")
    top = spark.createDataFrame(
        [(0, "Reporte de ventas", None, None), (1, None, None, None), (2, "N° Comprobante", "Proveedor", "Nacion"),
         (3, "ID_COMPROBANTE", "proveedor", "nacion"), (4, None, None, None)], "o long, a string, b string, c string")
    top = top.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("archivo"), "*")
    body = s.select((F.col("s_suppkey") % 4).cast("int").alias("archivo"), (F.col("s_suppkey") + 10).alias("o"),
                    F.col("s_suppkey").cast("string").alias("a"), F.col("s_name").alias("b"), F.col("s_nationkey").cast("string").alias("c"))
    swap = F.col("archivo") == 1
    rows = top.unionByName(body).select("archivo", "o", "a", F.when(swap, F.col("c")).otherwise(F.col("b")).alias("b"),
                                        F.when(swap, F.col("b")).otherwise(F.col("c")).alias("c"))
    rows.repartition("archivo").sortWithinPartitions("archivo", "o").select("archivo", "a", "b", "c") \
        .write.mode("overwrite").partitionBy("archivo").csv(path)
    return rd.read_grid(spark, f"{path}/archivo=*")


@register("snk06_versioned_write", "SELECT * FROM part")
def snk06(spark, sf):
    """SNK-06: two versions written side by side, the ledger pointer picks the latest."""
    base = scratch_path(spark, "snk06")
    part = read_base(spark, sf, "part")
    wr.write_versioned(part.withColumn("p_name", F.lit("antes")), f"{base}/part", f"{base}/_ledger", "part", stamp="20240101T000000")
    wr.write_versioned(part, f"{base}/part", f"{base}/_ledger", "part", stamp="20240102T000000")
    return spark.read.parquet(wr.current_version(spark, f"{base}/_ledger", "part"))


@register("snk08_run_log", """
SELECT 'tejado' AS libreria, 'conteo_' || l_returnflag AS paso, 'ok' AS estado,
  '{"filas": ' || CAST(count(*) AS VARCHAR) || '}' AS metricas FROM lineitem GROUP BY l_returnflag""")
def snk08(spark, sf):
    """SNK-08: one appended log event per step (here: the row count of each return flag), compacted on the way."""
    path = scratch_path(spark, "snk08")
    counts = read_base(spark, sf, "lineitem").groupBy("l_returnflag").count().collect()  # one row per flag
    for r in counts:
        wr.log_event(spark, path, "tejado", f"conteo_{r['l_returnflag']}", "ok", metrics={"filas": r["count"]}, compact_after=2)
    return wr.read_log(spark, path).select("libreria", "paso", "estado", "metricas")


@register("snk02_bronze_lineage", with_ctes(["clientes"], []) + "SELECT *, true AS con_linaje FROM clientes")
def snk02(spark, sf):
    """SNK-02: bronze rows carry load time and source file."""
    path = scratch_path(spark, "snk02") + "/clientes.parquet"
    view(spark, sf, "clientes").write.mode("overwrite").parquet(path)
    bronze = wr.with_lineage(rd.read_required(spark, path))
    flag = F.col("_bronze_loaded_at").isNotNull() & F.col("_bronze_source_file").contains("clientes.parquet")
    return bronze.withColumn("con_linaje", flag).drop("_bronze_loaded_at", "_bronze_source_file")


def raw_files(rows: int, per_file: int = 250_000) -> int:
    """Files of a raw table: three, or as many as a large table needs for tasks of a bounded size."""
    return max(3, -(-rows // per_file))


@register("job04_medallion_gold", with_ctes(STOCK_VIEWS, CTE_STOCK) + STOCK)
def job04(spark, sf):
    """JOB-04: raw -> bronze -> silver -> gold written as layers, gold stock loaded back. The raw tables are several files
    each, without an order column: which row is first or last is told by the files alone, through bronze."""
    base = scratch_path(spark, "job04")
    for name in md.RAW_TABLES:
        order = "id_proceso" if name == "procesos" else "orden_fila"
        files = raw_files(read_base(spark, sf, VIEWS[name][1][0]).count())
        source = view(spark, sf, name)
        source = staged(source, "job04-procesos") if name == "procesos" else source  # joined once: dealing by ranges reads it twice
        table = source.repartitionByRange(files, order).sortWithinPartitions(order).drop(order)
        md.write_layer(table, f"{base}/raw/{name}.parquet", mode="errorifexists")
    owners, stock = md.run_all(spark, base)
    return stock


@register("job13_daily_extraction", """
SELECT 1 AS corrida, 'nation' AS tabla, 'extracted' AS estado, count(*) AS filas FROM nation
UNION ALL SELECT 1, 'supplier', 'extracted', count(*) FROM supplier
UNION ALL SELECT 2, 'nation', 'skipped_cache_today', count(*) FROM nation
UNION ALL SELECT 2, 'supplier', 'skipped_cache_today', count(*) FROM supplier""")
def job13(spark, sf):
    """JOB-13: daily extraction with a run ledger; the second run the same day is served from cache.

    The warehouse side (SRC-05 ``jdbc_table``) is swapped for the driver's
    parquet tables: no database may be started here.
    """
    base = scratch_path(spark, "job13")
    sources = {"nation": lambda: read_base(spark, sf, "nation"), "supplier": lambda: read_base(spark, sf, "supplier")}
    day = _dt.date(2026, 7, 13)
    first = xt.daily_extract(spark, sources, f"{base}/raw", f"{base}/_ledger", today=day)
    second = xt.daily_extract(spark, sources, f"{base}/raw", f"{base}/_ledger", today=day)
    return (first.withColumn("corrida", F.lit(1)).unionByName(second.withColumn("corrida", F.lit(2)))
                 .select("corrida", "tabla", "estado", "filas"))


_LABEL = f"coalesce(nullif({ustrip('asesor')}, ''), 'Sin Asesor')"


@register("job17_export_by_advisor", with_ctes(["procesos"], []) + f"""
SELECT {_LABEL} AS grupo, id_proceso, codigo_proforma, count(*) OVER (PARTITION BY {_LABEL}) AS filas FROM procesos""")
def job17(spark, sf):
    """JOB-17: rows by advisor (SNK-05, SC-34; null and blank -> Sin Asesor), exported twice into one folder, the first
    time under another name for missing advisors; the rows and the manifest's counts are read back."""
    path = scratch_path(spark, "job17")
    processes = staged(view(spark, sf, "procesos"), "job17-rows")  # both runs export these rows
    ex.export_by_advisor(processes, path, default="Nadie")
    ex.export_by_advisor(processes, path)
    counts = wr.export_manifest(spark, path).select("grupo", "filas")
    return wr.read_export(spark, path).join(counts, "grupo").select("grupo", "id_proceso", "codigo_proforma", "filas")


_SENS = ["documento", "nombres", "apellidos", "cliente", "celulares", "telefono", "email"]


def _anon(c):
    t = ustrip(c)
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {t} = '' THEN NULL ELSE 'anon_' || substr(sha256({t}), 1, 10) END AS {c}"


@register("job14_anonymised_sample", with_ctes(["clientes"], []) + "SELECT " + ", ".join(
    [_anon(c) for c in _SENS] + ["medio_captacion", "estado", "orden_fila"])
    + " FROM (SELECT * FROM clientes ORDER BY documento LIMIT 20) q")
def job14(spark, sf):
    """JOB-14 / SNK-11 / SC-27: 20 rows in key order, sensitive columns hashed, written as CSV and read back (a CSV
    doesn't tell a blank from a null)."""
    path = scratch_path(spark, "job14")
    cli = view(spark, sf, "clientes")
    report = ex.samples({"clientes": (cli, ["documento"])}, path)
    if report[0]["estado"] != "ok":
        raise RuntimeError(report[0]["estado"])
    return rd.read_csv(spark, f"{path}/clientes", schema=cli.schema)


@register("snk10_master_rebuild", with_ctes(["ledger", "master"], CTE_COMPANY)
          + "SELECT coalesce(source_company, 'SIN_COMPANY') AS __empresa, count(*) AS filas FROM by_company GROUP BY 1")
def snk10(spark, sf):
    """SNK-10: the enriched ledger written as the master table, partitioned by company."""
    from tejado.plans import ledger as lg
    path = scratch_path(spark, "snk10")
    wr.rebuild_master(lg.enrich_by_company(view(spark, sf, "ledger"), view(spark, sf, "master")), path)
    return spark.read.parquet(path).groupBy("__empresa").agg(F.count(F.lit(1)).alias("filas"))
