"""Layered run: raw -> bronze -> silver -> gold, rebuild gold only, load gold (JOB-04).

Each layer is a folder of Parquet tables under ``base``. Bronze adds lineage
columns (SNK-02) and the rows' order in the raw files, which decides what
"first" and "last" mean in silver; silver and gold are the JOB-01..03 plans.
Writing each layer cuts lineage, so a lost executor recomputes from the last
written layer only. The shuffle files of a table go as soon as it is written, so
the disk holds the layers and the shuffles of one table; layers are in zstd.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tejado.plans import stock as st
from tejado.session import shuffles_freed
from tejado.sinks.writers import with_lineage, with_row_order
from tejado.sources.readers import read_required

RAW_TABLES = ["unidades", "proyectos", "clientes", "procesos"]
SILVER_TABLES = ["silver_unidades", "silver_proyectos", "silver_clientes", "silver_separaciones", "silver_ventas",
                 "silver_copropietarios"]


def _p(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}.parquet"


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A layer's table as Parquet; nothing of its making stays on the disk."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)


def build_bronze(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    out = {}
    for name in RAW_TABLES:
        df = with_lineage(with_row_order(read_required(spark, _p(base, "raw", name))))
        write_layer(df, _p(base, "bronze", name))
        out[name] = read_required(spark, _p(base, "bronze", name))
    return out


def build_silver(spark: SparkSession, base: str, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    silver = st.silver(bronze, in_steps=True)
    write_layer(silver["procesos_por_proforma"], _p(base, "silver", "procesos_por_proforma"))
    silver |= st.silver_of_facts(read_required(spark, _p(base, "silver", "procesos_por_proforma")))  # computed once, for three tables
    for name in SILVER_TABLES:
        write_layer(silver[name], _p(base, "silver", name))
    return load_silver(spark, base)


def load_silver(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """SRC-10: reload silver without rebuilding; a missing table raises."""
    return {name: read_required(spark, _p(base, "silver", name)) for name in SILVER_TABLES}


def build_gold(spark: SparkSession, base: str, silver: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    owners = st.owners(silver)
    write_layer(owners, _p(base, "gold", "mart_propietarios"))
    owners = read_required(spark, _p(base, "gold", "mart_propietarios"))
    stock = st.sorted_stock(st.stock(silver, owners))
    write_layer(stock, _p(base, "gold", "mart_stock_unidades_completo"))
    return load_gold(spark, base)


def load_gold(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """SRC-10: the gold marts as written; error if absent."""
    return (read_required(spark, _p(base, "gold", "mart_propietarios")),
            read_required(spark, _p(base, "gold", "mart_stock_unidades_completo")))


def run_all(spark: SparkSession, base: str, raw: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Full run. ``raw`` tables, when given, are first written to ``<base>/raw`` (the extraction output)."""
    for name, df in (raw or {}).items():
        write_layer(df, _p(base, "raw", name))
    return build_gold(spark, base, build_silver(spark, base, build_bronze(spark, base)))


def rebuild_gold(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return build_gold(spark, base, load_silver(spark, base))
