"""Spark session and shared-folder helpers.

Library functions never create a session: they take DataFrames. This module is
for entry points (bench, tests, scripts) that need one, and for jobs that must
cut lineage into the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every entry point wants; the cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot never JIT-compiles methods above 8000 bytes of bytecode; keep generated
    # methods under that (Spark's documented advice) and let the JIT take the rest.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, app: str = "tejado", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``shuffle_partitions`` defaults to the number of local cores when running
    locally; on a cluster leave it to the cluster (AQE coalesces anyway).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests, bench) do we make our own folder under the
    system temp dir; on a cluster each machine would have its own, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tejado-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder path inside the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Actions inside leave no shuffle files: each one's go as soon as it ends, not when the driver collects its garbage.

    For steps whose result is written: nothing reads their shuffles again, and a run of several steps then needs the disk
    of the largest, not of all together.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def staged(df, name: str):
    """``df`` written to the shared checkpoint folder and read back: computed once, lineage cut, lost executors survived.

    The write's shuffle files go when it ends; the table is in zstd, a third smaller than by Spark's default.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
