import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tejado.session import get_session
    s = get_session("local[4]", app="tejado-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tejado-test-ckpt-")})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect the named columns (or all) as plain tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def one_col(spark, values, expr_fn, dtype="string"):
    """Apply ``expr_fn(col)`` to a one-column table of ``values`` and return the results in order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]
