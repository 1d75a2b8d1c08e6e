"""Keyed de-duplication, group sizes and ordered slots (WD-01..08).

"First" and "last" in the reference mean file row order, which Spark does not
have (T-01): every operator here takes an explicit order. ``row_number() == 1``
plans as a ``WindowGroupLimit`` on both sides of the shuffle, so each map task
forwards at most one row per key: a hot key costs one row per task, not a third
of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.functions._util import col_of
from tejado.session import staged


def _orders(order_by, descending: bool) -> list[Column]:
    cols = [col_of(c) for c in (order_by if isinstance(order_by, (list, tuple)) else [order_by])]
    return [c.desc_nulls_first() if descending else c.asc_nulls_last() for c in cols]


def keep_first(df: DataFrame, keys: list[str], order_by, _desc: bool = False) -> DataFrame:
    """WD-01: first row per key in ``order_by`` order (null keys form one group, like pandas)."""
    w = Window.partitionBy(*keys).orderBy(*_orders(order_by, _desc))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def keep_last(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """WD-02: last row per key in ``order_by`` order."""
    return keep_first(df, keys, order_by, _desc=True)


def group_size(df: DataFrame, keys: list[str], out: str = "group_size") -> DataFrame:
    """WD-05: size of each row's group.

    Counted with a partial aggregate and joined back, instead of a window over
    the key: the window would put a hot key's rows in one task; the aggregate
    combines map-side and AQE splits a skewed side of the join.
    """
    renamed = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    counts = df.groupBy(*renamed).agg(F.count(F.lit(1)).alias(out))
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return df.join(counts, on=cond, how="left").drop(*[f"__k{i}" for i in range(len(keys))])


#: Column in which a written layer keeps its rows' order in the files they came from.
ROW_ORDER = "_row_order"


def straight_from_files(df: DataFrame) -> bool:
    """Whether ``df`` is one scan of files with nothing but column choices and filters on top."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def with_file_order(df: DataFrame, out: str = "row_order") -> DataFrame:
    """WD-06: where each row stands in the files: a struct of file path, start of the split and place, in that order.

    Parquet tells a row's index in its file. Of other formats (CSV, JSON, ORC) the place is a number that grows within
    the split, so a row's key depends on how files are split, the order of the keys does not. Only for a table read
    straight from files: after a shuffle the rows of a split no longer follow each other, so anything else raises.
    """
    if not straight_from_files(df):
        raise ValueError(f"the table isn't read straight from files; its row order is unknown (columns: {', '.join(df.columns)})")
    block, place = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    if "row_index" in df.select("_metadata").schema["_metadata"].dataType.names:
        block, place = F.lit(0).cast("long"), F.col("_metadata.row_index")
    return df.withColumn(out, F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), place.alias("place")))


def order_of(df: DataFrame, order_col: str) -> tuple[DataFrame, str]:
    """``df`` with its row order, and that column's name: ``order_col`` if present, else the order that its layer carries
    (``ROW_ORDER``), else the order in its files.

    A table that has none of these has no "first" or "last" row, so this raises.
    """
    if order_col in df.columns:
        return df, order_col
    if ROW_ORDER in df.columns:
        return df, ROW_ORDER
    return with_file_order(df, order_col), order_col


def row_positions(df: DataFrame, order_by: list, out: str = "position") -> DataFrame:
    """SO-01, SO-02: each row's place (from 0) in ``order_by`` order, as a column.

    ``order_by``: column names (ascending, nulls last) and sort expressions. Rows are dealt to ranges and sorted there; equal keys are told apart by a hash of the row, so a hot key is split over
    ranges too. The sorted table is written once; a row's place is its place in the range plus the rows of the ranges
    before. Only the number of rows per range (one per shuffle partition) reaches the driver; no task sees the whole table.
    """
    spark = df.sparkSession
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)])
    order = [*(F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by), F.col("__tie").asc()]
    sorted_ = df.withColumn("__tie", tie).repartitionByRange(*order).sortWithinPartitions(*order)
    table = staged(sorted_.withColumn("__id", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("__id", 33)
    rows = table.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")).orderBy("__part").collect()  # one row per shuffle partition
    starts, before = [], 0
    for r in rows:
        starts.append((r["__part"], before))
        before += r["n"]
    offsets = spark.createDataFrame(starts, "__part long, __start long")
    placed = table.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return placed.select(*[f"`{c}`" for c in df.columns], (F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).alias(out))


def unique_labels(df: DataFrame, col: str, out: str, max_len: int = 31, default: str = "SIN_PROYECTO",
                  order_by=None) -> DataFrame:
    """WD-08: sanitised label; one that is taken gets ``_2``, ``_3``... within ``max_len`` characters.

    Rows choose in ``order_by`` order (default: the raw value): the first of base, base_2, base_3... that no earlier row
    has. A row starts at its place among the rows of one base (the labels before are theirs). While a label is claimed
    by several rows, the first keeps it and the others go on to their next; a round looks at the labels claimed anew only.

    ``df`` is computed once, into a written table; the rounds work on a thin table of claims. For tables of one row per label.
    """
    base = F.regexp_replace(F.coalesce(col_of(col).cast("string"), F.lit(default)), r"[\\/*?:\[\]]", " ")
    base = F.substring(F.trim(F.regexp_replace(base, r"\s+", " ")), 1, max_len)
    base = F.coalesce(F.nullif(base, F.lit("")), F.lit(default))
    order = _orders(order_by or [col], False)
    suffix = F.concat(F.lit("_"), F.col("__n").cast("string"))
    label = F.when(F.col("__n") == 1, F.col("__base")).otherwise(
        F.concat(F.col("__base").substr(F.lit(1), F.lit(max_len) - F.length(suffix)), suffix))
    placed = df.withColumn("__base", base).withColumn("__n", F.row_number().over(Window.partitionBy("__base").orderBy(*order)))
    rows = staged(row_positions(placed, [*order, "__n"], "__turn"), "labels-rows")  # the order as a number
    held = staged(rows.select("__turn", "__base", "__n").withColumn("__label", label), "labels-held")
    first = Window.partitionBy("__label").orderBy("__turn")
    claims = held
    while True:
        among = held if claims is held else held.join(claims.select("__label").distinct(), "__label", "left_semi")
        ranked = among.withColumn("__place", F.row_number().over(first))
        lost = staged(ranked.where("__place > 1").select("__turn", "__base", (F.col("__n") + 1).alias("__n")).withColumn("__label", label), "labels-lost")
        if lost.isEmpty():
            break
        claims = lost
        held = staged(held.join(lost.select("__turn"), "__turn", "left_anti").unionByName(lost), "labels-held")
    return rows.join(held.select("__turn", F.col("__label").alias(out)), "__turn").drop("__base", "__n", "__turn")
