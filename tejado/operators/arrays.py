"""Array operators: packed lists to rows and ordered slots (AR-01..04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.functions.text import split_codes, ustrip

# Item origin labels (their alphabetical order is the keep priority, T-14).
PRINCIPAL = "PRINCIPAL"
ADD_RESERVATION = "ADICIONAL_SEPARACION"
ADD_SALE = "ADICIONAL_VENTA"


def _tagger(label: str):
    return lambda x: F.struct(x.alias("i"), F.lit(label).alias("o"))


def explode_items(base: DataFrame, principal: str, packed: list[tuple[str, str]], keep: list[str],
                  separators: str = ",;|", item_col: str = "codigo_item", origin_col: str = "origen_item",
                  key: str = "codigo_proforma", order: str | None = None) -> DataFrame:
    """AR-01 + WD-03: main unit first, then each packed list with its label; one row per (key, item).

    Row-wise ``explode`` (no shuffle). Of equal (key, item) the alphabetically first origin stays and, of equal origins,
    the first row in ``order`` with its ``keep`` columns, by one ``groupBy(key, item)``. ``order`` may be left out only where
    ``base`` has one row per key; then all that can be equal stands in one row, and its lists are reduced before the
    ``explode``: no sort, no grouping.
    """
    p = ustrip(F.col(principal).cast("string"))
    main = F.when(p.isNotNull() & (p != ""), F.array(p)).otherwise(F.array().cast("array<string>"))
    lists = sorted([(PRINCIPAL, main), *((label, split_codes(F.col(col), separators)) for col, label in packed)], key=lambda x: x[0])
    if not order:
        return _explode_rows(base, lists, keep, item_col, origin_col, key)
    parts = [F.transform(items, _tagger(label)) for label, items in lists]
    items = base.select(key, *keep, F.col(order).alias("__ord"), F.explode(F.concat(*parts)).alias("__it"))
    items = items.select(key, *keep, "__ord", F.col("__it.i").alias(item_col), F.col("__it.o").alias(origin_col))
    rank = F.struct(origin_col, "__ord")
    first = items.groupBy(key, item_col).agg(F.min_by(F.struct(origin_col, *keep), rank).alias("__first"))
    return first.select(key, item_col, *[F.col(f"__first.{c}").alias(c) for c in (*keep, origin_col)])


def _explode_rows(base: DataFrame, lists: list[tuple[str, Column]], keep: list[str], item_col: str, origin_col: str, key: str) -> DataFrame:
    """The items of each row, once each, under the first of the labels that has them; lists in the labels' order."""
    names = [f"__l{i}" for i in range(len(lists))]
    made = base.select(key, *keep, *[items.alias(n) for n, (_, items) in zip(names, lists)])  # each list is split once
    parts, before = [], None
    for name, (label, _) in zip(names, lists):
        new = F.array_distinct(F.col(name)) if before is None else F.array_except(F.col(name), before)
        before = F.col(name) if before is None else F.concat(before, F.col(name))
        parts.append(F.transform(new, _tagger(label)))
    items = made.select(key, *keep, F.explode(F.concat(*parts)).alias("__it"))
    return items.select(key, F.col("__it.i").alias(item_col), *keep, F.col("__it.o").alias(origin_col))


def distinct_docs(cols: list[Column], normalize) -> Column:
    """AR-02 helper: normalised documents from several packed columns, nulls dropped, distinct in order."""
    arrays = [F.transform(split_codes(c), normalize) for c in cols]
    return F.array_distinct(F.filter(F.concat(*arrays), lambda x: x.isNotNull()))


def counts_map(df: DataFrame, key: str, count_col: str = "cantidad") -> DataFrame:
    """AR-04: one-row ``map<key, count>`` of a small grouped table."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.col(count_col))))
                  .alias("por_" + key))
