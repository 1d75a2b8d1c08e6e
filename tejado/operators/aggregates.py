"""Aggregate expressions and one-pass profiles (AG-02..05, AG-13/14, AG-20..23).

Every helper is an aggregate ``Column`` for ``groupBy().agg`` or a whole
``DataFrame -> DataFrame`` that makes one aggregation pass and unpivots the
single result row; no per-column jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.functions._util import col_of
from tejado.functions.text import has_text, ustrip


def first_non_null(x, order) -> Column:
    """AG-02: value of the row with the smallest ``order`` among rows where ``x`` is not null."""
    x = col_of(x)
    return F.min_by(x, F.when(x.isNotNull(), col_of(order)))


def first_non_blank(x, order) -> Column:
    """AG-03: like AG-02 but blank strings are skipped too."""
    x = col_of(x)
    return F.min_by(x, F.when(has_text(x), col_of(order)))


def join_unique(x, sep: str = " | ") -> Column:
    """AG-04: distinct stripped texts, sorted, joined; none -> null.

    ``collect_set`` de-duplicates map-side, so the buffer holds distinct values only.
    """
    t = ustrip(col_of(x).cast("string"))
    vals = F.collect_set(F.when(t != "", t))
    return F.nullif(F.array_join(F.array_sort(vals), sep), F.lit(""))


def concat_unique_first_seen(df: DataFrame, keys: list[str], x: str, order: str, out: str,
                             sep: str = " | ") -> DataFrame:
    """AG-05: distinct stripped texts in first-seen order, joined.

    Two steps keep groups bounded by their distinct values: (key, text) -> first
    position with a partial aggregate, then one sorted list per key.
    """
    t = ustrip(F.col(x).cast("string"))
    firsts = (df.where(t.isNotNull() & (t != ""))
                .groupBy(*keys, t.alias("__v")).agg(F.min(order).alias("__o")))
    lists = firsts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__o", "__v"))).alias("__l"))
    return lists.select(*keys, F.nullif(F.array_join(F.col("__l.__v"), sep), F.lit("")).alias(out))


def sum_zero(x) -> Column:
    """Sum where all-null gives 0, like pandas (T-03)."""
    return F.coalesce(F.sum(col_of(x)), F.lit(0.0))


def value_counts(df: DataFrame, cols: list[str], dropna: bool = False, out: str = "cantidad") -> DataFrame:
    """AG-13 (``dropna=False``: null is a group) and AG-14 (``dropna=True``: rows with a null dropped)."""
    src = df.dropna(subset=cols) if dropna else df
    return src.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def _unpivot_slots(field: T.StructField) -> tuple[dict[str, Column], Column]:
    """How a column's values stand in the unpivoted table, where equal values stay equal and others differ: as a whole
    number ``l``, a double ``d`` or a text ``s``; and the value's text, made from that."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    whole, real, text = F.col("l"), F.col("d"), F.col("s")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return {"l": c.cast("long")}, whole.cast("string")
    if isinstance(kind, T.BooleanType):
        return {"l": c.cast("long")}, (whole == 1).cast("string")
    if isinstance(kind, T.DateType):
        return {"l": F.unix_date(c).cast("long")}, F.date_from_unix_date(whole.cast("int")).cast("string")
    if isinstance(kind, T.TimestampType):
        return {"l": F.unix_micros(c)}, F.timestamp_micros(whole).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return {"d": c.cast("double")}, real.cast(kind).cast("string")
    if isinstance(kind, T.BinaryType):
        return {"s": F.hex(c)}, F.unhex(text).cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return {"s": F.to_json(F.struct(c))}, F.get_json_object(text, "$." + field.name)
    return {"s": c.cast("string")}, text


def profile(df: DataFrame, order: str | None = None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """AG-20: one row per column: variable, tipo_python, filas, no_nulos, nulos, porcentaje_nulos,
    valores_unicos, porcentaje_unicos (of the non-null values), ejemplo (first non-null in ``order``,
    else the smallest value as text); the columns with most nulls first, then those with fewest values.

    One scan: every row is unpivoted to (column, value), which the tasks count before the shuffle; the values are dealt
    by column and value, so a column of many values is spread over all tasks, and then counted per column.
    ``approx=True`` counts distinct values by HyperLogLog instead, without a shuffle of values.
    """
    cols = [f for f in df.schema if f.name != order]
    names = df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(cols)], "__i int, variable string, tipo_python string")
    found = _profile_approx(df, cols, order, rsd) if approx else _profile_exact(df, cols, order)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    long = names.join(found, "__i", "left").select("__i", "variable", "tipo_python", zero("filas"), zero("no_nulos"), zero("valores_unicos"), "ejemplo")
    nulls = F.col("filas") - F.col("no_nulos")
    out = long.select(
        "__i", "variable", "tipo_python", "filas", "no_nulos", nulls.alias("nulos"),
        F.when(F.col("filas") > 0, F.round(nulls * 100.0 / F.col("filas"), 2)).otherwise(F.lit(0.0))
         .alias("porcentaje_nulos"),
        "valores_unicos",
        F.when(F.col("no_nulos") > 0, F.round(F.col("valores_unicos") * 100.0 / F.col("no_nulos"), 2))
         .otherwise(F.lit(0.0)).alias("porcentaje_unicos"),
        "ejemplo")
    return out.orderBy(F.desc("porcentaje_nulos"), "valores_unicos", "__i").drop("__i")


def _profile_exact(df: DataFrame, cols: list[T.StructField], order: str | None) -> DataFrame:
    """__i, filas, no_nulos, valores_unicos, ejemplo."""
    slots = [_unpivot_slots(f) for f in cols]
    kinds = {"l": "long", "d": "double", "s": "string"}
    place = [F.col(f"`{order}`").alias("__ord")] if order else []
    wide = df.select(*place, *[at.get(k, F.lit(None).cast(kind)).alias(f"{k}{i}") for i, (at, _) in enumerate(slots) for k, kind in kinds.items()])
    sets = ", ".join(f"(l{i}, d{i}, s{i}) AS `{i}`" for i in range(len(cols)))
    tall = df.sparkSession.sql(f"SELECT * FROM {{w}} UNPIVOT INCLUDE NULLS ((l, d, s) FOR __c IN ({sets}))", w=wide)
    first = [F.min("__ord").alias("__first")] if order else []
    values = tall.groupBy("__c", "l", "d", "s").agg(F.count(F.lit(1)).alias("n"), *first)
    there = F.col("l").isNotNull() | F.col("d").isNotNull() | F.col("s").isNotNull()
    text = F.when(F.col("__c") == "0", slots[0][1]) if slots else F.lit(None)
    for i, (_, shown) in enumerate(slots[1:], 1):
        text = text.when(F.col("__c") == str(i), shown)
    text = F.when(there, text)
    example = F.min_by(text, F.when(there, F.col("__first"))) if order else F.min(text)
    return values.groupBy(F.col("__c").cast("int").alias("__i")).agg(
        F.sum("n").alias("filas"), F.sum(F.when(there, F.col("n"))).alias("no_nulos"), F.count_if(there).alias("valores_unicos"), example.alias("ejemplo"))


def _profile_approx(df: DataFrame, cols: list[T.StructField], order: str | None, rsd: float) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(cols):
        col = F.col(f"`{f.name}`")
        example = first_non_null(col.cast("string"), order) if order else F.min(col.cast("string"))
        aggs += [F.count(col).alias(f"n{i}"), F.approx_count_distinct(col, rsd).alias(f"d{i}"), example.alias(f"e{i}")]
    structs = [F.struct(F.lit(i).alias("__i"), F.col(f"n{i}").alias("no_nulos"), F.col(f"d{i}").alias("valores_unicos"), F.col(f"e{i}").alias("ejemplo"))
               for i in range(len(cols))]
    return df.agg(*aggs).select(F.col("__rows").alias("filas"), F.explode(F.array(*structs)).alias("s")).select("filas", "s.*")


def date_like_columns(df: DataFrame, word: str = "fecha") -> list[str]:
    return [f.name for f in df.schema.fields
            if word in f.name.lower() or isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]


def date_coverage(df: DataFrame, cols: list[str] | None = None, dayfirst: bool = True) -> DataFrame:
    """AG-21: per date-like column: rows, with data, valid, invalid, null, first, last, span in days.

    One aggregation pass, then one row per column (sort by ``fecha_inicio``, nulls last, at the sink).
    """
    from tejado.functions.dates import as_timestamp
    cols = cols if cols is not None else date_like_columns(df)
    schema = ("columna string, tipo_original string, total_filas long, registros_con_dato long, fechas_validas long, "
              "fechas_invalidas long, valores_nulos long, fecha_inicio timestamp_ntz, fecha_final timestamp_ntz, "
              "rango_dias int")
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        ts = as_timestamp(df, c, dayfirst)
        aggs += [F.count(F.col(f"`{c}`")).alias(f"f{i}"), F.count(ts).alias(f"v{i}"),
                 F.min(ts).alias(f"lo{i}"), F.max(ts).alias(f"hi{i}")]
    one = df.agg(*aggs)
    dtypes = dict(df.dtypes)
    structs = [F.struct(F.lit(c).alias("columna"), F.lit(dtypes[c]).alias("tipo_original"),
                        F.col(f"f{i}").alias("registros_con_dato"), F.col(f"v{i}").alias("fechas_validas"),
                        F.col(f"lo{i}").alias("fecha_inicio"), F.col(f"hi{i}").alias("fecha_final"))
               for i, c in enumerate(cols)]
    long = one.select(F.col("__rows").alias("total_filas"), F.explode(F.array(*structs)).alias("s")) \
              .select("total_filas", "s.*")
    return long.select(
        "columna", "tipo_original", "total_filas", "registros_con_dato", "fechas_validas",
        (F.col("registros_con_dato") - F.col("fechas_validas")).alias("fechas_invalidas"),
        (F.col("total_filas") - F.col("registros_con_dato")).alias("valores_nulos"),
        "fecha_inicio", "fecha_final",
        # whole days between the wall-clock values, independent of the session time zone
        F.timestamp_diff("DAY", F.col("fecha_inicio"), F.col("fecha_final")).cast("int").alias("rango_dias"))


# Histogram frequencies and the Spark truncation unit for each.
FREQUENCIES = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}


def date_histogram(df: DataFrame, cols: list[str] | None = None, freq: str = "M", dayfirst: bool = True) -> DataFrame:
    """AG-22: counts per period start per date column (unpivot -> truncate -> count)."""
    from tejado.functions.dates import as_timestamp
    cols = cols if cols is not None else date_like_columns(df)
    unit = FREQUENCIES[freq.upper()]
    structs = [F.struct(F.lit(c).alias("columna"), as_timestamp(df, c, dayfirst).alias("ts")) for c in cols]
    long = df.select(F.explode(F.array(*structs)).alias("s")).select("s.*").where(F.col("ts").isNotNull())
    return (long.groupBy(F.date_trunc(unit, F.col("ts")).cast("timestamp_ntz").alias("fecha"), "columna")
                .agg(F.count(F.lit(1)).alias("cantidad")))


def coverage_sentences(coverage: DataFrame) -> DataFrame:
    """AG-23: one sentence per column from AG-21 output (start, end, valid / invalid / null)."""
    ok = F.col("fecha_inicio").isNotNull() & F.col("fecha_final").isNotNull()
    txt = F.when(ok, F.format_string(
        "En '%s', mi historia comienza el %s y termina el %s. Reconocí %,d fechas válidas, %,d valores inválidos "
        "y %,d valores nulos.", F.col("columna"), F.date_format("fecha_inicio", "dd/MM/yyyy"),
        F.date_format("fecha_final", "dd/MM/yyyy"), F.col("fechas_validas"), F.col("fechas_invalidas"),
        F.col("valores_nulos"))).otherwise(
        F.format_string("%s: no pude encontrar un rango de fechas válido.", F.col("columna")))
    return coverage.select("columna", txt.alias("historia"))
