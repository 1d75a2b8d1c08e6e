"""Operator-level queries on the driver's tables: projections, filters, scalar keys,
windows, set operations, profiles and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tejado.catalog import register
from tejado.catalog.sqlfn import nt, num, pct, ustrip, with_ctes
from tejado.catalog.stock_queries import CTE_STOCK, STOCK, STOCK_VIEWS, sources
from tejado.functions.dates import as_timestamp, parse_timestamp
from tejado.functions.numbers import to_number, to_percent
from tejado.functions.text import norm_alnum, norm_text
from tejado.operators import aggregates as ag
from tejado.operators import columns as co
from tejado.operators import dedup as dd
from tejado.operators import filters as fl
from tejado.operators import setops as so
from tejado.plans import dashboard as db
from tejado.plans import stock as st
from tejado.plans.adapters import read_base, view
from tejado.plans.quality import MONEY_COLS


def base(spark, sf, name):
    return read_base(spark, sf, name)


# ---------------------------------------------------------------- projections
MESSY = ["P Partkey", " P-Name", "p.Brand", "P_Type", "P Size ", "P-RetailPrice"]


@register("prj01_normalize_names", "SELECT * FROM part")
def prj01(spark, sf):
    """PRJ-01: messy headers normalised (strip, lower, space/hyphen/dot -> _)."""
    return co.normalize_names(base(spark, sf, "part").toDF(*MESSY))


@register("prj02_ensure_columns", "SELECT *, CAST(NULL AS VARCHAR) AS cliente, CAST(NULL AS VARCHAR) AS email FROM customer")
def prj02(spark, sf):
    """PRJ-02: absent columns added as typed nulls."""
    return co.ensure_columns(base(spark, sf, "customer"), ["c_name", "cliente", "email"])


_MARK = ("CASE c_custkey % 6 WHEN 0 THEN 'None' WHEN 1 THEN 'nan' WHEN 2 THEN '<NA>' WHEN 3 THEN 'NaN' "
         "WHEN 4 THEN 'none' ELSE c_name END")


@register("prj10_missing_markers", f"""
SELECT c_custkey, CASE WHEN m IN ('<NA>', 'None', 'nan', 'NaN') THEN NULL ELSE m END AS c_name FROM (
  SELECT c_custkey, {_MARK} AS m FROM customer) q""")
def prj10(spark, sf):
    """PRJ-10: marker texts for missing values become null on string columns."""
    df = spark.sql(f"SELECT c_custkey, {_MARK} AS c_name FROM {{c}}", c=base(spark, sf, "customer"))
    return co.clean_missing_markers(df)


@register("prj04_coalesce_aliases", f"""
SELECT codigo, coalesce({num('precio_lista_actual')}, {num('precio_base_proforma')}) AS precio,
  coalesce({pct('descuento_actual')}, {num('monto_descuento')}) AS descuento FROM unidades""".join(
    [with_ctes(["unidades"], []), ""]))
def prj04(spark, sf):
    """PRJ-03/04/05: row-wise coalesce over the alias columns that exist (parsed); absent aliases skipped."""
    u = view(spark, sf, "unidades")
    return u.select("codigo", co.coalesce_columns(u, ["precio_de_lista_actual", "precio_lista_actual",
                                                      "precio_base_proforma"], to_number).alias("precio"),
                    F.coalesce(co.coalesce_columns(u, ["dscto", "descuento_actual"], to_percent),
                               to_number("monto_descuento")).alias("descuento"))


# ---------------------------------------------------------------- filters
FLT01 = {"o_orderstatus": ["F", "O"], "o_orderpriority": {"op": "contiene_ci", "valor": " URGENT"},
         "o_custkey": {"op": "no_en", "valores": [1, 2, 3]}, "o_totalprice": {"op": "no_vacio"}}


@register("flt01_declarative_filter", """
SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND contains(strip_accents(lower(trim(o_orderpriority))), 'urgent')
  AND NOT coalesce(o_custkey IN (1, 2, 3), false) AND o_totalprice IS NOT NULL""")
def flt01(spark, sf):
    """FLT-01..05: dict of conditions (list = IN, contiene_ci, no_en, no_vacio) folded into one filter."""
    return fl.declarative_filter(base(spark, sf, "orders"), FLT01)


@register("flt02_distinct_null", with_ctes(["unidades"], []) + """
SELECT * FROM unidades WHERE estado_comercial IS DISTINCT FROM 'Disponible'""")
def flt02(spark, sf):
    """FLT-02 (T-10): ``distinto`` keeps nulls (null is distinct from the value)."""
    return fl.declarative_filter(view(spark, sf, "unidades"), {"estado_comercial": {"op": "distinto", "valor": "Disponible"}})


@register("flt04_blank", with_ctes(["unidades"], []) + f"""
SELECT * FROM unidades WHERE nombre IS NULL OR {ustrip('nombre')} = ''""")
def flt04(spark, sf):
    """FLT-04: null, empty or whitespace-only."""
    return fl.declarative_filter(view(spark, sf, "unidades"), {"nombre": {"op": "vacio"}})


@register("flt05_case_accent_insensitive", with_ctes(["unidades"], []) + """
SELECT * FROM unidades WHERE strip_accents(lower(trim(coalesce(tipo_unidad, '')))) IN ('deposito', 'flat')
  AND contains(strip_accents(lower(trim(coalesce(estado_comercial, '')))), 'separacion')""")
def flt05(spark, sf):
    """FLT-05: en_ci and contiene_ci fold case and accents on both sides."""
    cond = {"tipo_unidad": {"op": "en_ci", "valores": ["DEPÓSITO", " flat"]},
            "estado_comercial": {"op": "contiene_ci", "valor": "SEPARACIÓN"}}
    return fl.declarative_filter(view(spark, sf, "unidades"), cond)


# ---------------------------------------------------------------- scalar keys over whole texts
@register("sc01_text_keys_documents", f"""
SELECT doc_id, {nt('text')} AS texto_norm,
  trim(regexp_replace(regexp_replace(coalesce({nt('text')}, ''), '[^A-Z0-9]+', ' ', 'g'), '\\s+', ' ', 'g')) AS texto_alnum
FROM documents""")
def sc01(spark, sf):
    """SC-01 + SC-03 over every document's whole text (NFKD fold, upper, collapsed whitespace)."""
    d = base(spark, sf, "documents")
    return d.select("doc_id", norm_text("text").alias("texto_norm"), norm_alnum("text").alias("texto_alnum"))


# Fixed values (test shaping): spellings of the order date, by key, as DuckDB and as Spark write them.
DATE_SPELLINGS = [
    ("%Y-%m-%d", "yyyy-MM-dd"), ("%d/%m/%Y", "dd/MM/yyyy"), ("%Y/%m/%d", "yyyy/MM/dd"), ("%Y-%m-%d %H:%M:%S", "yyyy-MM-dd HH:mm:ss"),
    ("%d/%m/%Y %I:%M %p", "dd/MM/yyyy hh:mm a"), ("%d/%m/%y", "dd/MM/yy"), ("%Y-%m", "yyyy-MM"), ("%d %b %Y", "d MMM yyyy"),
    ("%B %d, %Y", "MMMM d, yyyy"), ("%d-%m-%Y", "dd-MM-yyyy"), ("%Y%m%d", "yyyyMMdd"), ("%d.%m.%Y", "dd.MM.yyyy"),
]
DATE_WRITTEN = {"%d %b %Y": "%-d %b %Y", "%B %d, %Y": "%B %-d, %Y"}  # as DuckDB writes a day of one digit
_N = len(DATE_SPELLINGS) + 1
_AT = "(o_orderdate + to_minutes(o_orderkey % 1439))"
_DATE_TXT = (f"CASE o_orderkey % {_N} " + " ".join(f"WHEN {i} THEN strftime({_AT}, '{DATE_WRITTEN.get(f, f)}')" for i, (f, _) in enumerate(DATE_SPELLINGS))
             + " ELSE 'sin fecha' END")
_DATE_TXT_SPARK = (f"CASE o_orderkey % {_N} " + " ".join(f"WHEN {i} THEN date_format(o_orderdate + make_dt_interval(0, 0, o_orderkey % 1439), '{f}')"
                                                       for i, (_, f) in enumerate(DATE_SPELLINGS)) + " ELSE 'sin fecha' END")


@register("sc07_lenient_dates", "SELECT o_orderkey, t AS fecha_texto, coalesce(" + ", ".join(
    f"try_strptime(t, '{f}')" for f, _ in sorted(DATE_SPELLINGS, key=lambda x: "%y" not in x[0])) + f") AS fecha FROM (SELECT o_orderkey, {_DATE_TXT} AS t FROM orders) q")
def sc07(spark, sf):
    """SC-07: dates in a dozen spellings, every row read by its own; bad text -> null. Nobody says that the day comes first:
    the column's values do."""
    df = spark.sql(f"SELECT o_orderkey, {_DATE_TXT_SPARK} AS fecha_texto FROM {{o}}", o=base(spark, sf, "orders"))
    return df.withColumn("fecha", as_timestamp(df, "fecha_texto"))


@register("sc07_month_first", """
SELECT o_orderkey, o_orderdate AS fecha, CAST(true AS BOOLEAN) AS al_reves FROM orders""")
def sc07_month_first(spark, sf):
    """SC-07 for a column that writes the month first, and the same read with the wrong order given: days after the 12th
    come out right all the same."""
    df = spark.sql("SELECT o_orderkey, o_orderdate, date_format(o_orderdate, 'M/d/yyyy') AS t FROM {o}", o=base(spark, sf, "orders"))
    wrong = parse_timestamp(F.col("t"), dayfirst=True)
    return df.select("o_orderkey", as_timestamp(df, "t").alias("fecha"),
                     ((F.dayofmonth("o_orderdate") <= 12) | (wrong == F.col("o_orderdate"))).alias("al_reves"))


_NUM_TXT = ("CASE l_linenumber % 6 WHEN 0 THEN ' ' || CAST(l_quantity AS {t}) || ' ' WHEN 1 THEN CAST(l_quantity AS {t}) || 'd' "
            "WHEN 2 THEN '1e' || CAST(l_linenumber AS {t}) WHEN 3 THEN 'nan' WHEN 4 THEN '' "
            "ELSE CAST(CAST(l_quantity AS BIGINT) AS {t}) || '%' END")


@register("sc08_lenient_numbers", f"""
SELECT l_orderkey, l_linenumber, l_partkey, t AS texto, {num('t')} AS numero, {pct('t')} AS porcentaje FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, {_NUM_TXT.format(t='VARCHAR')} AS t FROM lineitem) q""")
def sc08(spark, sf):
    """SC-08 + SC-09: guarded number parsing ('12d', 'nan', '' -> null) and percent normalisation."""
    df = spark.sql(f"SELECT l_orderkey, l_linenumber, l_partkey, {_NUM_TXT.format(t='STRING')} AS texto FROM {{l}}",
                   l=base(spark, sf, "lineitem"))
    return df.select("*", to_number("texto").alias("numero"), to_percent("texto").alias("porcentaje"))


# ---------------------------------------------------------------- windows and order
@register("wd05_group_size", "SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS group_size FROM lineitem")
def wd05(spark, sf):
    """WD-05: size of each row's group (partial aggregate joined back, skew-safe)."""
    return dd.group_size(base(spark, sf, "lineitem"), ["l_orderkey"])


@register("wd01_keep_first", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) q WHERE rn = 1""")
def wd01(spark, sf):
    """WD-01: first line per part in a stated total order."""
    return dd.keep_first(base(spark, sf, "lineitem"), ["l_partkey"],
                         ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"])


@register("wd02_keep_last", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) q WHERE rn = 1""")
def wd02(spark, sf):
    """WD-02: last order per customer."""
    return dd.keep_last(base(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register("wd08_unique_labels", """
SELECT *, CASE WHEN rn = 1 THEN b ELSE substr(b, 1, 6 - length('_' || rn)) || '_' || rn END AS etiqueta FROM (
  SELECT n_nationkey, n_name, n_regionkey, b, row_number() OVER (PARTITION BY b ORDER BY n_nationkey) AS rn FROM (
    SELECT *, coalesce(nullif(substr(trim(regexp_replace(regexp_replace(coalesce(n_name, 'SIN_PROYECTO'),
      '[\\\\/*?:\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g')), 1, 6), ''), 'SIN_PROYECTO') AS b FROM nation) q) r""")
def wd08(spark, sf):
    """WD-08: safe labels cut to 6 characters; repeats get _2, _3 within the limit."""
    out = dd.unique_labels(base(spark, sf, "nation"), "n_name", "etiqueta", max_len=6, order_by=["n_nationkey"])
    return out.withColumn("b", F.substring(F.coalesce(F.nullif(F.substring(F.trim(F.regexp_replace(
        F.regexp_replace(F.coalesce("n_name", F.lit("SIN_PROYECTO")), r"[\\/*?:\[\]]", " "), r"\s+", " ")), 1, 6),
        F.lit("")), F.lit("SIN_PROYECTO")), 1, 100)).withColumn(
        "rn", F.row_number().over(__import__("pyspark.sql").sql.Window.partitionBy("b").orderBy("n_nationkey")))


# ---------------------------------------------------------------- set operations
@register("se01_union_by_name", """
SELECT o_orderkey, o_orderstatus, o_totalprice, NULL::TIMESTAMP AS o_orderdate, NULL::VARCHAR AS o_orderpriority
  FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_orderstatus, NULL, o_orderdate, NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, o_orderstatus, NULL, NULL, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def se01(spark, sf):
    """SE-01: pieces with unequal columns unioned by name (missing -> null)."""
    o = base(spark, sf, "orders")
    parts = [o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_totalprice"),
             o.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus", "o_orderdate"),
             o.where("o_orderstatus = 'P'").select("o_orderkey", "o_orderpriority", "o_orderstatus")]
    return so.union_by_name(parts)


SNAP_CUR = "o_orderdate >= TIMESTAMP '1997-01-01'"
SNAP_PREV = "o_orderdate < TIMESTAMP '2000-01-01'"


def _snaps(spark, sf):
    o = base(spark, sf, "orders")
    return o.where(SNAP_CUR), o.where(SNAP_PREV)


@register("se02_snapshot_new", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE {SNAP_CUR}
EXCEPT SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE {SNAP_PREV}""")
def se02_new(spark, sf):
    """SE-02: keys in the current snapshot and not in the previous (as text, distinct)."""
    cur, prev = _snaps(spark, sf)
    return so.snapshot_diff(cur, prev, ["o_orderkey"])[0]


@register("se02_snapshot_removed", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE {SNAP_PREV}
EXCEPT SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE {SNAP_CUR}""")
def se02_removed(spark, sf):
    cur, prev = _snaps(spark, sf)
    return so.snapshot_diff(cur, prev, ["o_orderkey"])[1]


@register("ag26_snapshot_counts", f"""
SELECT count(c.k) AS actuales, count(p.k) AS anteriores, count(*) FILTER (WHERE p.k IS NULL) AS nuevos,
  count(*) FILTER (WHERE c.k IS NULL) AS eliminados
FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE {SNAP_CUR}) c
FULL JOIN (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE {SNAP_PREV}) p ON c.k = p.k""")
def ag26(spark, sf):
    """AG-26: current, previous, new and removed key counts in one pass."""
    cur, prev = _snaps(spark, sf)
    return so.snapshot_counts(cur, prev, ["o_orderkey"])


# ---------------------------------------------------------------- profiles
_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
       "l_returnflag", "l_linestatus", "l_shipdate"]
_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
          "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
          "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
AG20 = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, '{_TYPES[c]}' AS tipo_python, count(*) AS filas, count({c}) AS no_nulos, "
    f"count(*) - count({c}) AS nulos, round((count(*) - count({c})) * 100.0 / count(*), 2) AS porcentaje_nulos, "
    f"count(DISTINCT {c}) AS valores_unicos, round(count(DISTINCT {c}) * 100.0 / count({c}), 2) AS porcentaje_unicos "
    f"FROM lineitem" for c in _LI)


@register("ag20_profile_lineitem", AG20)
def ag20(spark, sf):
    """AG-20: one scan and one unpivot over every column of lineitem, one row per column."""
    return ag.profile(base(spark, sf, "lineitem")).drop("ejemplo")


@register("ag14_value_combinations", """
SELECT l_returnflag, l_linestatus, count(*) AS cantidad FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2""")
def ag14(spark, sf):
    """AG-14: counts of value combinations (rows with a null dropped)."""
    return ag.value_counts(base(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], dropna=True)


_PROC_DATES = ["fecha_inicio", "fecha_fin"]
AG21 = with_ctes(["procesos"], []) + " UNION ALL ".join(
    f"SELECT '{c}' AS columna, 'timestamp_ntz' AS tipo_original, count(*) AS total_filas, count({c}) AS registros_con_dato, "
    f"count({c}) AS fechas_validas, 0::BIGINT AS fechas_invalidas, count(*) - count({c}) AS valores_nulos, "
    f"min({c}) AS fecha_inicio, max({c}) AS fecha_final, CAST(floor(epoch_us(max({c}) - min({c})) / 86400000000) AS INTEGER) "
    f"AS rango_dias FROM procesos" for c in _PROC_DATES)


@register("ag21_date_coverage", AG21)
def ag21(spark, sf):
    """AG-21: date coverage of every date-like column of the process table."""
    return ag.date_coverage(view(spark, sf, "procesos"))


@register("ag22_date_histogram", with_ctes(["procesos"], []) + " UNION ALL ".join(
    f"SELECT date_trunc('month', {c}) AS fecha, '{c}' AS columna, count(*) AS cantidad FROM procesos "
    f"WHERE {c} IS NOT NULL GROUP BY 1" for c in _PROC_DATES))
def ag22(spark, sf):
    """AG-22: monthly counts per date column."""
    return ag.date_histogram(view(spark, sf, "procesos"), freq="M")


@register("ag22_every_frequency", with_ctes(["procesos"], []) + " UNION ALL ".join(
    f"SELECT '{f}' AS frecuencia, date_trunc('{unit}', {c}) AS fecha, '{c}' AS columna, count(*) AS cantidad FROM procesos "
    f"WHERE {c} IS NOT NULL GROUP BY 2" for f, unit in ag.FREQUENCIES.items() for c in _PROC_DATES))
def ag22_every(spark, sf):
    """AG-22: counts per day, week, month, quarter and year."""
    parts = [ag.date_histogram(view(spark, sf, "procesos"), _PROC_DATES, freq=f).withColumn("frecuencia", F.lit(f)) for f in ag.FREQUENCIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("ag23_coverage_sentences", AG21.replace("SELECT '", "SELECT '", 1).join(["SELECT columna, "
    "CASE WHEN fecha_inicio IS NOT NULL AND fecha_final IS NOT NULL THEN 'En ''' || columna || ''', mi historia comienza el ' "
    "|| strftime(fecha_inicio, '%d/%m/%Y') || ' y termina el ' || strftime(fecha_final, '%d/%m/%Y') || '. Reconocí ' "
    "|| format('{:,}', fechas_validas) || ' fechas válidas, ' || format('{:,}', fechas_invalidas) || ' valores inválidos y ' "
    "|| format('{:,}', valores_nulos) || ' valores nulos.' ELSE columna || ': no pude encontrar un rango de fechas válido.' "
    "END AS historia FROM (", ") q"]))
def ag23(spark, sf):
    """AG-23: one coverage sentence per date column."""
    return ag.coverage_sentences(ag.date_coverage(view(spark, sf, "procesos")))


# ---------------------------------------------------------------- dashboard (JOB-18)
CTE_Q = CTE_STOCK + [("stock", STOCK)]


def _stock(spark, sf):
    return st.build_marts(sources(spark, sf))[2]


@register("ag09_stock_summary", with_ctes(STOCK_VIEWS, CTE_Q) + """
SELECT proyecto, estado_comercial, count(codigo) AS unidades,
  round(coalesce(sum(precio_de_lista_actual), 0), 2) AS valor_lista_actual FROM stock GROUP BY 1, 2""")
def ag09(spark, sf):
    """AG-09: units and list value per project × status."""
    return db.stock_summary(_stock(spark, sf))


@register("ag11_stock_kpis", with_ctes(STOCK_VIEWS, CTE_Q) + """
SELECT count(*) AS total_unidades, count(*) FILTER (WHERE estado_comercial = 'Disponible') AS disponibles,
  count(*) FILTER (WHERE estado_comercial = 'Vendido') AS vendidas,
  round(coalesce(sum(precio_de_lista_actual), 0), 2) AS valor_lista,
  round(coalesce(sum(precio_de_lista_actual) FILTER (WHERE estado_comercial = 'Disponible'), 0), 2) AS valor_disponible
FROM stock""")
def ag11(spark, sf):
    """AG-11: stock KPI row in one pass."""
    return db.stock_kpis(_stock(spark, sf))


@register("ag13_status_mix", with_ctes(STOCK_VIEWS, CTE_Q)
          + "SELECT estado_comercial, count(*) AS unidades FROM stock GROUP BY 1")
def ag13_status(spark, sf):
    return db.status_mix(_stock(spark, sf))


@register("prj03_first_existing", with_ctes(["unidades"], []) + """
SELECT codigo, tipo_unidad AS tipo, estado_comercial AS estado, CAST(NULL AS VARCHAR) AS ninguno FROM unidades""")
def prj03(spark, sf):
    """PRJ-03: of several columns the first that holds a value (the first candidate is all null; then one that isn't)."""
    u = view(spark, sf, "unidades").withColumn("tipo_de_unidad", F.lit(None).cast("string"))
    return u.select("codigo", co.first_existing(u, ["no_hay", "tipo_de_unidad", "tipo_unidad"]).alias("tipo"),
                    co.first_existing(u, ["estado_comercial", "tipo_unidad"]).alias("estado"),
                    co.first_existing(u, ["no_hay"]).alias("ninguno"))


def _number_text(c):
    return f"regexp_replace(CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR), '(\\.[0-9]+?)0+$', '\\1')"


_ROW_TEXT = "lower(concat_ws(' ', " + ", ".join(_number_text(c) if c in MONEY_COLS else c for c in st.STOCK_COLS) + "))"
_FACETS = "proyecto IS NOT NULL AND estado_comercial IN ('Disponible') AND tipo_de_unidad IN ('departamento dúplex', 'Estacionamiento Simple')"


def _faceted(spark, sf):
    return db.filter_stock(_stock(spark, sf), None, ["Disponible"], ["departamento dúplex", "Estacionamiento Simple"])


@register("flt11_facets_search", with_ctes(STOCK_VIEWS, CTE_Q) + f"SELECT * FROM stock WHERE {_FACETS} AND contains({_ROW_TEXT}, 'torre 2')")
def flt11(spark, sf):
    """FLT-11 + FLT-12: facets (all projects, one status, two types; null facets drop) then a literal search in every column."""
    return fl.search_rows(_faceted(spark, sf), "Torre 2")


@register("flt12_search_numbers", with_ctes(STOCK_VIEWS, CTE_Q) + f"SELECT * FROM stock WHERE contains({_ROW_TEXT}, '00.0')")
def flt12(spark, sf):
    """FLT-12: the searched text may stand in a number."""
    return fl.search_rows(_stock(spark, sf), "00.0")


@register("ag12_sales_kpis", with_ctes(STOCK_VIEWS, CTE_STOCK) + """
SELECT round(coalesce(sum(precio_venta), 0), 2) AS total_venta, count(*) AS items, count(DISTINCT proyecto) AS proyectos,
  count(DISTINCT dni_comprador) AS compradores FROM owners""")
def ag12(spark, sf):
    """AG-12: owners / sales KPI row."""
    s = st.silver(sources(spark, sf))
    return db.sales_kpis(st.owners(s))
