"""Adapter views: the driver's TPC-H-like tables shaped like the domain tables.

Each view is one SQL template rendered for two dialects: Spark SQL (run with
``spark.sql(text, **dataframes)``, so Catalyst still prunes and pushes filters
into the parquet scans) and DuckDB (the oracle side). Both engines therefore
see identical inputs; the operators under test run on the Spark side through
the DataFrame API.

Every view reads whole tables. Modulo expressions on keys only *shape values*
(which rows get a blank, a typo, a null); no view filters rows by key, so the
work grows with the data. All row-wise views are narrow (no shuffle); only
``procesos`` aggregates line items per order (partial aggregation first) and
``proyectos`` groups the brands.
"""

from __future__ import annotations

import weakref
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@dataclass(frozen=True)
class Dialect:
    name: str

    def s(self, x: str) -> str:
        return f"CAST({x} AS {'STRING' if self.name == 'spark' else 'VARCHAR'})"

    def pad(self, x: str, n: int) -> str:
        """Left pad with zeros, never truncating."""
        v = self.s(x)
        return f"(CASE WHEN length({v}) < {n} THEN lpad({v}, {n}, '0') ELSE {v} END)"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def gen(self, n: int, alias: str) -> str:
        """A lateral generator of 0..n-1 (row multiplication without a join)."""
        vals = ", ".join(str(i) for i in range(n))
        if self.name == "spark":
            return f"LATERAL VIEW explode(array({vals})) {alias}_t AS {alias}"
        return f"CROSS JOIN (SELECT unnest([{vals}]) AS {alias}) {alias}_t"

    def t(self, name: str) -> str:
        return "{" + name + "}" if self.name == "spark" else name


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


# Fixed values (test shaping): unit-type text per TPC-H part type.
def _type_text(d: Dialect, ptype: str, key: str | None) -> str:
    flat = "'Departamento Flat'" if key is None else f"(CASE WHEN {key} % 2 = 0 THEN 'FLAT' ELSE 'Departamento Flat' END)"
    return (f"(CASE {ptype} WHEN 'ECONOMY' THEN {flat} WHEN 'MEDIUM' THEN 'departamento dúplex' "
            f"WHEN 'SMALL' THEN 'Estacionamiento Simple' WHEN 'LARGE' THEN 'Depósito' "
            f"WHEN 'STANDARD' THEN 'Cochera doble' ELSE 'Local Comercial' END)")


def unidades(d: Dialect) -> str:
    k = "p_partkey"
    cents = "CAST(round(p_retailprice * 110) AS BIGINT)"
    price_txt = f"({d.s(d.idiv(cents, '100'))} || '.' || lpad({d.s(cents + ' % 100')}, 2, '0'))"
    return f"""
SELECT
  'U-' || {d.s(k)} AS codigo,
  CASE {k} % 4 WHEN 0 THEN 'A' || {d.s('p_size')}
               WHEN 1 THEN 'E-' || {d.s('p_size')} || ' B0' || {d.s(k + ' % 10')}
               WHEN 2 THEN 'D-' || {d.s('p_size')}
               ELSE CASE WHEN {k} % 8 = 7 THEN NULL ELSE '  ' END END AS nombre,
  {_type_text(d, 'p_type', k)} AS tipo_unidad,
  CASE WHEN {k} % 97 = 0 THEN NULL ELSE p_brand END AS codigo_proyecto,
  'Proyecto ' || p_brand AS proyecto,
  'Torre ' || {d.s('1 + ' + k + ' % 3')} AS torre,
  CASE {k} % 6 WHEN 0 THEN 'Disponible' WHEN 1 THEN 'VENDIDO' WHEN 2 THEN 'En separación'
               WHEN 3 THEN 'Libre' WHEN 4 THEN NULL ELSE 'No disponible' END AS estado_comercial,
  CASE WHEN {k} % 5 = 0 THEN NULL ELSE p_retailprice END AS precio_base_proforma,
  CASE WHEN {k} % 3 = 0 THEN NULL WHEN {k} % 11 = 0 THEN 'n/d' ELSE {price_txt} END AS precio_lista_actual,
  CASE {k} % 7 WHEN 0 THEN '8%' WHEN 1 THEN '0,05' WHEN 2 THEN '0.1' ELSE NULL END AS descuento_actual,
  CASE WHEN {k} % 13 = 0 THEN CAST(10.0 AS DOUBLE) ELSE NULL END AS monto_descuento,
  p_retailprice - CAST(45.0 AS DOUBLE) AS precio_venta,
  {k} AS orden_fila
FROM {d.t('part')}"""


def proyectos(d: Dialect) -> str:
    # one brand has another code, so unit and process rows with an unknown project exist; every code comes a second
    # time, later in the file and with a name that sorts before the first
    return f"""
SELECT CASE WHEN p_brand = 'Brand#7' THEN 'Brand#7 (antiguo)' ELSE p_brand END AS codigo,
  CASE WHEN g = 0 THEN 'Edificio Módena ' || p_brand ELSE 'Anterior ' || p_brand END AS nombre,
  k * 2 + g AS orden_fila
FROM (SELECT p_brand, min(p_partkey) AS k FROM {d.t('part')} GROUP BY p_brand) b
{d.gen(2, 'g')}"""


def clientes(d: Dialect) -> str:
    k = "c_custkey"
    ape = ("(CASE c_mktsegment WHEN 'BUILDING' THEN 'Núñez' WHEN 'AUTOMOBILE' THEN 'Peña' "
           "WHEN 'MACHINERY' THEN 'Quispe' WHEN 'FURNITURE' THEN 'Ramírez' ELSE 'García' END)")
    return f"""
SELECT
  {d.pad(k, 8)} || CASE WHEN {k} % 10 = 0 THEN '.0' ELSE '' END AS documento,
  'Cliente ' || {d.s(k)} AS nombres,
  {ape} AS apellidos,
  CASE {k} % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'CLIENTE ' || {d.s(k)} || ' ' || {ape} END AS cliente,
  CASE {k} % 4 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'Web' WHEN 2 THEN 'Referido' ELSE NULL END AS medio_captacion,
  CASE {k} % 4 WHEN 0 THEN '+51 9' || {d.pad(k, 8)} WHEN 1 THEN '0051 9' || {d.pad(k, 8)}
               WHEN 2 THEN {d.pad(k, 6)} ELSE NULL END AS celulares,
  '(01) ' || {d.s('4000000 + ' + k)} AS telefono,
  CASE {k} % 6 WHEN 0 THEN 'cliente' || {d.s(k)} || '@gmail.com'
               WHEN 1 THEN ' Cliente' || {d.s(k)} || ' @Gmial.com'
               WHEN 2 THEN 'cli,' || {d.s(k)} || '@hotmial.com'
               WHEN 3 THEN CASE WHEN {k} % 4 = 3 THEN 'c..' || {d.s(k)} || '.@gmaill.com' ELSE 'c' || {d.s(k)} || '@outlook.es' END
               WHEN 4 THEN NULL
               ELSE 'sin-arroba-' || {d.s(k)} END AS email,
  CASE WHEN {k} % 2 = 0 THEN 'Propietario' ELSE 'Prospecto' END AS estado,
  {k} AS orden_fila
FROM {d.t('customer')}"""


def procesos(d: Dialect) -> str:
    k, ck = "o.o_orderkey", "o.o_custkey"
    brand = f"'Brand#' || {d.s('1 + ' + ck + ' % 25')}"
    packed_sep = (f"CASE WHEN li.pmax IS NULL OR li.pmax = li.pmin THEN NULL "
                  f"ELSE 'U-' || {d.s('li.pmax')} || CASE {k} % 4 WHEN 0 THEN '' WHEN 1 THEN ', NONE' "
                  f"WHEN 2 THEN ' ; U-' || {d.s('li.pmin')} ELSE '|  ' END END")
    packed_ven = f"CASE WHEN li.pmin IS NULL THEN NULL ELSE 'U-' || {d.s('li.pmin')} || ',U-' || {d.s('li.pmax')} END"
    coprop = (f"CASE {k} % 5 WHEN 0 THEN NULL WHEN 1 THEN {d.pad(ck + ' + 1', 8)} "
              f"WHEN 2 THEN {d.pad(ck + ' + 1', 8)} || ';' || {d.pad(ck + ' + 2', 8)} "
              f"WHEN 3 THEN {d.pad(ck + ' + 2', 8)} || '.0; ' || {d.pad(ck + ' + 3', 8)} || '|' || {d.pad(ck + ' + 4', 8)} "
              f"ELSE '' END")
    return f"""
SELECT
  {k} * 4 + g AS id_proceso,
  CASE WHEN g IN (0, 3) THEN CASE {k} % 3 WHEN 0 THEN 'Separación' WHEN 1 THEN 'SEPARACION' ELSE ' separacion ' END
       ELSE CASE {k} % 2 WHEN 0 THEN 'Venta' ELSE 'VENTA ' END END AS nombre,
  CASE WHEN o.o_orderstatus = 'P' THEN 'Anulado' ELSE 'Activo' END AS estado,
  'PF-' || {d.s(k)} AS codigo_proforma,
  CASE WHEN g = 3 THEN {d.pad(ck + ' + 1', 8)} ELSE {d.pad(ck, 8)} END AS documento_cliente,
  CASE WHEN li.pmin IS NULL THEN NULL ELSE 'U-' || {d.s('li.pmin')} END AS codigo_unidad,
  CASE WHEN g IN (0, 3) THEN {packed_sep} WHEN g = 1 THEN NULL ELSE {packed_ven} END AS codigo_unidades_asignadas,
  CASE WHEN {k} % 7 = 0 THEN NULL ELSE {brand} END AS codigo_proyecto,
  'Edificio Módena ' || {brand} AS nombre_proyecto,
  CASE WHEN li.pmin IS NULL THEN NULL ELSE {_type_text(d, 'p.p_type', None)} END AS tipo_unidad_principal,
  o.o_orderdate AS fecha_inicio,
  CASE WHEN g IN (0, 3) THEN NULL WHEN g = 1 THEN li.ship_min ELSE li.ship_max END AS fecha_fin,
  CASE WHEN {k} % 11 IN (0, 1) THEN NULL ELSE 'asesor' || {d.s('1 + ' + ck + ' % 9')} END AS usuario_separacion,
  CASE WHEN {k} % 11 = 1 THEN 'usuario' || {d.s('1 + ' + ck + ' % 5')} ELSE NULL END AS usuario,
  CASE WHEN {k} % 17 = 0 THEN NULL WHEN {k} % 13 = 0 THEN '  '
       ELSE 'Asesor ' || {d.s('1 + ' + ck + ' % 9')} END AS asesor,
  'Asesor ' || {d.s('1 + ' + ck + ' % 9')} AS nombres_usuario,
  CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Contado' WHEN '2' THEN 'Crédito hipotecario'
       WHEN '3' THEN 'Techo Propio' WHEN '4' THEN 'Mivivienda' ELSE NULL END AS tipo_financiamiento,
  {coprop} AS documento_copropietarios,
  CASE WHEN {k} % 3 = 0 THEN {d.pad(ck + ' + 1', 8)} ELSE NULL END AS documento_conyuge
FROM {d.t('orders')} o
LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS pmin, max(l_partkey) AS pmax,
                  min(l_shipdate) AS ship_min, max(l_shipdate) AS ship_max
           FROM {d.t('lineitem')} GROUP BY l_orderkey) li ON li.l_orderkey = {k}
LEFT JOIN {d.t('part')} p ON p.p_partkey = li.pmin
{d.gen(4, 'g')}
WHERE g = 0 OR (g IN (1, 2) AND o.o_orderstatus = 'F') OR (g = 3 AND {k} % 10 = 3)"""


def leads(d: Dialect) -> str:
    k, u = "event_id", "user_id"
    return f"""
SELECT
  CASE WHEN {k} % 4 = 0 THEN ' ' || event_type || ' ' ELSE event_type END AS proyecto,
  ts AS fecha_registro,
  'Lead ' || {d.s(u)} AS nombre,
  {d.pad(u, 8)} || CASE WHEN {k} % 7 = 0 THEN ' ' ELSE '' END AS documento,
  CASE {u} % 5 WHEN 0 THEN 'user' || {d.s(u)} || '@gmail.com' WHEN 1 THEN 'User' || {d.s(u)} || '@Hotmail.com '
               WHEN 2 THEN 'user' || {d.s(u)} || 'gmail.com' WHEN 3 THEN NULL
               ELSE 'u' || {d.s(u)} || '@yahoo.es' END AS correo,
  CASE {k} % 4 WHEN 0 THEN '9' || {d.pad(u, 8)} WHEN 1 THEN '+51 9' || {d.pad(u, 8)}
               WHEN 2 THEN {d.pad(u, 7)} ELSE NULL END AS telefono,
  CASE {k} % 9 WHEN 0 THEN 'No perfil' WHEN 1 THEN 'Contactado' WHEN 2 THEN NULL WHEN 3 THEN 'No contesta'
               WHEN 4 THEN 'no respondió' WHEN 5 THEN 'En seguimiento' WHEN 6 THEN 'NO CALIFICA'
               WHEN 7 THEN 'Interesado' ELSE 'Sin presupuesto' END AS estado_lead,
  CASE {k} % 5 WHEN 0 THEN 'no califica' WHEN 1 THEN 'No alcanza cuota inicial' WHEN 2 THEN NULL
               WHEN 3 THEN 'Sin respuesta' ELSE 'Llamar después' END AS observacion,
  {k} AS orden_fila
FROM {d.t('events')}"""


def _series(d: Dialect, k: str) -> str:
    return f"(CASE WHEN {k} % 2 = 0 THEN 'F' ELSE 'B' END || {d.pad(k + ' % 7', 3)})"


def ledger(d: Dialect) -> str:
    k, ln = "l_orderkey", "l_linenumber"
    ser = _series(d, k)
    return f"""
SELECT
  CASE {ln} % 5 WHEN 0 THEN {ser} || '-' || {d.s(k)} WHEN 1 THEN ' '
               ELSE '01-' || {ser} || '-' || {d.pad(k, 8)} END AS nro_comprobante,
  CASE l_suppkey % 5 WHEN 0 THEN 'VENTA URSA 2026.xlsx' WHEN 1 THEN 'tablon_10_DE_ABRIL.parquet'
               WHEN 2 THEN 'Tablon LYNX marzo.csv' WHEN 3 THEN 'data/tablones/tablon_cygnus_2026.parquet'
               ELSE NULL END AS source_file,
  'tablon_' || {d.s(ln + ' % 3')} || '.parquet' AS tablon_file,
  l_orderkey, l_linenumber, l_partkey, l_extendedprice AS monto
FROM {d.t('lineitem')}"""


def master(d: Dialect) -> str:
    k = "o_orderkey"
    ser = _series(d, k)
    return f"""
SELECT
  {ser} || '-' || {d.s(k)} AS id_comprobante,
  CASE WHEN {k} % 9 = 0 THEN NULL WHEN dup = 1 THEN ''
       ELSE CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'DEPARTAMENTO' WHEN '2' THEN 'ESTACIONAMIENTO'
            WHEN '3' THEN 'DEPOSITO' ELSE 'DEPARTAMENTO + ESTACIONAMIENTO' END END AS tipos_unidad,
  CASE WHEN {k} % 6 = 0 THEN NULL
       ELSE CASE o_orderstatus WHEN 'F' THEN 'DPTO' WHEN 'O' THEN 'EST' ELSE 'DEP' END END AS u1_tipo,
  CASE WHEN {k} % 4 = 0 OR dup = 1 THEN NULL ELSE {d.s('100 + ' + k + ' % 900')} END AS u1_n,
  'Proyecto Brand#' || {d.s('1 + o_custkey % 25')} AS proyecto,
  o_orderpriority AS concepto,
  CASE WHEN {k} % 5 = 0 THEN ' ' ELSE 'Estado ' || o_orderstatus END AS estado_proyecto,
  CASE WHEN dup = 1 THEN NULL ELSE 'Venta de ' || {d.s(k)} END AS descripcion_xml,
  CASE {k} % 4 WHEN 0 THEN 'URSA' WHEN 1 THEN '10_DE_ABRIL' WHEN 2 THEN 'LYNX' ELSE 'CYGNUS' END AS company,
  'MAESTRO_COMPROBANTES_' || CASE {k} % 4 WHEN 0 THEN 'URSA' WHEN 1 THEN '10_DE_ABRIL' WHEN 2 THEN 'LYNX'
       ELSE 'CYGNUS' END || '.xlsx' AS master_file,
  CASE WHEN dup = 1 THEN 'Hoja2' ELSE 'Hoja1' END AS hoja,
  {k} * 2 + dup AS orden_fila
FROM {d.t('orders')}
{d.gen(2, 'dup')}
WHERE dup = 0 OR {k} % 50 = 0"""


def entregas(d: Dialect) -> str:
    """Delivery list 1 (DNI, buyer, unit type, unit number) from customers and their same-key part."""
    k = "c.c_custkey"
    return f"""
SELECT
  CASE {k} % 4 WHEN 0 THEN {d.pad(k, 8)} || '.0' WHEN 1 THEN {d.s(k)}
               WHEN 2 THEN '1' || {d.pad(k, 8)} ELSE ' ' || {d.pad(k, 8)} END AS dni,
  c.c_name AS comprador,
  {_type_text(d, 'p.p_type', None)} AS tipo_unidad,
  {d.s('p.p_size')} || CASE WHEN {k} % 3 = 0 THEN '.0' ELSE '' END AS numero_unidad,
  {k} AS orden_fila
FROM {d.t('customer')} c
JOIN {d.t('part')} p ON p.p_partkey = {k}"""


def entregas_proceso(d: Dialect) -> str:
    """Delivery list 2 (type, unit number) from parts."""
    k = "p_partkey"
    return f"""
SELECT
  CASE p_type WHEN 'SMALL' THEN 'Estacionamiento' WHEN 'STANDARD' THEN ' estacionamiento '
              WHEN 'LARGE' THEN 'Deposito' ELSE 'Departamento' END AS tipo,
  {d.s(k)} || CASE WHEN {k} % 2 = 0 THEN '.0' ELSE '' END AS numero_unidad,
  {k} AS orden_fila
FROM {d.t('part')}"""


VIEWS = {
    "unidades": (unidades, ["part"]),
    "proyectos": (proyectos, ["part"]),
    "clientes": (clientes, ["customer"]),
    "procesos": (procesos, ["orders", "lineitem", "part"]),
    "leads": (leads, ["events"]),
    "ledger": (ledger, ["lineitem"]),
    "master": (master, ["orders"]),
    "entregas": (entregas, ["customer", "part"]),
    "entregas_proceso": (entregas_proceso, ["part"]),
}


_PLANS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()  # by session, so a stopped one's frames go with it


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; the (lazy) DataFrame is reused within a session to skip repeated file listing."""
    plans, key = _PLANS.setdefault(spark, {}), (sf_dir.rstrip("/"), name)
    if key not in plans:
        plans[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return plans[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view on Spark, lazily planned over the base parquet tables."""
    plans, key = _PLANS.setdefault(spark, {}), (sf_dir.rstrip("/"), "view:" + name)
    if key not in plans:
        fn, deps = VIEWS[name]
        frames = {t: read_base(spark, sf_dir, t) for t in deps}
        plans[key] = spark.sql(fn(SPARK), **frames)
    return plans[key]


def duck_cte(*names: str) -> str:
    """``WITH`` clause text defining the named views for the DuckDB oracle."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][0](DUCK)})" for n in names) + "\n"
