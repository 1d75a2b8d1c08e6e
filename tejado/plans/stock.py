"""Stock and owners marts: silver tables, owners, full stock, layered run (JOB-01..04).

One lazy plan per output. Shuffles: the keep-first/last steps (partial
``WindowGroupLimit`` before the exchange), the two aggregates of the process
facts (reservation, sale and co-owners of a proforma), and the joins onto the
item/unit facts; dimensions (projects, clients) are joined by key and sized at
run time by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tejado.functions.dates import as_timestamp
from tejado.functions.keys import doc_key
from tejado.functions.numbers import coalesce_numbers, coalesce_percents
from tejado.functions.rules import commercial_status, discount_amount, discount_pct, unit_type_stock
from tejado.functions.text import norm_text, unit_name
from tejado.functions.contacts import client_name
from tejado.operators.aggregates import first_non_null
from tejado.operators.arrays import ADD_RESERVATION, ADD_SALE, distinct_docs, explode_items
from tejado.operators.columns import clean_missing_markers, ensure_columns, first_existing
from tejado.operators.dedup import keep_first, keep_last, order_of
from tejado.operators.filters import active_if_any, stage_filter
from tejado.operators.joins import left_join_nonnull
from tejado.session import staged

# Column aliases read by the unit master (first existing value wins per row).
PURCHASE_LIST_PRICE = ["precio_base_proforma", "precio_lista_al_comprar", "precio_lista_compra",
                       "precio_lista_al_momento_compra", "precio_proforma", "precio_base"]
SALE_PRICE = ["precio_venta", "precio_de_venta", "precio_final", "precio_cierre", "precio_venta_final",
              "precio_con_descuento", "monto_venta"]
CURRENT_LIST_PRICE = ["precio_de_lista_actual", "precio_lista_actual", "precio_actual", "precio_publicado",
                      "precio_base_actual", "precio_lista_publicado", "precio_lista"]
DISCOUNT_PCT = ["descuento_actual", "dscto_actual", "descuento", "dscto", "porcentaje_descuento",
                "pct_descuento", "descuento_pct", "porc_descuento_actual"]
DISCOUNT_AMOUNT = ["monto_actual_dscto", "monto_actual_descuento", "monto_dscto_actual", "monto_descuento_actual",
                   "monto_descuento", "descuento_monto", "dscto_monto"]

# Output column order of the stock mart (20) and the owners mart (18).
STOCK_COLS = ["proyecto", "torre", "nombre", "tipo_de_unidad", "codigo", "estado_comercial_raw", "estado_comercial",
              "comprador", "dni_comprador", "copropietario_1", "dni_coprop_1", "copropietario_2", "dni_coprop_2",
              "copropietario_3", "dni_coprop_3", "precio_lista_al_comprar", "precio_venta", "precio_de_lista_actual",
              "descuento_actual", "monto_actual_dscto"]
OWNERS_COLS = ["proyecto", "tipo_de_unidad", "nombre", "codigo", "comprador", "dni_comprador", "copropietario_1",
               "dni_coprop_1", "copropietario_2", "dni_coprop_2", "copropietario_3", "dni_coprop_3",
               "precio_lista_al_comprar", "precio_venta", "codigo_proforma", "fecha_separacion", "fecha_minuta",
               "origen_item"]
# Display headers of the stock mart.
STOCK_HEADERS = {
    "proyecto": "Proyecto", "torre": "Torre", "nombre": "nombre", "tipo_de_unidad": "tipo de unidad",
    "codigo": "codigo", "estado_comercial_raw": "estado comercial", "estado_comercial": "Estado comercial",
    "comprador": "comprador", "dni_comprador": "dni comprador", "copropietario_1": "copropietario 1",
    "dni_coprop_1": "dni coprop 1", "copropietario_2": "copropietario 2", "dni_coprop_2": "dni coprop 2",
    "copropietario_3": "copropietario 3", "dni_coprop_3": "dni coprop 3",
    "precio_lista_al_comprar": "precio lista al comprar", "precio_venta": "precio venta",
    "precio_de_lista_actual": "Precio de lista Actual", "descuento_actual": "Descuento actual",
    "monto_actual_dscto": "Monto actual dscto",
}


def silver_units(unidades: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    """Unit master: aliases coalesced per row, type label, prices parsed; first row per code."""
    tipo = first_existing(unidades, ["tipo_de_unidad", "tipo_unidad"])
    estado = first_existing(unidades, ["estado_comercial", "estado"])
    unidades, order_col = order_of(unidades, order_col)
    u = ensure_columns(unidades, ["codigo", "nombre", "codigo_proyecto", "proyecto", "torre"])
    purchase = coalesce_numbers(u, PURCHASE_LIST_PRICE)
    out = u.select(
        F.col("codigo").cast("string").alias("codigo"),
        F.col("codigo").cast("string").alias("codigo_item"),
        F.col("codigo_proyecto").cast("string").alias("codigo_proyecto"),
        F.col("proyecto").cast("string").alias("proyecto_from_unidades"),
        F.col("torre").cast("string").alias("torre"),
        unit_name(F.col("nombre")).alias("nombre"),
        tipo.alias("tipo_de_unidad"),
        unit_type_stock(tipo).alias("tipo_de_unidad_norm"),
        estado.alias("estado_comercial_raw"),
        coalesce_numbers(u, SALE_PRICE).alias("precio_venta_unidad"),
        purchase.alias("precio_lista_al_comprar_unidad"),
        F.coalesce(coalesce_numbers(u, CURRENT_LIST_PRICE), purchase).alias("precio_de_lista_actual"),
        coalesce_percents(u, DISCOUNT_PCT).alias("descuento_actual_raw"),
        coalesce_numbers(u, DISCOUNT_AMOUNT).alias("monto_actual_dscto_raw"),
        F.col(order_col).alias("__ord"),
    )
    return keep_first(clean_missing_markers(out), ["codigo"], "__ord").drop("__ord")


def silver_projects(proyectos: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    """Projects: the first row per code, in file order."""
    proyectos, order_col = order_of(proyectos, order_col)
    p = ensure_columns(proyectos, ["codigo", "nombre"])
    out = p.select(F.col("codigo").cast("string").alias("codigo_proyecto"),
                   F.col("nombre").cast("string").alias("proyecto"),
                   norm_text(F.col("nombre")).alias("proyecto_norm"), F.col(order_col).alias("__ord"))
    return keep_first(out, ["codigo_proyecto"], "__ord").drop("__ord")


def silver_clients(clientes: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    clientes, order_col = order_of(clientes, order_col)
    c = ensure_columns(clientes, ["documento", "nombres", "apellidos", "cliente"])
    out = c.select(F.col("documento").cast("string").alias("documento_cliente"),
                   doc_key(F.col("documento")).alias("dni_comprador"),
                   client_name(F.col("cliente"), F.col("nombres"), F.col("apellidos")).alias("comprador"),
                   F.col(order_col).alias("__ord"))
    return keep_first(out, ["documento_cliente"], "__ord").drop("__ord")


def silver_reservations(procesos: DataFrame, order_col: str = "id_proceso") -> DataFrame:
    """Reservations (active only if any is active), last row per proforma."""
    procesos, order_col = order_of(procesos, order_col)
    p = ensure_columns(procesos, ["fecha_inicio", "codigo_proforma", "documento_cliente", "codigo_unidad",
                                  "codigo_proyecto", "estado", "tipo_financiamiento", "codigo_unidades_asignadas",
                                  "nombre"])
    sep = active_if_any(stage_filter(p, "SEPARACION"))
    out = sep.select(as_timestamp(p, "fecha_inicio").alias("fecha_separacion"),
                     F.col("codigo_proforma").cast("string").alias("codigo_proforma"),
                     F.col("documento_cliente").cast("string").alias("documento_cliente"),
                     F.col("codigo_unidad").cast("string").alias("codigo_principal"),
                     F.col("codigo_proyecto").cast("string").alias("codigo_proyecto"),
                     F.col("tipo_financiamiento").cast("string").alias("tipo_financiamiento"),
                     F.col("codigo_unidades_asignadas").cast("string").alias("adicionales_sep_raw"),
                     F.col(order_col).alias("__ord"))
    return keep_last(out, ["codigo_proforma"], "__ord").drop("__ord")


def silver_sales(procesos: DataFrame, order_col: str = "id_proceso") -> DataFrame:
    """AG-01: per proforma, last signing date and first non-null packed list (partial aggregation)."""
    procesos, order_col = order_of(procesos, order_col)
    p = ensure_columns(procesos, ["fecha_fin", "codigo_proforma", "codigo_unidades_asignadas", "nombre"])
    ven = stage_filter(p, "VENTA")
    return (ven.groupBy(F.col("codigo_proforma").cast("string").alias("codigo_proforma"))
               .agg(F.max(as_timestamp(p, "fecha_fin")).alias("fecha_minuta"),
                    first_non_null(F.col("codigo_unidades_asignadas").cast("string"),
                                   F.col(order_col)).alias("adicionales_ven_raw")))


def client_names_by_doc(clientes: DataFrame, order_col: str = "orden_fila") -> DataFrame:
    """JN-08 dictionary as a table: normalised document -> client name, first row per document."""
    clientes, order_col = order_of(clientes, order_col)
    c = ensure_columns(clientes, ["documento", "nombres", "apellidos", "cliente"])
    t = c.select(doc_key(F.col("documento")).alias("doc_key"),
                 client_name(F.col("cliente"), F.col("nombres"), F.col("apellidos")).alias("nombre_doc"),
                 F.col(order_col).alias("__ord")).where(F.col("doc_key").isNotNull())
    return keep_first(t, ["doc_key"], "__ord").drop("__ord")


COOWNERS = [f"{c}_{i}" for i in (1, 2, 3) for c in ("copropietario", "dni_coprop")]


def process_facts(procesos: DataFrame, clientes: DataFrame, order_col: str = "id_proceso", in_steps: bool = False) -> DataFrame:
    """Reservations, sales and co-owners of a proforma in one row, from one pass over the processes.

    A process row becomes its facts and up to three co-owner documents (AR-02: co-owners column, then spouse, distinct, in
    list order). Grouped by (proforma, slot, document), pre-aggregated before the shuffle, that leaves the last reservation,
    the last active one, the sale's date and packed list (AG-01, AG-02), and every distinct document of a slot once with
    its first place. Names are looked up for those (JN-08); the second grouping, by proforma, takes the first document
    and the first name of each slot (AG-08).

    Which reservation counts depends on whether any in the table is active (FLT-08): a scalar subquery that reads stage,
    status and proforma only. Columns: those of the silver reservations, sales and co-owners, ``usuario_separacion``,
    ``con_separacion`` and ``con_venta``. ``in_steps``: the first grouping is written, so that its shuffle is off the disk when
    names are looked up, and only the thin rows of documents are dealt out for that.
    """
    procesos, order_col = order_of(procesos, order_col)
    p = ensure_columns(procesos, ["fecha_inicio", "fecha_fin", "codigo_proforma", "documento_cliente", "codigo_unidad",
                                  "codigo_proyecto", "estado", "tipo_financiamiento", "codigo_unidades_asignadas", "nombre",
                                  "usuario_separacion", "usuario", "asesor", "documento_copropietarios", "documento_conyuge"])
    p = p.where(F.col("codigo_proforma").isNotNull())
    text = lambda c: F.col(c).cast("string")
    active = F.coalesce(norm_text(F.col("estado")) == "ACTIVO", F.lit(False))
    stage = norm_text(F.col("nombre"))
    some_active = p.agg(F.coalesce(F.max((stage == "SEPARACION") & active), F.lit(False))).scalar()
    docs = distinct_docs([F.col("documento_copropietarios"), F.col("documento_conyuge")], doc_key)
    slots = F.concat(F.array(F.struct(F.lit(0).alias("slot"), F.lit(None).cast("string").alias("doc"))),
                     F.transform(F.slice(docs, 1, 3), lambda x, i: F.struct((i + 1).alias("slot"), x.alias("doc"))))
    rows = p.select(
        text("codigo_proforma").alias("codigo_proforma"), F.col(order_col).alias("__ord"), stage.alias("__etapa"), active.alias("__activa"),
        as_timestamp(p, "fecha_fin").alias("__fin"), text("codigo_unidades_asignadas").alias("__packed"),
        F.struct(as_timestamp(p, "fecha_inicio").alias("fecha_separacion"), text("documento_cliente").alias("documento_cliente"),
                 text("codigo_unidad").alias("codigo_principal"), text("codigo_proyecto").alias("codigo_proyecto"),
                 text("tipo_financiamiento").alias("tipo_financiamiento"), text("codigo_unidades_asignadas").alias("adicionales_sep_raw"),
                 F.coalesce("usuario_separacion", "usuario", "asesor").cast("string").alias("usuario_separacion")).alias("__sep"),
        F.explode(slots).alias("__s"))
    fact = F.col("__s.slot") == 0
    is_sep, is_sale = fact & (F.col("__etapa") == "SEPARACION"), F.coalesce(fact & (F.col("__etapa") == "VENTA"), F.lit(False))
    rows = rows.select("codigo_proforma", F.col("__s.slot").alias("__slot"), F.col("__s.doc").alias("doc_key"), "__ord", "__activa",
                       is_sep.alias("__is_sep"), is_sale.alias("__is_sale"),
                       *[F.when(of, F.col(c)).alias(c) for c, of in (("__sep", is_sep), ("__fin", is_sale), ("__packed", is_sale))])  # rows of documents stay thin
    found = rows.groupBy("codigo_proforma", "__slot", "doc_key").agg(
        F.max_by("__sep", F.when(F.col("__is_sep"), F.col("__ord"))).alias("__any"),
        F.max_by("__sep", F.when(F.col("__is_sep") & F.col("__activa"), F.col("__ord"))).alias("__active"),
        F.max("__fin").alias("fecha_minuta"),
        first_non_null("__packed", F.when(F.col("__is_sale"), F.col("__ord"))).alias("adicionales_ven_raw"),
        F.max("__is_sale").alias("con_venta"), F.min("__ord").alias("__first"))
    found = found.withColumn("__r", F.when(some_active, F.col("__active")).otherwise(F.col("__any"))).drop("__any", "__active")
    names = client_names_by_doc(clientes)
    if in_steps:
        found = staged(found, "process-facts")
        thin = found.where("__slot > 0").select("codigo_proforma", "__slot", "doc_key", "__first")
        named = left_join_nonnull(thin, names, "doc_key", ["codigo_proforma", "__slot"])
        named = found.where("__slot = 0").unionByName(named, allowMissingColumns=True)  # slot 0 has the facts and no document
    else:
        named = left_join_nonnull(found, names, "doc_key", ["codigo_proforma", "__slot"])
    at = lambda i: F.when(F.col("__slot") == i, F.col("__first"))
    pairs = [(first_non_null("nombre_doc", at(i)), first_non_null("doc_key", at(i))) for i in (1, 2, 3)]
    one = named.groupBy("codigo_proforma").agg(  # only a proforma's row of slot 0 has facts
        F.first("__r", ignorenulls=True).alias("__r"), F.max("fecha_minuta").alias("fecha_minuta"), F.max("adicionales_ven_raw").alias("adicionales_ven_raw"),
        F.max("con_venta").alias("con_venta"), *[x.alias(n) for n, x in zip(COOWNERS, [x for pair in pairs for x in pair])])
    return one.select("codigo_proforma", "__r.*", "fecha_minuta", "adicionales_ven_raw", "con_venta", F.col("__r").isNotNull().alias("con_separacion"), *COOWNERS)


def silver_coowners(procesos: DataFrame, clientes: DataFrame, order_col: str = "id_proceso") -> DataFrame:
    """AR-02 + AG-08: up to three co-owners per proforma, slot by slot: the co-owner columns of the process facts."""
    return process_facts(procesos, clientes, order_col).select("codigo_proforma", *COOWNERS)


def silver(sources: dict[str, DataFrame], in_steps: bool = False) -> dict[str, DataFrame]:
    """JOB-01: the six silver tables, and the process facts that three of them are columns of (``in_steps``: see there)."""
    facts = process_facts(sources["procesos"], sources["clientes"], in_steps=in_steps)
    return {
        "silver_unidades": silver_units(sources["unidades"]),
        "silver_proyectos": silver_projects(sources["proyectos"]),
        "silver_clientes": silver_clients(sources["clientes"]),
        **silver_of_facts(facts),
    }


def silver_of_facts(facts: DataFrame) -> dict[str, DataFrame]:
    """The process facts (lazy, or as written) and the silver tables made of their columns."""
    return {
        "procesos_por_proforma": facts,
        "silver_separaciones": facts.where("con_separacion").select(
            "fecha_separacion", "codigo_proforma", "documento_cliente", "codigo_principal", "codigo_proyecto",
            "tipo_financiamiento", "adicionales_sep_raw"),
        "silver_ventas": facts.where("con_venta").select("codigo_proforma", "fecha_minuta", "adicionales_ven_raw"),
        "silver_copropietarios": facts.select("codigo_proforma", *COOWNERS),
    }


def owners(s: dict[str, DataFrame]) -> DataFrame:
    """JOB-02: one row per (unit, proforma) of every signed sale."""
    facts = s.get("procesos_por_proforma")
    base = (facts.where("con_separacion AND con_venta") if facts is not None
            else s["silver_separaciones"].join(s["silver_ventas"], on="codigo_proforma", how="inner")
            .join(s["silver_copropietarios"], on="codigo_proforma", how="left"))
    common = ["documento_cliente", "codigo_proyecto", "fecha_separacion", "fecha_minuta", "tipo_financiamiento", *COOWNERS]
    codes = explode_items(base, "codigo_principal",
                          [("adicionales_sep_raw", ADD_RESERVATION), ("adicionales_ven_raw", ADD_SALE)], common)
    uni = s["silver_unidades"].withColumnRenamed("codigo_proyecto", "codigo_proyecto_unidad")
    df = codes.join(uni, on="codigo_item", how="left")
    df = df.withColumn("codigo_proyecto", F.coalesce("codigo_proyecto", "codigo_proyecto_unidad"))
    df = df.join(s["silver_proyectos"], on="codigo_proyecto", how="left")
    df = df.withColumn("proyecto", F.coalesce("proyecto", "proyecto_from_unidades"))
    df = left_join_nonnull(df, s["silver_clientes"], "documento_cliente", ["codigo_proforma", "codigo_item"], blank_matches=True)
    df = df.select(
        "*",
        unit_name(F.col("nombre"), F.col("codigo_item")).alias("__nombre"),
        F.coalesce("tipo_de_unidad", "tipo_de_unidad_norm").alias("__tipo"),
        F.col("precio_lista_al_comprar_unidad").alias("precio_lista_al_comprar"),
        F.col("precio_venta_unidad").alias("precio_venta"),
    ).drop("nombre", "tipo_de_unidad").withColumnsRenamed({"__nombre": "nombre", "__tipo": "tipo_de_unidad"})
    # codes are ordered by (proforma, item, origin); "last" per (unit, proforma) = greatest item
    last = keep_last(df, ["codigo", "codigo_proforma"], ["codigo_item", "origen_item"])
    return clean_missing_markers(last.select(*OWNERS_COLS))


OWNER_COLS_FOR_STOCK = ["codigo", "comprador", "dni_comprador", "copropietario_1", "dni_coprop_1", "copropietario_2",
                        "dni_coprop_2", "copropietario_3", "dni_coprop_3", "precio_venta"]


STOCK_ORDER = ["proyecto", "tipo_de_unidad", "nombre", "codigo"]


def stock(s: dict[str, DataFrame], owners_df: DataFrame) -> DataFrame:
    """JOB-03: every unit, its owner if sold, commercial status and discount waterfall. Unsorted: see :func:`sorted_stock`."""
    st = s["silver_unidades"].join(s["silver_proyectos"], on="codigo_proyecto", how="left")
    st = st.select("*", F.coalesce("proyecto", "proyecto_from_unidades").alias("__p"),
                   F.coalesce("tipo_de_unidad", "tipo_de_unidad_norm").alias("__t"),
                   F.col("precio_lista_al_comprar_unidad").alias("precio_lista_al_comprar"))
    st = st.drop("proyecto", "tipo_de_unidad").withColumnsRenamed({"__p": "proyecto", "__t": "tipo_de_unidad"})
    # owners rows come ordered by (proforma, item): last per unit = greatest proforma text
    one = keep_last(owners_df.where(F.col("codigo").isNotNull()), ["codigo"], ["codigo_proforma"])
    df = st.join(one.select(*OWNER_COLS_FOR_STOCK), on="codigo", how="left")
    has_owner = F.col("comprador").isNotNull() | F.col("dni_comprador").isNotNull() | F.col("precio_venta").isNotNull()
    pct = discount_pct(F.col("descuento_actual_raw"), F.col("monto_actual_dscto_raw"),
                       F.col("precio_de_lista_actual"), F.col("tipo_de_unidad"))
    df = df.select("*", commercial_status(has_owner, F.col("estado_comercial_raw")).alias("estado_comercial"),
                   pct.alias("descuento_actual"))
    df = df.withColumn("monto_actual_dscto", discount_amount(F.col("monto_actual_dscto_raw"),
                                                             F.col("precio_de_lista_actual"), F.col("descuento_actual")))
    return clean_missing_markers(df.select(*STOCK_COLS))


def sorted_stock(stock_df: DataFrame) -> DataFrame:
    """SO-01, for the sink: the stock mart in display order."""
    return stock_df.orderBy(*[F.col(c).asc_nulls_last() for c in STOCK_ORDER])


def build_marts(sources: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    s = silver(sources)
    own = owners(s)
    return s, own, stock(s, own)
