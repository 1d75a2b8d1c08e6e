"""Business rules as ordered ``F.when`` chains (SC-11, SC-13, SC-24, SC-26, SC-29, SC-30, SC-32, SC-33, SC-37)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tejado.functions._util import col_of, null_str
from tejado.functions.text import norm_compare, norm_text, upper_fixed_accents, ustrip

# Bare unit-type words that mean a flat.
FLAT_WORDS = ["FLAT", "DUPLEX", "TRIPLEX"]


def _is_flat(norm: Column) -> Column:
    return norm.contains("DEPARTAMENTO") | norm.isin(*FLAT_WORDS)


def unit_type_stock(c) -> Column:
    """SC-11a: labels for the stock mart; unknown types keep their lower-cased text."""
    n = norm_text(c)
    raw = F.lower(ustrip(col_of(c).cast("string")))
    return (F.when(n.isNull(), null_str())
            .when(_is_flat(n), F.when(n == "FLAT", F.lit("departamento flat")).otherwise(F.lit("departamento")))
            .when(n.startswith("ESTACIONAMIENTO") | n.contains("COCHERA"), F.lit("estacionamiento"))
            .when(n.contains("DEPOSITO"), F.lit("depósito"))
            .otherwise(raw))


def unit_type_sales(c) -> Column:
    """SC-11b: labels for the sales catalogue; unknown types keep the SC-01 text."""
    n = norm_text(c)
    return (F.when(n.isNull(), null_str())
            .when(_is_flat(n), F.lit("DEPARTAMENTO"))
            .when(n.startswith("ESTACIONAMIENTO") | n.contains("COCHERA"), F.lit("ESTACIONAMIENTO"))
            .when(n.contains("DEPOSITO"), F.lit("DEPÓSITO"))
            .otherwise(n))


# Prefix -> group for process unit types, first match wins.
PROCESS_TYPE_PREFIXES = [
    ("departamento", "departamento"),
    ("estacionamiento", "estacionamiento"),
    ("cochera", "estacionamiento"),
    ("deposito", "deposito"),
    ("local comercial", "local comercial"),
]


def unit_type_process(c, prefixes=None) -> Column:
    """SC-11c: SC-02 text, prefix rules in order, else ``otro``."""
    n = norm_compare(c)
    expr = None
    for prefix, group in (prefixes or PROCESS_TYPE_PREFIXES):
        cond = n.startswith(prefix)
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.lit("otro"))


# Receivables categories.
FLAT_TYPES_EXACT = ["DEPARTAMENTO FLAT", "DEPARTAMENTO DUPLEX", "DEPARTAMENTO TRIPLEX"]


def receivable_category(type_norm) -> Column:
    """SC-11d: exact flat types -> DEPA, ESTACIONAMIENTO prefix -> ESTAC, DEPOSITO -> DEPO, else OTRO."""
    t = F.coalesce(col_of(type_norm), F.lit(""))
    return (F.when(t.isin(*FLAT_TYPES_EXACT), F.lit("DEPA"))
            .when(t.startswith("ESTACIONAMIENTO"), F.lit("ESTAC"))
            .when(t == "DEPOSITO", F.lit("DEPO"))
            .otherwise(F.lit("OTRO")))


def unit_number(nombre, codigo, tipo) -> Column:
    """SC-13: flats keep the full name; other units the last digit run, else the full text."""
    raw = ustrip(F.coalesce(col_of(nombre), col_of(codigo)).cast("string"))
    runs = F.regexp_extract_all(raw, F.lit(r"(\d+)"), 1)
    n = F.coalesce(norm_text(tipo), F.lit(""))
    last = F.when(F.size(runs) > 0, F.element_at(runs, -1)).otherwise(raw)
    return (F.when(raw.isNull() | (raw == ""), null_str())
            .when(_is_flat(n), raw)
            .otherwise(last))


# Exclusion reasons and the phrases that trigger them, in priority order.
EXCLUSION_RULES = [
    ("NO perfil", ["NO PERFIL", "SIN PERFIL", "NO CALZA PERFIL"]),
    ("No alcanza cuota", ["NO ALCANZA CUOTA", "NO CALIFICA", "NO CALIFICO", "NO APTO", "NO SUJETO",
                          "NO CUMPLE CUOTA"]),
    ("No respondió", ["NO RESPONDIO", "NO RESPONDE", "NO CONTACTADO", "NO CONTESTA", "NO CONTESTO",
                      "SIN RESPUESTA", "NO UBICADO"]),
]


def exclusion_reason(estado, observacion, rules=None) -> Column:
    """SC-24: reason from status + note (SC-04 text); no phrase -> null."""
    text = F.concat(upper_fixed_accents(estado), F.lit(" "), upper_fixed_accents(observacion))
    expr = None
    for reason, phrases in (rules or EXCLUSION_RULES):
        cond = F.lit(False)
        for p in phrases:
            cond = cond | text.contains(p)
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr.otherwise(null_str())


# Contact-state labels.
CONTACT_OK = "OK: correo y teléfono"
CONTACT_NO_EMAIL = "Falta correo"
CONTACT_NO_PHONE = "Falta teléfono"
CONTACT_NONE = "Falta correo y teléfono"


def contact_state(has_email, has_phone) -> Column:
    """SC-26: four labels from the two flags."""
    e, p = col_of(has_email), col_of(has_phone)
    return (F.when(e & p, F.lit(CONTACT_OK))
            .when(~e & p, F.lit(CONTACT_NO_EMAIL))
            .when(e & ~p, F.lit(CONTACT_NO_PHONE))
            .otherwise(F.lit(CONTACT_NONE)))


def commercial_status(has_owner, raw_status) -> Column:
    """SC-29: owner -> Vendido; else DISP/LIBRE/STOCK -> Disponible (it overrides the next rule);
    else VEND/SEPAR/MINUTA/PROCESO DE VENTA -> Vendido; default Disponible."""
    n = norm_text(raw_status)
    disp = F.coalesce(n.rlike("DISP|LIBRE|STOCK"), F.lit(False))
    vend = F.coalesce(n.rlike("VEND|SEPAR|MINUTA|PROCESO DE VENTA"), F.lit(False))
    return (F.when(col_of(has_owner), F.lit("Vendido"))
            .when(disp, F.lit("Disponible"))
            .when(vend, F.lit("Vendido"))
            .otherwise(F.lit("Disponible")))


# Default discount for flats when nothing else is known.
DEFAULT_FLAT_DISCOUNT = 0.08


def discount_pct(pct_raw, amount_raw, list_price, unit_type) -> Column:
    """SC-30: source %, else amount / list, else 8 % for flats and 0 otherwise; null without list price."""
    from_amount = F.try_divide(col_of(amount_raw), col_of(list_price))
    default = F.when(F.coalesce(F.lower(col_of(unit_type)).contains("departamento"), F.lit(False)),
                     F.lit(DEFAULT_FLAT_DISCOUNT)).otherwise(F.lit(0.0))
    pct = F.coalesce(col_of(pct_raw), from_amount, default)
    return F.when(col_of(list_price).isNull(), F.lit(None).cast("double")).otherwise(pct)


def discount_amount(amount_raw, list_price, pct) -> Column:
    """SC-30: source amount, else list × %."""
    return F.coalesce(col_of(amount_raw), col_of(list_price) * col_of(pct))


def operation_status(fecha_minuta) -> Column:
    """SC-32."""
    return F.when(col_of(fecha_minuta).isNotNull(), F.lit("Venta con minuta")).otherwise(F.lit("Separación sin minuta"))


def any_not_null(*cols) -> Column:
    """SC-37: any of the columns is not null."""
    return F.coalesce(*[col_of(c) for c in cols]).isNotNull() if len(cols) > 1 else col_of(cols[0]).isNotNull()
