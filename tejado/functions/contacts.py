"""Phones, e-mails, names, anonymisation (SC-19..23, SC-25, SC-27, SC-28)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.functions._util import col_of, null_str
from tejado.functions.text import ustrip


def digits(c) -> Column:
    return F.regexp_replace(col_of(c).cast("string"), r"\D", "")


def phone_key(c, drop_51: bool = True, drop_0051: bool = False, empty_as_null: bool = False) -> Column:
    """SC-19: digits only; ``51`` prefix dropped at 11 digits, ``0051`` at 13 (notebook variant).

    The lead-audit copy keeps the prefix: ``drop_51=False``. Null gives ``""``
    unless ``empty_as_null``.
    """
    s = F.coalesce(digits(c), F.lit(""))
    if drop_51:
        s = F.when(s.startswith("51") & (F.length(s) == 11), F.substring(s, 3, 100)).otherwise(s)
    if drop_0051:
        s = F.when(s.startswith("0051") & (F.length(s) == 13), F.substring(s, 5, 100)).otherwise(s)
    return F.nullif(s, F.lit("")) if empty_as_null else s


def is_mobile(c) -> Column:
    """SC-20: 9 digits starting with 9 after an optional ``51`` country code."""
    s = phone_key(c, drop_51=True)
    return s.rlike(r"^9\d{8}$")


EMAIL_SIMPLE = r"(?U)^[^@\s]+@[^@\s]+\.[^@\s]+$"
EMAIL_STRICT = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def is_email(c) -> Column:
    """SC-21 (simple): lower + strip, then ``x@y.z`` with no spaces."""
    s = F.lower(ustrip(F.coalesce(col_of(c).cast("string"), F.lit(""))))
    return s.rlike(EMAIL_SIMPLE)


def is_email_strict(c) -> Column:
    """SC-21 (strict) on an already cleaned value; null -> false."""
    return F.coalesce(col_of(c).rlike(EMAIL_STRICT), F.lit(False))


# Known typo domains and their corrections.
DOMAIN_TYPOS = {
    "gmai.com": "gmail.com",
    "gmal.com": "gmail.com",
    "gmial.com": "gmail.com",
    "gmail.con": "gmail.com",
    "gmail.co": "gmail.com",
    "gmail.cm": "gmail.com",
    "gmail.comm": "gmail.com",
    "hotmai.com": "hotmail.com",
    "hotmial.com": "hotmail.com",
    "homtail.com": "hotmail.com",
    "hotmail.con": "hotmail.com",
    "hotmail.co": "hotmail.com",
    "hotmail.cm": "hotmail.com",
    "hotmail.comm": "hotmail.com",
    "outlok.com": "outlook.com",
    "outloo.com": "outlook.com",
    "outlook.con": "outlook.com",
    "yaho.com": "yahoo.com",
    "yahoo.con": "yahoo.com",
}
# The domains a fuzzy correction may land on.
KNOWN_DOMAINS = [
    "gmail.com",
    "hotmail.com",
    "outlook.com",
    "yahoo.com",
    "icloud.com",
    "live.com",
    "msn.com",
    "contraloria.gob.pe",
]
#: A domain is mended to a known one if the cost is at most so many percent of the letters of both.
FUZZY_PERCENT = 12


def email_parts(c) -> tuple[Column, Column, Column]:
    """SC-22 native part: (cleaned text, user, domain before typo fixing).

    lower + strip, inner whitespace removed, ``,`` -> ``.``, the first ``..`` -> ``.``
    (Python's ``replace`` is left to right, non-overlapping), first part is the
    user and last part the domain, both with dots stripped at the ends.
    """
    s = F.lower(ustrip(col_of(c).cast("string")))
    s = F.regexp_replace(s, r"(?U)\s+", "")
    s = F.replace(s, F.lit(","), F.lit("."))
    s = F.replace(s, F.lit(".."), F.lit("."))
    parts = F.split(s, "@")
    user = F.regexp_replace(F.element_at(parts, 1), r"^\.+|\.+$", "")
    domain = F.regexp_replace(F.element_at(parts, -1), r"^\.+|\.+$", "")
    return s, user, domain


def closest_domain(domain: Column) -> Column:
    """SC-23: the known domain that costs least to reach, if near enough (ties: list order); else null.

    The cost is the edit distance with a replaced letter counted twice (once out, once in), against the letters of both.
    A documented deviation: the source compares by matching blocks with a cutoff of 0.88. This is native, and agrees on
    mistyped, missing and added letters.
    """
    def cost(known: str) -> Column:
        return 2 * F.levenshtein(domain, F.lit(known)) - F.abs(F.length(domain) - len(known))

    near = [F.when(cost(k) * 100 <= (F.length(domain) + len(k)) * FUZZY_PERCENT,
                   F.struct(cost(k).alias("cost"), F.lit(i).alias("place"), F.lit(k).alias("known")))
            for i, k in enumerate(KNOWN_DOMAINS)]
    return F.when(~domain.isin(KNOWN_DOMAINS), F.array_min(F.array_compact(F.array(*near)))["known"])


def clean_emails(df: DataFrame, email_col: str, out_col: str = "email_clean") -> DataFrame:
    """SC-22 + SC-23: typo table first, else the closest known domain, else unchanged; row by row, no shuffle."""
    s, user, domain = email_parts(F.col(email_col))
    tmp = df.withColumns({"__em": s, "__user": user, "__dom": domain})
    typo = F.create_map(*[x for k, v in DOMAIN_TYPOS.items() for x in (F.lit(k), F.lit(v))])
    fixed = F.coalesce(F.element_at(typo, F.col("__dom")), closest_domain(F.col("__dom")), F.col("__dom"))
    out = (F.when(F.col("__em").isNull(), null_str())
           .when(~F.col("__em").contains("@"), F.col("__em"))
           .otherwise(F.concat(F.col("__user"), F.lit("@"), fixed)))
    return tmp.withColumn(out_col, out).drop("__em", "__user", "__dom")


def exclusion_email(c) -> Column:
    """SC-25: lower + strip; null -> ""."""
    return F.lower(ustrip(F.coalesce(col_of(c).cast("string"), F.lit(""))))


def clean_text(c) -> Column:
    """Null -> "", stripped."""
    return ustrip(F.coalesce(col_of(c).cast("string"), F.lit("")))


# Column-name fragments that mark a column as personal data.
SENSITIVE_PATTERNS = [
    "dni",
    "documento",
    "ruc",
    "telefono",
    "celular",
    "phone",
    "email",
    "correo",
    "nombre_cliente",
    "nombres",
    "apellidos",
    "cliente",
    "direccion",
    "address",
]


def is_sensitive(name: str, patterns=None) -> bool:
    low = name.lower()
    return any(p in low for p in (patterns or SENSITIVE_PATTERNS))


def anonymise(c) -> Column:
    """SC-27: ``anon_`` + first 10 hex of SHA-256 of the stripped text; null stays null, blank -> ""."""
    t = ustrip(col_of(c).cast("string"))
    return F.when(t == "", t).otherwise(F.concat(F.lit("anon_"), F.substring(F.sha2(t, 256), 1, 10)))


def anonymise_frame(df: DataFrame, patterns=None) -> DataFrame:
    """SC-27 over every column whose name matches a sensitive pattern."""
    cols = [anonymise(F.col(c)).alias(c) if is_sensitive(c, patterns) else F.col(c) for c in df.columns]
    return df.select(*cols)


def client_name(cliente, nombres, apellidos, blank_falls_back: bool = True) -> Column:
    """SC-28: the given name when not blank, else ``nombres + ' ' + apellidos`` stripped.

    ``blank_falls_back=False`` is the copy that falls back on null only.
    """
    full = ustrip(F.concat(F.coalesce(col_of(nombres).cast("string"), F.lit("")), F.lit(" "),
                           F.coalesce(col_of(apellidos).cast("string"), F.lit(""))))
    given = col_of(cliente).cast("string")
    if blank_falls_back:
        return F.when(given.isNotNull() & (ustrip(given) != ""), given).otherwise(full)
    return F.coalesce(given, full)
