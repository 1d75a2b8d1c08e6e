"""Identifier keys: documents, invoice numbers, companies (SC-05, SC-06, SC-14..18)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tejado.functions._util import col_of, null_str
from tejado.functions.text import fold_ascii, fold_text, fold_words, norm_alnum, norm_ascii, ustrip


def pad_left(c, width: int, fill: str = "0") -> Column:
    """Left pad without truncation (Spark ``lpad`` cuts longer values; ``zfill`` does not)."""
    c = col_of(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def doc_key(c) -> Column:
    """SC-05: strip (as all but digits go, this needs no step), remove the text ``.0`` everywhere, keep ASCII digits; empty -> null."""
    s = F.replace(col_of(c).cast("string"), F.lit(".0"), F.lit(""))
    return F.nullif(F.regexp_replace(s, r"[^0-9]", ""), F.lit(""))


def doc_key_strict(c, require_len: int | None = None, pad_to: int | None = None) -> Column:
    """SC-06: strip, upper, drop a trailing ``.0``, digits only, empty -> null.

    ``pad_to=8`` left-pads short keys (the zfill variant), ``require_len=8`` nulls
    every key of another length.
    """
    s = F.upper(ustrip(col_of(c).cast("string")))
    s = F.regexp_replace(F.regexp_replace(s, r"\.0$", ""), r"[^0-9]", "")
    s = F.nullif(s, F.lit(""))
    if pad_to:
        s = pad_left(s, pad_to)
    if require_len:
        s = F.when(F.length(s) == require_len, s).otherwise(null_str())
    return s


def unit_code_from_type(tipo, numero, prefix: str = "FX-", parking_word: str = "ESTACIONAMIENTO",
                        parking_tag: str = "E") -> Column:
    """SC-14: ``FX-E<n>`` for parking, else ``FX-<n>``; the number loses a trailing ``.0``."""
    n = F.regexp_replace(ustrip(col_of(numero).cast("string")), r"\.0$", "")
    is_parking = F.coalesce(F.upper(ustrip(col_of(tipo).cast("string"))) == parking_word, F.lit(False))
    return F.when(is_parking, F.concat(F.lit(prefix + parking_tag), n)).otherwise(F.concat(F.lit(prefix), n))


def invoice_key(c) -> Column:
    """SC-15 (conservative): SC-01 text, trailing ``.0`` dropped, no spaces, keep ``[A-Z0-9-]``.

    Null gives ``""``. Dash variants need no rule: the NFKD fold already drops them. One pattern does all that comes after
    the fold.
    """
    s = F.upper(fold_ascii(col_of(c).cast("string")))
    return F.coalesce(F.regexp_replace(s, r"\.0[\s\x1c-\x1f]*$|[^A-Z0-9\-]", ""), F.lit(""))


_FLEX = r"([A-Z]\d{3})[-_ ]*0*([0-9]+)"


def invoice_flex_key(c) -> Column:
    """SC-16: series + number without leading zeros (``F001|13``); else alphanumerics only."""
    return flex_from_exact(invoice_key(c))


def flex_from_exact(s) -> Column:
    """SC-16 from an SC-15 key, which holds no ``|``: the first series and number, else the key without dashes."""
    found = F.regexp_replace(col_of(s), f"^.*?{_FLEX}.*$", "$1|$2")
    return F.when(F.contains(found, F.lit("|")), found).otherwise(F.translate(found, "-", ""))


_CANON = r"([BF]\d{3})-?0*(\d+)$"


def invoice_canonical_key(c) -> Column:
    """SC-17: ``[BF]ddd`` series + number padded to 8 (``F001-00000013``); else the cleaned text.

    Upper-casing happens before the fold (so ``º`` folds to a lower-case ``o`` and is dropped).
    """
    return canonical_from_clean(canonical_clean(c))


# ASCII characters that a canonical key doesn't keep.
_NOT_CANON = "".join(ch for ch in map(chr, range(128)) if not re.match(r"[A-Z0-9_/\-]", ch))


def canonical_clean(c) -> Column:
    """SC-17 first half: upper, fold, no spaces, ``_`` and ``/`` as ``-``, keep ``[A-Z0-9-]``, single dashes.

    The fold leaves ASCII only, so one ``translate`` drops and unifies characters; a pattern runs only on runs of dashes.
    """
    s = F.translate(fold_ascii(F.upper(col_of(c).cast("string"))), "_/" + _NOT_CANON, "--")
    return F.btrim(F.when(F.contains(s, F.lit("--")), F.regexp_replace(s, "-+", "-")).otherwise(s), F.lit("-"))


def canonical_from_clean(s) -> Column:
    """SC-17 second half, from a materialised ``canonical_clean`` column."""
    return canonical_from_parts(canonical_parts(s))


def canonical_parts(s) -> Column:
    """``series|number`` where a cleaned text (which holds no ``|``) ends in these, else the text; one pattern."""
    return F.regexp_replace(col_of(s), f"^.*?{_CANON}", "$1|$2")


def canonical_from_parts(parts) -> Column:
    """The canonical key of a materialised :func:`canonical_parts` column."""
    parts = col_of(parts)
    number = F.substring_index(parts, "|", -1)
    canon = F.concat(F.substring_index(parts, "|", 1), F.lit("-"), pad_left(number, 8))
    return F.coalesce(F.when(F.contains(parts, F.lit("|")), canon).otherwise(parts), F.lit(""))


# Company rules for ledger files, in priority order
# (company, sales file, master file, tokens a ledger file name may contain).
COMPANY_RULES = [
    ("URSA", "VENTA URSA 2026.xlsx", "MAESTRO_COMPROBANTES_URSA.xlsx", ["URSA"]),
    ("10_DE_ABRIL", "VENTA 10 DE ABRIL 2026.xlsx", "MAESTRO_COMPROBANTES_10_DE_ABRIL.xlsx",
     ["10_DE_ABRIL", "10 DE ABRIL", "10_ABRIL"]),
    ("LYNX", "VENTA LYNX 2026.xlsx", "MAESTRO_COMPROBANTES_LYNX.xlsx", ["LYNX"]),
    ("CYGNUS", "VENTA CYGNUS 2026.xlsx", "MAESTRO_COMPROBANTES_CYGNUS.xlsx", ["CYGNUS"]),
]

# Name aliases per company group for the two-tier enrichment.
GROUP_ALIASES = [
    ("CYGNUS", ["CYGNUS"]),
    ("LYNX", ["LYNX"]),
    ("URSA", ["URSA"]),
    ("10_DE_ABRIL", ["10_DE_ABRIL", "10 DE ABRIL", "DIEZ_DE_ABRIL", "DIEZ DE ABRIL", "10ABRIL"]),
]


def file_base_name(c) -> Column:
    """Last path component (``Path(x).name``)."""
    return F.substring_index(col_of(c).cast("string"), "/", -1)


def company_key(c) -> Column:
    """SC-18 key: SC-03 text of the last path component."""
    return norm_alnum(file_base_name(c))


def company_from_name(c, rules=None) -> Column:
    """SC-18: company from a file name or ``source_file``; first hit in rule order wins.

    For large tables prefer :func:`with_company`, which computes the key once per row.
    """
    return company_from_key(company_key(c), rules)


def company_from_key(key, rules=None) -> Column:
    """SC-18 rule chain over an SC-03 key (a materialised column: every rule reads it)."""
    key = col_of(key)
    expr = None
    for company, sales_file, master_file, tokens in (rules or COMPANY_RULES):
        conds = [key == fold_words(sales_file), key == fold_words(master_file)]
        conds += [key.contains(fold_words(t)) for t in tokens]
        hit = conds[0]
        for cond in conds[1:]:
            hit = hit | cond
        expr = F.when(hit, F.lit(company)) if expr is None else expr.when(hit, F.lit(company))
    return expr.otherwise(null_str())


def group_key(c) -> Column:
    """SC-18 (two-tier) key: SC-01 text with ``-`` as ``_``."""
    return F.translate(norm_ascii(c), "-", "_")


def group_from_name(c, aliases=None) -> Column:
    """SC-18 (two-tier variant): first alias contained in the name wins (see :func:`with_group`)."""
    return group_from_key(group_key(c), aliases)


def group_from_key(n, aliases=None) -> Column:
    """Alias chain over a materialised :func:`group_key` column."""
    n = col_of(n)
    expr = None
    for group, names in (aliases or GROUP_ALIASES):
        for alias in names:
            cond = n.contains(fold_text(alias).replace(" ", "_"))
            expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(null_str())


# ---------------------------------------------------------------- per-row keys computed once
# Each helper adds the normalised key as a column first; Catalyst does not re-inline a
# non-trivial expression that several later expressions read, so the fold runs once per row.

def with_company(df, src: str, out: str = "company", rules=None):
    return df.withColumn("__ck", company_key(F.col(src))).withColumn(out, company_from_key(F.col("__ck"), rules)) \
             .drop("__ck")


def with_group(df, src: str, out: str = "group", aliases=None):
    return df.withColumn("__gk", group_key(F.col(src))).withColumn(out, group_from_key(F.col("__gk"), aliases)) \
             .drop("__gk")


def with_invoice_keys(df, src: str, exact: str = "__exact", flex: str = "__flex"):
    """SC-15 and SC-16 keys; the flexible one is derived from the materialised exact key."""
    return df.withColumn(exact, invoice_key(F.col(src))).withColumn(flex, flex_from_exact(F.col(exact)))


def with_canonical_key(df, src: str, out: str = "efac_comprobante_key"):
    """SC-17 key via its materialised parts."""
    return df.withColumn("__cc", canonical_parts(canonical_clean(F.col(src)))).withColumn(
        out, canonical_from_parts(F.col("__cc"))).drop("__cc")
