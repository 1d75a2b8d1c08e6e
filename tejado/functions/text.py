"""Text keys and cleaning as native Spark expressions (SC-01..04, SC-10, SC-12, SC-34).

Spark has no Unicode NFKD or casefold function, so a fold is two native steps
built from :mod:`unicodedata` (a rule over all code points, not a copied table):

* ``translate`` for every character that folds to exactly one (``á`` -> ``a``,
  NBSP -> space, ``𝐀`` -> ``A``);
* a lookup per character for those whose fold is longer or empty (``½`` ->
  ``12``, ``ﬁ`` -> ``fi``), evaluated only on rows that contain one.

For the ASCII fold everything else that is not ASCII is then removed, which is
what ``normalize("NFKD").encode("ascii", "ignore")`` does.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tejado.functions._util import col_of

# Marker texts that stand for a missing value in string columns.
MISSING_MARKERS = ["<NA>", "None", "nan", "NaN"]
# Words that are dropped from packed code lists (compared upper-cased).
PACKED_NULL_WORDS = ["<NA>", "NAN", "NONE", "NULL"]

_WS = r"[\s\x1c-\x1f]"  # Python str.split() also treats \x1c-\x1f as whitespace
# Unicode's white space (what \s is under (?U)), for native trims.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def fold_text(value, upper: bool = True) -> str:
    """SC-01's fold for a driver-side name or literal: NFKD, ASCII only, stripped, single spaces."""
    ascii_only = unicodedata.normalize("NFKD", str(value)).encode("ascii", "ignore").decode("ascii")
    out = " ".join(ascii_only.split())
    return out.upper() if upper else out


def fold_words(value) -> str:
    """SC-03's key for a driver-side name or literal: the fold with anything but letters and digits as one space."""
    return " ".join("".join(ch if ch.isalnum() else " " for ch in fold_text(value)).split())


def _without_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


# one character's fold, by kind of key
FOLDS = {
    "ascii": lambda ch: unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii"),
    "compare": lambda ch: _without_marks(ch.casefold()),
}


@functools.lru_cache(maxsize=None)
def _fold_tables(kind: str):
    """(from, to) strings for translate, and {char: fold} for folds of no or several characters."""
    src, dst, other = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = FOLDS[kind](ch)
        if folded == ch:
            continue
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif folded or kind != "ascii":  # the ASCII fold drops what is left anyway
            other[ch] = folded
    return "".join(src), "".join(dst), other


def _char_class(chars) -> str:
    """Regex class with consecutive code points merged into ranges (a short class matches fast)."""
    cps = sorted(ord(c) for c in chars)
    parts, start, prev = [], None, None
    for cp in cps + [None]:
        if start is not None and (cp is None or cp != prev + 1):
            parts.append("\\x{%04X}" % start if start == prev else "\\x{%04X}-\\x{%04X}" % (start, prev))
            start = None
        if cp is not None and start is None:
            start = cp
        prev = cp
    return "[" + "".join(parts) + "]"


def _apply_long_folds(c: Column, long_map: dict) -> Column:
    if not long_map:
        return c
    # Two literals instead of a 400-entry map expression: the keys as one string
    # (position by ``instr``) and the folds as one split array; keeps plans small.
    items = sorted(long_map.items())
    keys = F.lit("".join(k for k, _ in items))
    vals = F.split(F.lit("\u0001".join(v for _, v in items)), "\u0001")

    def one(ch):
        pos = F.instr(keys, ch)
        return F.when((ch != "") & (pos > 0), F.element_at(vals, pos)).otherwise(ch)

    per_char = F.array_join(F.transform(F.split(c, ""), one), "")
    # the ASCII test first: most rows stop there
    needs = c.rlike(r"[^\x00-\x7F]") & c.rlike(_char_class(long_map.keys()))
    return F.when(needs, per_char).otherwise(c)


def _beyond_ascii(c: Column) -> Column:
    """Whether a text holds a character of several bytes; two counts, no pattern."""
    return F.octet_length(c) > F.char_length(c)


def fold_ascii(c) -> Column:
    """NFKD + drop non-ASCII.

    ASCII-only values (most keys) skip the fold: one cheap test decides.
    """
    c = col_of(c)
    src, dst, other = _fold_tables("ascii")
    out = F.translate(c, src, dst)
    out = _apply_long_folds(out, other)
    out = F.regexp_replace(out, r"[^\x00-\x7F]", "")
    return F.when(_beyond_ascii(c), out).otherwise(c)


def fold_compare(c) -> Column:
    """Casefold, NFKD, combining marks dropped; other letters stay (SC-02)."""
    c = col_of(c)
    src, dst, other = _fold_tables("compare")
    upper = "".join(map(chr, range(65, 91)))  # in the same step: what a character folds to isn't folded again
    out = _apply_long_folds(F.translate(c, src + upper, dst + upper.lower()), other)
    return F.when(_beyond_ascii(c), out).otherwise(F.lower(c))


def ustrip(c) -> Column:
    """Unicode-aware strip, like Python ``str.strip()`` (Spark ``trim`` only drops spaces)."""
    return F.btrim(col_of(c), F.lit(_SPACES))


def blank_to_null(c) -> Column:
    c = col_of(c)
    return F.when(ustrip(c) == "", F.lit(None).cast("string")).otherwise(c)


def has_text(c) -> Column:
    """Not null and not only white space."""
    return F.coalesce(ustrip(col_of(c).cast("string")) != "", F.lit(False))


def is_blank(c) -> Column:
    """Null, empty or whitespace only (FLT-04)."""
    return ~has_text(c)


def norm_text(c) -> Column:
    """SC-01: strip, NFKD, ASCII only, upper, collapse whitespace; empty -> null."""
    s = F.upper(fold_ascii(col_of(c).cast("string")))
    s = F.trim(F.regexp_replace(s, _WS + "+", " "))
    return F.nullif(s, F.lit(""))


def norm_ascii(c) -> Column:
    """SC-01 variant whose empty result is ``""`` instead of null."""
    return F.coalesce(norm_text(c), F.lit(""))


def norm_compare(c) -> Column:
    """SC-02: null -> "", strip, casefold, drop combining marks."""
    return fold_compare(ustrip(F.coalesce(col_of(c).cast("string"), F.lit(""))))


def norm_compare_literal(value) -> str:
    """The same key for a driver-side literal."""
    return _without_marks(str(value).strip().casefold())


def norm_alnum(c) -> Column:
    """SC-03: SC-01 (empty -> ""), then every non-[A-Z0-9] run becomes one space: white space included, so one pattern
    does both."""
    s = F.upper(fold_ascii(col_of(c).cast("string")))
    return F.coalesce(F.trim(F.regexp_replace(s, r"[^A-Z0-9]+", " ")), F.lit(""))


# The explicit accent table of the upper-casing variant (SC-04).
ACCENT_TABLE_FROM = "ÁÉÍÓÚÜ"
ACCENT_TABLE_TO = "AEIOUU"


def upper_fixed_accents(c) -> Column:
    """SC-04: null -> "", strip, upper, then the fixed accent table."""
    s = F.upper(ustrip(F.coalesce(col_of(c).cast("string"), F.lit(""))))
    return F.translate(s, ACCENT_TABLE_FROM, ACCENT_TABLE_TO)


def null_markers(c) -> Column:
    """PRJ-10: texts that stand for missing become null."""
    c = col_of(c)
    return F.when(c.isin(*MISSING_MARKERS), F.lit(None).cast("string")).otherwise(c)


def split_codes(c, separators: str = ",;|") -> Column:
    """SC-10: split a packed list, trim, drop blanks and NA/NONE/NULL words.

    ``separators="," `` gives the comma-only variant.
    """
    c = col_of(c).cast("string")
    pattern = "[" + "".join("\\" + s if s in "|\\[]^-" else s for s in separators) + "]"
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), pattern), lambda p: ustrip(p))
    longest = max(map(len, PACKED_NULL_WORDS))  # longer codes needn't be looked at
    return F.filter(parts, lambda p: (p != "") & ((F.length(p) > longest) | ~F.upper(p).isin(*PACKED_NULL_WORDS)))


def unit_name(nombre, codigo=None) -> Column:
    """SC-12: the name, else the code (null-only fallback), stripped; blank -> null."""
    raw = col_of(nombre) if codigo is None else F.coalesce(col_of(nombre), col_of(codigo))
    return F.nullif(ustrip(raw.cast("string")), F.lit(""))


def safe_label(c, max_len: int = 80, default: str = "Sin Asesor", replacement: str = "_") -> Column:
    """SC-34: each run of illegal file-name characters replaced, whitespace collapsed, cut; blank -> default."""
    s = F.regexp_replace(col_of(c).cast("string"), r'[\\/:*?"<>|]+', replacement)
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    s = F.substring(s, 1, max_len)
    return F.coalesce(F.nullif(F.trim(s), F.lit("")), F.lit(default))
