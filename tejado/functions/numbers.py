"""Lenient numbers, percents and money text (SC-08, SC-09, SC-31, SC-35, SC-36)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tejado.functions._util import col_of
from tejado.functions.text import ustrip

# Plain decimal or scientific notation. Spark's try_cast alone accepts '12d'
# and 'nan', which pandas rejects, so the guard runs first (T-07).
NUMBER_GUARD = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c) -> Column:
    """SC-08: unparsable -> null; numbers pass through."""
    s = col_of(c).cast("string")
    return F.when(s.rlike(NUMBER_GUARD), F.trim(s).try_cast("double"))


def to_percent(c) -> Column:
    """SC-09: ``0.08``, ``8``, ``8%`` and ``0,08`` all give 0.08; |x| > 1 is divided by 100."""
    s = F.replace(F.replace(ustrip(col_of(c).cast("string")), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    x = to_number(s)
    return F.when(F.abs(x) <= 1, x).otherwise(x / 100)


def coalesce_numbers(df, candidates) -> Column:
    """PRJ-04 numeric: first parsable value over the existing candidate columns."""
    cols = [to_number(F.col(c)) for c in candidates if c in df.columns]
    return F.coalesce(*cols) if cols else F.lit(None).cast("double")


def coalesce_percents(df, candidates) -> Column:
    """PRJ-04 percent: first parsable percent over the existing candidate columns."""
    cols = [to_percent(F.col(c)) for c in candidates if c in df.columns]
    return F.coalesce(*cols) if cols else F.lit(None).cast("double")


def money_text(c, prefix: str = "S/ ") -> Column:
    """SC-35: ``S/ 1,234``; null counts as 0."""
    return F.format_string(prefix + "%,.0f", F.coalesce(col_of(c).cast("double"), F.lit(0.0)))


def number_text(c) -> Column:
    return F.format_string("%,.0f", F.coalesce(col_of(c).cast("double"), F.lit(0.0)))


def inconsistent_amount(amount, base, pct, tolerance: float = 0.05) -> Column:
    """SC-36: |amount - base * pct| > tolerance; nulls give false."""
    diff = F.abs(col_of(amount) - col_of(base) * col_of(pct))
    return F.coalesce(diff > tolerance, F.lit(False))
