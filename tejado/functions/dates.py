"""Lenient date parsing (SC-07).

pandas infers one format from the first value and nulls the rest (T-06). Here
every row is read by its own shape: year first (``2024-05-31``, ``20240531``,
``2024-05``), day and month first (``31/5/24``, ``31-05-2024``), or with an
English month name (``31 May 2024``, ``May 31, 2024``); one or two digits, an
optional time with fractions or AM/PM, and an optional zone mark, which is
dropped (wall-clock time).

Which of day and month comes first in ``1/5/2024`` is a convention of the
column. It is given, or told by the column's values: one aggregate counts those
that only one order admits, and the choice is a scalar subquery of the plan. A
value that the convention doesn't admit is read the other way round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tejado.functions._util import col_of
from tejado.functions.text import ustrip

# English month names; each may be cut to its first three letters.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]

_D, _Y = "([0-9]{1,2})", "([0-9]{4}|[0-9]{2})"
_NAME = "(?i:(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + r"|sept))\.?"
_CLOCK = rf"{_D}:{_D}(?::{_D}(\.[0-9]{{1,9}})?)?(?: ?([AaPp])\.?[Mm]\.?)?"
_TIME = rf"(?:(?:[T ]+|, ?){_CLOCK})?(?: ?(?:Z|UTC|[+-][0-9]{{2}}:?[0-9]{{2}}))?"
#: Shapes of a date (three groups) and the groups that hold year, month and day; of the last two the order may vary.
SHAPES = [
    (rf"([0-9]{{4}})[-/.]{_D}[-/.]{_D}{_TIME}", "123", "fixed"),
    (rf"([0-9]{{4}})([0-9]{{2}})([0-9]{{2}}){_TIME}", "123", "fixed"),
    (rf"{_D}/{_D}/{_Y}{_TIME}", "321", "column"),
    (rf"{_D}[-.]{_D}[-.]{_Y}{_TIME}", "321", "day"),
    (rf"{_D}[- ]{_NAME},?[- ]{_Y}{_TIME}", "321", "fixed"),
    (rf"{_NAME} {_D},? {_Y}{_TIME}", "312", "fixed"),
]
_MONTH_ONLY = rf"(?U)^\s*([0-9]{{4}})[-/.]{_D}\s*$"
_SLASHED = rf"(?U)^\s*{_D}/{_D}/(?:[0-9]{{4}}|[0-9]{{2}})\b"
_MARK = "\u0001"  # begins a text that a shape has taken apart


def _taken_apart(text: Column) -> Column:
    """The text as mark|year|month|day|hour|minute|second|fraction|half|order, if it has one of the shapes."""
    for pattern, (y, m, d), order in SHAPES:
        text = F.regexp_replace(text, rf"(?U)^\s*{pattern}\s*$", f"{_MARK}|${y}|${m}|${d}|$4|$5|$6|$7|$8|{order}")
    return F.regexp_replace(text, _MONTH_ONLY, f"{_MARK}|$1|$2|1||||||fixed")


def _made(p: Column, day_first: bool) -> Column:
    """Timestamp of the parts; null where there is no such date or time. Years of two digits: 69 to 99 are 1969 to 1999."""
    year = p[1].cast("int")
    year = F.when(F.length(p[1]) > 2, year).when(year > 68, year + 1900).otherwise(year + 2000)
    names = "".join(m[:3] for m in MONTHS)
    month = F.coalesce(p[2].try_cast("int"), ((F.instr(F.lit(names), F.lower(F.substring(p[2], 1, 3))) + 2) / 3).cast("int"))
    day = p[3].cast("int")
    # as the parts stand, the day came first in the text
    swapped = F.when(p[9] == "fixed", False).when(day > 12, False).when(month > 12, True).otherwise((p[9] == "column") & F.lit(not day_first))
    number = lambda x: F.coalesce(x.try_cast("int"), F.lit(0))
    hour = number(p[4])
    hour = F.when(p[8] == "", hour).when(hour.between(1, 12), hour % 12 + F.when(F.upper(p[8]) == "P", 12).otherwise(0)).otherwise(99)
    seconds = F.concat(number(p[6]).cast("string"), p[7]).cast("decimal(16,6)")
    return F.try_make_timestamp_ntz(year, F.when(swapped, day).otherwise(month), F.when(swapped, month).otherwise(day), hour, number(p[5]), seconds)


def _read(text: Column, day_first: bool) -> Column:
    parts = F.split(_taken_apart(text), r"\|", 10)
    return F.transform(F.array(parts), lambda p: F.when(p[0] == _MARK, _made(p, day_first)))[0]  # the parts are computed once


def parse_timestamp(c, dayfirst=False, formats=None) -> Column:
    """Text -> TIMESTAMP_NTZ; unparsable -> null. ``dayfirst`` (a bool or a condition) reads ``1/5/2024`` as 1 May; dashes
    always do. What one order doesn't admit is read in the other: ``31/12/2024`` and ``12/31/2024`` are the same day.

    ``formats``: Spark patterns to try in order instead.
    """
    if formats:
        s = ustrip(col_of(c).cast("string"))
        return F.coalesce(*[F.when(F.try_to_timestamp(s, F.lit(f)).isNotNull(), F.to_timestamp_ntz(s, F.lit(f))) for f in formats])
    text = col_of(c).cast("string")
    if isinstance(dayfirst, Column):
        return F.when(dayfirst, _read(text, True)).otherwise(_read(text, False))
    return _read(text, bool(dayfirst))


def column_is_day_first(df: DataFrame, name: str) -> Column:
    """Whether the column's dates with slashes have the day first: more values that only this order admits than values that
    only the other does. A scalar subquery of one aggregate over this column alone; false where no value tells."""
    s = F.col(f"`{name}`").cast("string")
    a, b = (F.regexp_extract(s, _SLASHED, i).cast("int") for i in (1, 2))
    only_day = F.count_if(a.between(13, 31) & b.between(1, 12))
    only_month = F.count_if(b.between(13, 31) & a.between(1, 12))
    return df.where(s.rlike(_SLASHED)).agg((only_day > only_month).alias("day_first")).scalar()


def as_timestamp(df: DataFrame, name: str, dayfirst: bool | None = None) -> Column:
    """Column as TIMESTAMP_NTZ whatever its stored type (timestamps pass through). ``dayfirst`` None: the column tells."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampNTZType,)):
        return F.col(name)
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    if isinstance(dtype, T.StringType) and dayfirst is None:
        return parse_timestamp(F.col(name), column_is_day_first(df, name))
    return parse_timestamp(F.col(name), bool(dayfirst))
