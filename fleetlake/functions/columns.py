"""Cleaning rules on single columns.

All of them are built-in expressions, so a cleaning job stays one codegen
stage over the scan. Null handling is spelled out wherever Spark's
``greatest``/``least`` (which skip nulls) would give another result.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that a CSV source uses for "no value".
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Words read as booleans in the silver layer.
TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]

# Spark's casts take more than these forms ('2024', '12d', 'NaN'), so text is matched
# first. Years are those that nanosecond timestamps hold in full.
_YEAR = r"(167[89]|16[89]\d|1[7-9]\d\d|2[01]\d\d|22[0-5]\d|226[01])"
_DATE = rf"^{_YEAR}-\d\d-\d\d([ T]\d\d:\d\d(:\d\d(\.\d+)?)?)?$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


# What a database takes as a date, a time or a number; any year of four digits.
_ANY_DATE = r"^\s*\d{4}-\d\d-\d\d([ T]\d\d:\d\d(:\d\d(\.\d+)?)?)?\s*$"


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def iso_date(c: Column) -> Column:
    """ISO text (a time part is dropped) to date; anything else to null."""
    return F.when(c.rlike(_DATE), c.try_cast("date"))


def iso_timestamp(c: Column) -> Column:
    """ISO text to a timestamp without zone; anything else to null."""
    return F.when(c.rlike(_DATE), c.try_cast("timestamp_ntz"))


def number(c: Column) -> Column:
    """Plain decimal text to double; other text, 'NaN' and 'Infinity' too, to null."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def strict(c: Column, kind: str) -> Column:
    """Text to a date, timestamp or decimal; text of any other form ('2024', '1,234.5') raises."""
    form = _NUMBER if kind.startswith("decimal") else _ANY_DATE
    bad = F.raise_error(F.concat(F.lit(f"not a {kind}: "), c)).cast(kind)
    return F.when(c.isNull(), F.lit(None).cast(kind)).when(c.rlike(form), c.cast(kind)).otherwise(bad)


def clip(c: Column, low=None, high=None) -> Column:
    """Bound a column by constants; null stays null."""
    bounded = c
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    return F.when(c.isNotNull(), bounded)


def clip_to(c: Column, low, high: Column) -> Column:
    """Bound by a constant below, then by a column above; a null bound is no bound."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), high))


def whole(c: Column, default: int, low: int | None = None, high: int | None = None) -> Column:
    """Fill, bound and truncate toward zero.

    The bounds are whole numbers, so bounding first gives the same value and
    keeps huge input inside the integer range.
    """
    filled = F.coalesce(c, F.lit(float(default)))
    return clip(
        filled, None if low is None else float(low), None if high is None else float(high)
    ).cast("int")


def flag(c: Column, default: bool) -> Column:
    """'true'/'false' text to boolean, anything else to the default."""
    text = F.lower(c)
    return F.when(text == "true", True).when(text == "false", False).otherwise(F.lit(default))


def boolean_word(c: Column, otherwise: bool | None = None) -> Column:
    """The wider silver vocabulary; other text and null become ``otherwise``."""
    text = F.lower(c)
    return (
        F.when(text.isin(TRUE_WORDS), True)
        .when(text.isin(FALSE_WORDS), False)
        .otherwise(F.lit(otherwise).cast("boolean"))
    )


def not_before(end: Column, start: Column) -> Column:
    """An end that precedes its start moves to one day after the start."""
    return F.when(end < start, start + F.expr("interval 1 day")).otherwise(end)


def email(c: Column, default: str) -> Column:
    return F.coalesce(F.lower(c), F.lit(default))


def adult_birth_date(c: Column, as_of: date) -> Column:
    """Missing birth dates, and those of anyone under 18, become 25 years before ``as_of``.

    A year counts 365 days here.
    """
    latest = F.date_sub(F.lit(as_of), 365 * 18)
    return F.when(c <= latest, c).otherwise(F.date_sub(F.lit(as_of), 365 * 25))


def is_late(actual: Column, scheduled: Column) -> Column:
    return F.coalesce(actual > scheduled, F.lit(False))


def late_days(actual: Column, scheduled: Column) -> Column:
    return clip(F.datediff(actual, scheduled), low=0)


def full_name(first: Column, last: Column) -> Column:
    """Both names with one space; a missing part counts as empty text."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def date_key(c: Column) -> Column:
    """yyyymmdd as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def moment(value: datetime) -> Column:
    """A constant timestamp without zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
