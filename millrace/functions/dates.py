"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import strip_all

_YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}$"
_DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
_ANY_SEPARATOR = r"^(\d{4})([-/ \\])(\d{1,2})\2(\d{1,2})((?:[ T].*)?)$"


def parse_mixed_date(col: Column) -> Column:
    """``yyyy-M-d`` or ``d/M/yyyy`` to a date; anything else, impossible dates included, is null.

    The shape is tested before the cast, so no row takes the slow path of a failing formatter.
    """
    text = strip_all(col)
    year_first = F.when(text.rlike(_YEAR_FIRST), text).when(
        text.rlike(_DAY_FIRST), F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")
    )
    return year_first.try_cast("date")


def tolerant_date(col: Column) -> Column:
    """Year-month-day text, with or without a time, to a date; blank, partial or impossible values become null.

    A bare ``try_cast`` would also take a year or a month for a date, and anything for a time.
    """
    text = F.trim(col.cast("string"))
    unusual = F.when(text.rlike(_ANY_SEPARATOR), F.regexp_replace(text, _ANY_SEPARATOR, "$1-$3-$4$5"))
    return F.when(text.rlike(_YEAR_FIRST), text.try_cast("date")).otherwise(
        unusual.try_cast("timestamp_ntz").cast("date")
    )


def as_month(col: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(col, "month")


def months_crossed(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates (31 January to 1 February is 1)."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("bigint")


def date_key(col: Column) -> Column:
    """Integer key YYYYMMDD."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")
