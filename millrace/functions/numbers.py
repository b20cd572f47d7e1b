"""Numeric helpers that stay total under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import strip_all


def whole_number(col: Column, default: str | None = None, type_name: str = "bigint") -> Column:
    """Text to integer. An absent or empty text takes the default, one of white space alone or any other text that is
    no whole number (``3.0`` too) becomes null."""
    text = F.nullif(col, F.lit(""))
    return strip_all(F.coalesce(text, F.lit(default)) if default is not None else text).try_cast(type_name)


def real_number(col: Column) -> Column:
    """Text to double; what is no number becomes null. A bare cast would also take ``5d``, ``5f`` and hexadecimals."""
    return F.when(~col.rlike(r"[0-9.][dDfF]\s*$|[xX]"), col).try_cast("double")


def cents_to_dollars(col: Column, precision: int = 2) -> Column:
    return F.round(col.cast("double") / 100, precision)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def percent_change(value: Column, previous: Column) -> Column:
    """Change against the previous value in percent; null when there is none or when it is 0."""
    return (value - previous) / F.nullif(previous, F.lit(0.0)) * 100
