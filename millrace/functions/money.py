"""Sums of money that do not depend on the order of their rows.

Doubles add up differently in every partitioning. Amounts are therefore summed as whole units of a hundredth of a cent, and
turned back into an amount once, at the end: the result is the double closest to the exact sum of the rounded amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000
#: Beyond this a double cannot tell one unit from the next.
_LIMIT = float((1 << 53) // UNITS)


def units(amount: Column | str) -> Column:
    """Whole units of an amount. One that is not finite, or too large to be exact, is an error."""
    value = F.col(amount) if isinstance(amount, str) else amount
    whole = F.floor(value * UNITS + 0.5)
    unfit = F.raise_error(F.concat(F.lit("no exact amount: "), value.cast("string"))).cast("bigint")
    return F.when(F.abs(value) <= _LIMIT, whole).when(value.isNotNull(), unfit)


def amount(total: Column | str) -> Column:
    """The amount of a number of units; beyond what a double can count, its whole and its part are divided by themselves."""
    n = F.col(total) if isinstance(total, str) else total
    split = F.call_function("div", n, F.lit(UNITS)).cast("double") + (n % F.lit(UNITS)) / F.lit(float(UNITS))
    return F.when(n.between(-(1 << 53), 1 << 53), n / F.lit(float(UNITS))).otherwise(split)


def exact_sum(value: Column | str) -> Column:
    """Aggregate: the exact sum. It is computed in 64 bits, an overflow is an error."""
    return amount(F.sum(units(value)))
