"""Date spines. A spine is bounded by the calendar, not by the data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import as_month


def month_spine(df: DataFrame, start: str, as_of: date) -> DataFrame:
    """Every month from the earliest ``start`` to the month of ``as_of``; no months when there is no start."""
    bounds = df.agg(as_month(F.min(start)).alias("lo")).withColumn("hi", as_month(F.lit(as_of)))
    return bounds.filter(F.col("lo") <= F.col("hi")).select(
        F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month_start")
    )


# Hours that one row of a gap unfolds to; longer gaps are cut into such pieces, which are dealt out before.
_PIECE = 24 * 365


def fill_hours(counts: DataFrame, hour: str, value: str) -> DataFrame:
    """Add the hours missing between the first and the last one, with 0; rows without an hour go.

    Every row unfolds the gap up to the next one, so ``counts`` is computed once. The window sees one row per hour that
    occurs; a gap of any length, as a line with a wrong year makes it, is unfolded by many tasks.
    """
    following = F.lead(hour).over(Window.orderBy(hour))
    stretch = F.coalesce(F.timestamp_diff("HOUR", F.col(hour), following), F.lit(1))
    rows = counts.filter(F.col(hour).isNotNull()).select(hour, value, stretch.alias("_hours"))
    pieces = rows.withColumn("_piece", F.explode(F.sequence(F.lit(0), ((F.col("_hours") - 1) / _PIECE).cast("long"))))
    pieces = pieces.repartition(hour, "_piece")
    first, last = F.col("_piece") * _PIECE, F.least((F.col("_piece") + 1) * _PIECE, F.col("_hours")) - 1
    each = pieces.withColumn("_step", F.explode(F.sequence(first, last)))
    return each.select(
        F.timestamp_add("HOUR", F.col("_step").cast("int"), F.col(hour)).alias(hour),
        F.when(F.col("_step") == 0, F.coalesce(value, F.lit(0))).otherwise(0).alias(value),
    )
