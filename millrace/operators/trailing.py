"""Trailing three-row metrics per key that survive a key holding a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import write_once


def _halo(rows: DataFrame, key: str, order: list[Column], columns: list[str]) -> DataFrame:
    """For every range of a key, the two rows of that key just before the range begins.

    Each range first shrinks to its last two rows, so the per-key pass below reads two rows per range that the key
    touches, never the rows themselves. The two wanted rows may lie in different, far earlier ranges.
    """
    newest = Window.partitionBy(key, "_range").orderBy(*[c.desc_nulls_last() for c in order])
    tails = rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= 2)
    in_time = Window.partitionBy(key).orderBy("_range", F.col("_rank").desc())
    row = F.struct(*columns)
    before = F.array(*[F.lag(row, n).over(in_time) for n in (1, 2)])
    starts = tails.select(key, "_range", F.lag("_range").over(in_time).alias("_before"), before.alias("_halo"))
    return (
        starts.filter(F.col("_before") != F.col("_range"))
        .select(key, "_range", F.explode("_halo").alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select(key, "_range", "_row.*")
    )


def trailing_metrics(
    df: DataFrame, key: str, ts: str, value: str, history: DataFrame | None = None, ranges: int | None = None
) -> DataFrame:
    """Add ``moving_avg`` (this row and the two before it) and ``previous`` (the value of the row before).

    Rows of a key are ordered by ``ts``, a null one first, and then by ``value``; a null key is a key like any other.
    ``history`` holds earlier rows of a key, which feed the metrics but are not returned.

    A window sorts each key in one task. Here no key has to fit into one: all rows are dealt out by ranges of key and
    time and stored once, whoever their key is, and every range receives the two rows of its key before it as a halo,
    which is all the frame looks back. Where the ranges are cut, and how many there are (``ranges``, by default what the
    session's shuffles use), cannot change the result. Rows that agree in key, time and value are interchangeable.
    """
    rows = df.withColumn("_carried", F.lit(False))
    if history is not None:
        earlier = history.select(key, ts, value).withColumn("_carried", F.lit(True))
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    bounds = [F.col(key).asc_nulls_first(), F.col(ts).asc_nulls_first(), F.col(value).asc_nulls_first()]
    cut = rows.repartitionByRange(*([ranges] if ranges else []), *bounds)
    rows = write_once(cut.withColumn("_range", F.spark_partition_id()), "trailing-ranges")

    halo = _halo(rows, key, [F.col(ts), F.col(value)], [ts, value]).withColumn("_carried", F.lit(True))
    in_time = Window.partitionBy(key, "_range").orderBy(F.col(ts).asc_nulls_first(), F.col(value).asc_nulls_first())
    return (
        rows.unionByName(halo, allowMissingColumns=True)
        .withColumn("moving_avg", F.avg(value).over(in_time.rowsBetween(-2, 0)))
        .withColumn("previous", F.lag(value).over(in_time))
        .filter(~F.col("_carried"))
        .drop("_carried", "_range")
    )
