"""Surrogate keys and key look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import write_once

_ROW_BITS = 33  # monotonically_increasing_id: task number above, row number within the task below


def hashed_key(*natural_key: Column | str) -> Column:
    """Surrogate key computed from the row alone: needs no shuffle and is the same in every run."""
    return F.xxhash64(*natural_key)


def key_collisions(dim: DataFrame, key: str, natural_key: Sequence[str]) -> DataFrame:
    """Surrogate keys that stand for more than one natural key; must be empty before the dimension is used."""
    return (
        dim.select(key, *natural_key)
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("natural_keys"))
        .filter(F.col("natural_keys") > 1)
    )


def dense_ids(df: DataFrame, id_col: str, order: Sequence[Column | str]) -> DataFrame:
    """Number the rows 1..n in ``order`` without bringing them into one task.

    Range-partition and sort, store each row with its place in its partition, then add the sizes of the partitions
    before it. The stored copy makes the partitions the sizes count and the ones that get numbered the same.
    """
    placed = write_once(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "dense-ids",
    ).withColumn("_task", F.shiftright("_place", _ROW_BITS))
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One offset per partition: the broadcast cannot outgrow the number of tasks.
    return (
        placed.join(F.broadcast(offsets), "_task")
        .withColumn(id_col, F.col("_offset") + row + 1)
        .drop("_place", "_task", "_offset")
    )


def lookup_key(fact: DataFrame, dim: DataFrame, on: Sequence[str], id_col: str) -> DataFrame:
    """Add ``id_col`` of the matching dimension row, null where there is none.

    No hint: Catalyst broadcasts a dimension whose size allows it, else AQE splits hot keys of the fact.
    """
    return fact.join(dim.select(*on, id_col), list(on), "left")
