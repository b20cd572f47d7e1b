"""Picking rows per key.

All of them rank rows and keep a small prefix. Catalyst turns ``row_number() <= n`` into a group limit that runs before
the shuffle as well as after it, so a key holding a third of the table still sends at most ``n`` rows per input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ColumnLike = Column | str


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that Catalyst will not copy into every filter and expression reading it.

    Predicates on the output of a generator stay above it, so one regex match or JSON parse per row serves them all.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def first_n_per_key(df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[ColumnLike], n: int) -> DataFrame:
    """The first ``n`` rows of every key; null keys form one group."""
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[ColumnLike]) -> DataFrame:
    """One row per key: the first one in ``order``. Unlike ``dropDuplicates`` this promises which."""
    return first_n_per_key(df, keys, order, 1)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The newest ``n`` rows per key; ``order`` lists the time and its tie-breaks, all taken descending, nulls last."""
    return first_n_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order], n)


def duplicate_count(df: DataFrame, keys: Sequence[str], alias: str = "dropped_rows") -> DataFrame:
    """How many rows keep-first removes."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias(alias))


def top_k(df: DataFrame, k: int, *order: ColumnLike) -> DataFrame:
    """Global top-k. ``order`` must end in a unique column so that ties cannot change the result."""
    return df.orderBy(*order).limit(k)


def frequency(df: DataFrame, col: str, count_alias: str, k: int | None = None) -> DataFrame:
    """Value counts, most frequent first, optionally only the top ``k``."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_alias))
    order = (F.desc(count_alias), F.asc(col))
    return top_k(counts, k, *order) if k else counts.orderBy(*order)
