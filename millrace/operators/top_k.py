"""Exact top-k of very many keys without counting most of them.

Counting every key of a large table shuffles one row per key and task, though only k of them are asked for. Here each task
keeps a summary of bounded size: when it holds more keys than ``capacity``, the count of the largest key that does not fit is
taken from all of them, and those that reach zero go. A key is in at most this sum of what was taken more often than its
summary says, and a key that no summary holds at most as often. Summaries of tasks are added up, and so are their errors.

Keys that may be among the first k are then counted exactly. They are all of them, and the answer is exact, if the k-th exact
count exceeds the error; else, and if too many keys are left, everything is counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.rows import frequency, top_k
from millrace.session import write_once

CAPACITY = 10_000
#: Keys that are counted exactly at most; they are broadcast.
CANDIDATES = 100_000


def _fitted(counts: dict, capacity: int) -> tuple[dict, int]:
    """The summary of at most ``capacity`` keys, and what was taken from each count."""
    if len(counts) <= capacity:
        return counts, 0
    taken = sorted(counts.values(), reverse=True)[capacity]
    return {k: n - taken for k, n in counts.items() if n > taken}, taken


def summaries(df: DataFrame, col: str, capacity: int = CAPACITY) -> DataFrame:
    """``item`` and ``n`` of every task's summary; a row with ``error`` says by how much its counts may be too low."""
    kind = df.schema[col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        error, arrow = 0, None
        for batch in batches:
            arrow = batch["item"].type
            found = pc.value_counts(batch["item"])
            for item, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True):
                counts[item] = counts.get(item, 0) + n
            if len(counts) > 2 * capacity:
                counts, taken = _fitted(counts, capacity)
                error += taken
        counts, taken = _fitted(counts, capacity)
        if arrow is not None:
            items = pa.array([*counts, None], arrow)
            n = pa.array([*counts.values(), None], pa.int64())
            yield pa.RecordBatch.from_arrays([items, n, pa.array([None] * len(counts) + [error + taken], pa.int64())], names=["item", "n", "error"])

    return df.select(F.col(col).alias("item")).mapInArrow(run, f"item {kind}, n long, error long")


def exact_top_k(df: DataFrame, col: str, count_alias: str, k: int, capacity: int = CAPACITY, candidates: int = CANDIDATES) -> DataFrame:
    """What ``frequency`` returns with ``k``: the most frequent values, the smaller one first of equal ones."""
    found = write_once(summaries(df, col, capacity), "top-k-summaries")
    error = found.agg(F.sum("error")).first()[0] or 0
    added = found.filter("error IS NULL").groupBy("item").agg(F.sum("n").alias("n"))
    least = top_k(added, k, F.desc("n"), "item").agg(F.min("n"), F.count(F.lit(1))).first()
    if least[1] < k and error:
        return frequency(df, col, count_alias, k)
    may_be = write_once(added.filter(F.col("n") + error >= (least[0] or 0)).select("item"), "top-k-candidates")
    if may_be.count() > candidates:
        return frequency(df, col, count_alias, k)
    mine = df.join(F.broadcast(may_be), F.col(col).eqNullSafe(F.col("item")), "left_semi")
    exact = write_once(frequency(mine, col, count_alias, k), "top-k")
    if error and (exact.agg(F.min(count_alias)).first()[0] or 0) <= error:
        return frequency(df, col, count_alias, k)
    return exact.orderBy(F.desc(count_alias), F.asc(col))
