"""Structured Streaming variants of the incremental jobs.

Each one hands its micro-batches to the batch job, so stream and batch cannot drift apart. Every batch publishes with its
number, and a batch that a restarted stream repeats is recognised and left out: the tables see each batch exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.warehouse import Warehouse


def start_batches(
    source: DataFrame, warehouse: Warehouse, name: str, checkpoint: str, job: Callable[[DataFrame, int], None],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``job`` on every new micro-batch of ``source``; by default on all available data, then stop."""

    def once(batch: DataFrame, batch_id: int) -> None:
        if not warehouse.seen(name, batch_id):
            job(batch, batch_id)

    return (
        source.writeStream.foreachBatch(once)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
