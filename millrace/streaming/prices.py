"""Continuous price increments.

The mark of a key is the newest processed time of that key. It is not Spark's event-time watermark, which is one value per
stream and tolerates delay; a row at or below its key's mark is never processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.prices import process_arrivals
from millrace.sources.warehouse import Warehouse
from millrace.streaming import start_batches


def stream_prices(
    snapshots: DataFrame, warehouse: Warehouse, checkpoint: str, name: str = "prices", trigger: dict | None = None
) -> StreamingQuery:
    def job(batch: DataFrame, batch_id: int) -> None:
        process_arrivals(warehouse, batch, (name, batch_id))

    return start_batches(snapshots, warehouse, name, checkpoint, job, trigger)
