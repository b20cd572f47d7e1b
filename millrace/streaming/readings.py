"""Continuous insert-if-absent of readings, exact over the whole history rather than within a horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.plans import readings
from millrace.sources.warehouse import Warehouse
from millrace.streaming import start_batches


def stream_readings(
    landed: DataFrame, warehouse: Warehouse, checkpoint: str, name: str = "readings", trigger: dict | None = None
) -> StreamingQuery:
    def job(batch: DataFrame, batch_id: int) -> None:
        warehouse.commit(*readings.ingest(warehouse, batch), batch=(name, batch_id))

    return start_batches(landed, warehouse, name, checkpoint, job, trigger)
