"""Continuous log ingest with dead letters and a summary per batch and file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.plans import weblog
from millrace.sources.warehouse import Warehouse
from millrace.streaming import start_batches


def stream_log(
    lines: DataFrame, warehouse: Warehouse, checkpoint: str, name: str = "weblog", trigger: dict | None = None
) -> StreamingQuery:
    """``lines`` is a streaming frame of ``(raw_line, source_file)``, see ``as_log_lines``."""

    def job(batch: DataFrame, batch_id: int) -> None:
        changes = weblog.ingest(warehouse, batch, f"{name}-{batch_id}", F.current_timestamp())
        warehouse.commit(*changes, batch=(name, batch_id))

    return start_batches(lines, warehouse, name, checkpoint, job, trigger)


def stream_hours(
    lines: DataFrame, warehouse: Warehouse, checkpoint: str, delay: str, name: str = "loghours", trigger: dict | None = None
) -> StreamingQuery:
    """Append every hour to ``fact_log_hour`` once it is over, ``delay`` included, see ``weblog.closing_hours``.

    Hours still open live in the state store of the checkpoint, so a restart goes on with them.
    """
    hours = weblog.closing_hours(weblog.events(weblog.parse_combined(lines)), delay)

    def job(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date("hour").cast("string")
        warehouse.commit(warehouse.append("fact_log_hour", batch, day), batch=(name, batch_id))

    return start_batches(hours, warehouse, name, checkpoint, job, trigger)
