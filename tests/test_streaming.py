from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import prices, weblog
from millrace.sources.files import as_log_lines
from millrace.sources.warehouse import Warehouse
from millrace.streaming.prices import stream_prices
from millrace.streaming.readings import stream_readings
from millrace.streaming.weblog import stream_hours, stream_log
from tests.helpers import rows
from tests.test_readings import payload
from tests.test_weblog import GOOD

T0 = datetime(2024, 1, 1)


def price_rows(spark, batch):
    data = [(k, float(batch * 10 + i), 1.0, T0 + timedelta(hours=batch * 5 + i)) for k in "ab" for i in range(4)]
    return spark.createDataFrame(data, schemas.RAW_PRICES)


def run(start, source, warehouse, progress):
    start(source, warehouse, str(progress)).awaitTermination()


def test_price_stream_equals_one_batch(spark, warehouse, tmp_path):
    inbox = str(tmp_path / "in")
    Path(inbox).mkdir()
    source = spark.readStream.schema(schemas.RAW_PRICES).option("maxFilesPerTrigger", 1).parquet(inbox)
    for batch in range(3):
        price_rows(spark, batch).coalesce(1).write.mode("append").parquet(inbox)
        run(stream_prices, source, warehouse, tmp_path / "progress")
    fact = warehouse.read("fact_price_hourly", schemas.FACT_PRICES)
    everything = spark.read.schema(schemas.RAW_PRICES).parquet(inbox)
    assert rows(fact) == rows(prices.price_metrics(everything).select(*schemas.FACT_PRICES.names))


def test_a_batch_repeated_after_a_crash_counts_once(spark, warehouse, tmp_path, monkeypatch):
    """The batch is published but the stream dies before it notes that: the restart sends the batch again."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.log").write_text(f"{GOOD}\nbroken\n")
    source = as_log_lines(spark.readStream.text(str(inbox)))

    publish = Warehouse.commit

    def publish_and_die(self, *changes, **kwargs):
        publish(self, *changes, **kwargs)
        raise OSError("crash")

    monkeypatch.setattr(Warehouse, "commit", publish_and_die)
    with pytest.raises(Exception, match="crash"):
        run(stream_log, source, warehouse, tmp_path / "progress")
    monkeypatch.undo()
    (inbox / "b.log").write_text(f"{GOOD}\n")
    run(stream_log, source, warehouse, tmp_path / "progress")

    assert warehouse.read("fact_log_event", schemas.LOG_EVENTS).count() == 2
    assert warehouse.read("parse_error_log", schemas.LOG_DEAD_LETTERS).count() == 1
    summary = warehouse.read("pipeline_run_summary", schemas.LOG_SUMMARY)
    assert rows(summary, "source_file", "total_lines", "parsed_ok") == [("a.log", 2, 1), ("b.log", 1, 1)]


def test_reading_stream_inserts_each_observation_once(spark, warehouse, tmp_path):
    inbox = str(tmp_path / "in")
    Path(inbox).mkdir()
    source = spark.readStream.schema(schemas.LANDED_READINGS).parquet(inbox)
    for n, hour in enumerate(("08", "08", "09")):
        landed = [(f"r{n}", "Oslo", payload(time=f"2024-01-10T{hour}:00", temperature=n), T0), (f"r{n}", "Bern", "{}", T0)]
        spark.createDataFrame(landed, schemas.LANDED_READINGS).coalesce(1).write.mode("append").parquet(inbox)
        run(stream_readings, source, warehouse, tmp_path / "progress")
    assert rows(warehouse.read("fact_weather_reading", schemas.FACT_READINGS), "observed_at", "temperature_c") == [
        ("2024-01-10T08:00", 0.0), ("2024-01-10T09:00", 2.0)
    ]
    log = warehouse.read("pipeline_run_log", schemas.RUN_LOG)
    assert log.filter(F.col("status") == "partial_failure").count() == 3


def log_line(hour: int, status: int, day: int = 1, offset: str = "+0700") -> str:
    return f'10.0.0.1 - - [{day:02d}/Jan/2024:{hour:02d}:30:00 {offset}] "GET /x HTTP/1.1" {status} 5'


def test_hours_close_once_and_survive_a_restart(spark, warehouse, tmp_path):
    """Hours wait three hours for late lines; what comes later still is dropped; open ones outlast the stream."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    source = as_log_lines(spark.readStream.option("maxFilesPerTrigger", 1).text(str(inbox)))

    def land_and_run(name, lines):
        (inbox / name).write_text("\n".join(lines) + "\n")
        stream_hours(source, warehouse, str(tmp_path / "progress"), "3 hours").awaitTermination()
        stored = warehouse.read("fact_log_hour", schemas.LOG_HOURS)
        return {r.hour.hour + 24 * (r.hour.day - 1): (r.requests, r.errors) for r in stored.collect()}

    assert land_and_run("1.log", [log_line(1, 200), log_line(2, 500, offset="Z"), "broken"]) == {}
    assert land_and_run("2.log", [log_line(1, 404), log_line(5, 200)]) == {1: (2, 1)}
    late = [log_line(1, 500), log_line(2, 200), log_line(9, 200), log_line(9, 500, offset="+0530")]
    assert land_and_run("3.log", late) == {1: (2, 1), 2: (2, 1), 5: (1, 0)}
    assert land_and_run("4.log", [log_line(0, 200, day=2)]) == {1: (2, 1), 2: (2, 1), 5: (1, 0), 9: (2, 1)}
    alerts = weblog.alerts_of(warehouse.read("fact_log_hour", schemas.LOG_HOURS), 20.0)
    assert sorted((r.hour.hour, r.error_rate) for r in alerts.collect()) == [(1, 50.0), (2, 50.0), (9, 50.0)]
