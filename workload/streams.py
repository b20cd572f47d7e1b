"""The streaming jobs, fed from the events table; each must end up with what its batch job computes in one go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import prices, weblog
from millrace.session import scratch_path
from millrace.sources.warehouse import Warehouse
from millrace.streaming.prices import stream_prices
from millrace.streaming.readings import stream_readings
from millrace.streaming.weblog import stream_hours, stream_log
from workload import logs, table, weather
from workload import prices as prices_map


BATCHES = 5
FILES = 4  # of a batch
DELAY_DAYS = 2
RESTART = 3  # batches that the hourly stream has taken when it is stopped and started again


def _batch_of(days: int = 6):
    """Events come in five batches, one for six days each."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return F.least(F.lit(BATCHES - 1), F.greatest(F.lit(0), F.floor(day / days))).cast("int")


def _land(arrivals: DataFrame, inbox: str, numbers) -> None:
    """Write the rows of each ``_batch`` as files of their own, one batch after the other."""
    for number in numbers:
        arrivals.filter(F.col("_batch") == number).drop("_batch").repartition(FILES).write.parquet(f"{inbox}/batch={number}")


def _opened(spark: SparkSession, inbox: str, schema) -> DataFrame:
    """A stream of the landed files, batch by batch in the order they were written."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(f"{inbox}/*")


def _source(spark: SparkSession, sf: str, repeats: bool = True) -> DataFrame:
    """The events as a stream of five batches. With ``repeats`` every eleventh event comes again with the next batch."""
    events = table(spark, sf, "events")
    inbox = scratch_path(spark, "stream-inbox")
    arrivals = events.withColumn("_batch", _batch_of())
    if repeats:
        again = arrivals.filter(F.col("event_id") % 11 == 0).withColumn("_batch", F.col("_batch") + 1)
        arrivals = arrivals.unionByName(again.filter(F.col("_batch") < BATCHES))
    _land(arrivals, inbox, range(BATCHES))
    return _opened(spark, inbox, events.schema)


def _run(spark: SparkSession, start, rows: DataFrame) -> Warehouse:
    """Run a stream over all there is, into a warehouse of its own, and see that it took a commit for each batch."""
    warehouse = Warehouse(spark, scratch_path(spark, "stream-warehouse"))
    start(rows, warehouse, scratch_path(spark, "stream-progress")).awaitTermination()
    if warehouse.version() < BATCHES:
        raise RuntimeError(f"{warehouse.version()} commits for {BATCHES} batches")
    return warehouse


def _price_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    rows = prices_map.as_prices(_source(spark, sf)).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.RAW_PRICES]
    )
    return _run(spark, stream_prices, rows)


def price_stream(spark, sf):
    fact = _price_warehouse(spark, sf).read("fact_price_hourly", schemas.FACT_PRICES)
    return fact.withColumns(
        {
            "coin_id": F.col("coin_id").cast("bigint"),
            "fetched_at_utc": F.col("fetched_at_utc").cast("timestamp_ntz"),
            "moving_avg_3": F.round("moving_avg_3", 6),
        }
    )


def price_stream_state(spark, sf):
    """The state that five batches have upserted, key by key."""
    state = prices.read_state(_price_warehouse(spark, sf))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("last_processed_utc", "previous_utc")}
    return state.withColumns(times | {"coin_id": F.col("coin_id").cast("bigint")})


def log_stream(spark, sf):
    stored = _run(spark, stream_log, logs.log_lines(_source(spark, sf, repeats=False)))
    return logs.shown(stored.read("fact_log_event", schemas.LOG_EVENTS))


def log_stream_summary(spark, sf):
    stored = _run(spark, stream_log, logs.log_lines(_source(spark, sf, repeats=False)))
    return stored.read("pipeline_run_summary", schemas.LOG_SUMMARY).drop("run_id", "run_at_utc")


def log_stream_hours(spark, sf):
    """Hours that are over, of a stream in which every thirteenth line comes one batch late; it is restarted on the way."""
    events = table(spark, sf, "events")
    late = F.when(F.col("event_id") % 13 == 0, 1).otherwise(0)
    arrivals = events.withColumn("_batch", F.least(F.lit(BATCHES - 1), _batch_of() + late))
    inbox, progress = scratch_path(spark, "stream-inbox"), scratch_path(spark, "stream-progress")
    warehouse = Warehouse(spark, scratch_path(spark, "stream-warehouse"))
    for numbers in (range(RESTART), range(RESTART, BATCHES)):
        _land(arrivals, inbox, numbers)
        lines = logs.log_lines(_opened(spark, inbox, events.schema))
        stream_hours(lines, warehouse, progress, f"{DELAY_DAYS} days").awaitTermination()
    return warehouse.read("fact_log_hour", schemas.LOG_HOURS)


def _reading_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    rows = weather.landed(_source(spark, sf)).withColumn("fetched_at_utc", F.col("fetched_at_utc").cast("timestamp"))
    return _run(spark, stream_readings, rows)


def reading_stream(spark, sf):
    fact = _reading_warehouse(spark, sf).read("fact_weather_reading", schemas.FACT_READINGS)
    return fact.withColumn("fetched_at_utc", F.col("fetched_at_utc").cast("timestamp_ntz"))


def reading_stream_run_log(spark, sf):
    """The run log after all batches: a run that a later batch touches again shows what that batch held of it."""
    log = _reading_warehouse(spark, sf).read("pipeline_run_log", schemas.RUN_LOG)
    return log.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at_utc", "finished_at_utc")})


QUERIES = {
    "price_stream": price_stream,
    "log_stream": log_stream,
    "log_stream_summary": log_stream_summary,
    "log_stream_hours": log_stream_hours,
    "log_stream_alerts": lambda s, d: weblog.alerts_of(log_stream_hours(s, d), threshold_pct=60.0),
    "price_stream_state": price_stream_state,
    "wx_stream": reading_stream,
    "wx_stream_run_log": reading_stream_run_log,
}

_ARRIVALS = """(
  WITH numbered AS (
    SELECT *, least(4, greatest(0, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 6)) AS batch FROM events
  )
  SELECT * FROM numbered UNION ALL
  SELECT * REPLACE (batch + 1 AS batch) FROM numbered WHERE event_id % 11 = 0 AND batch < 4
)"""
_LAST = f"(SELECT * FROM {_ARRIVALS} QUALIFY batch = max(batch) OVER (PARTITION BY strftime(ts, '%Y%m%d')))"
# An hour is handed on with the first batch before which the newest line is two days past its end, or when the stream stops
# before that batch; what comes later for it is dropped.
_HOURS = f"""{logs.FIELDS}
, arrived AS (
  SELECT s.hour, s.status_class, date_trunc('second', f.ts) AS clock,
    least({BATCHES - 1}, least({BATCHES - 1}, greatest(0, datediff('day', DATE '2024-01-01', CAST(f.ts AS DATE)) // 6))
      + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) AS batch
  FROM shown s JOIN fields f USING (event_id) WHERE f.parsed
), marks AS (
  SELECT b AS batch, max(clock) - INTERVAL {DELAY_DAYS} DAY AS mark
  FROM (SELECT unnest(range(1, {BATCHES + 1})) AS b), arrived WHERE arrived.batch < b GROUP BY b
), closing AS (
  SELECT hour, min(m.batch) AS closed FROM (SELECT DISTINCT hour FROM arrived), marks m WHERE mark >= hour + INTERVAL 1 HOUR GROUP BY hour
), hours AS (
  SELECT hour, count(*) AS requests, count(*) FILTER (status_class <> 'success') AS errors
  FROM arrived JOIN closing USING (hour) WHERE batch <= closed - CASE WHEN closed = {RESTART} THEN 1 ELSE 0 END GROUP BY hour
)
"""

ORACLE = {
    "log_stream_hours": _HOURS + "SELECT * FROM hours",
    "log_stream_alerts": _HOURS + """
SELECT *, CAST(errors AS DOUBLE) / requests * 100 AS error_rate FROM hours WHERE error_rate > 60""",
    "price_stream": prices_map.ORACLE["price_incremental"],
    "log_stream": logs.ORACLE["log_parse_events"],
    "log_stream_summary": f"SELECT * EXCLUDE (run_id) FROM ({logs.ORACLE['log_run_summary']})",
    "price_stream_state": prices_map.ORACLE["price_watermark_state"],
    "wx_stream": weather.ORACLE["wx_insert_if_absent"],
    "wx_stream_run_log": weather.ORACLE["wx_run_log"].replace("FROM events", f"FROM {_LAST}"),
}
