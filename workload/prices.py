"""Prices: every event is a snapshot of its user's value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.rows import keep_latest
from millrace.plans import prices
from millrace.session import empty_table, scratch_path, write_once
from millrace.sources.files import flatten_price_payload, read_landed_json, restrict_to_keys
from millrace.sources.warehouse import Warehouse
from workload import table

CUT = "2024-01-15"


def raw_prices(spark: SparkSession, sf: str) -> DataFrame:
    return as_prices(table(spark, sf, "events"))


def as_prices(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("coin_id"),
        F.col("value").alias("price_usd"),
        (F.col("value") * 1000).alias("market_cap_usd"),
        F.col("ts").alias("fetched_at_utc"),
    )


def _no_state(raw: DataFrame) -> DataFrame:
    schema = prices.state_schema(raw.schema["fetched_at_utc"].dataType, raw.schema["coin_id"].dataType)
    return empty_table(raw.sparkSession, schema)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("moving_avg_3", F.round("moving_avg_3", 6)) if "moving_avg_3" in df.columns else df


def incremental(spark, sf):
    """Two increments, the second continuing from the state the first one left."""
    raw = raw_prices(spark, sf)
    first = write_once(prices.next_increment(raw.filter(F.col("fetched_at_utc") < CUT), _no_state(raw)), "increment")
    state = write_once(prices.state_after(first), "price-state")
    return _rounded(first.unionByName(prices.next_increment(raw, state)))


def late_rows(spark, sf):
    """Every seventh event arrives with the second batch, however old it is; the mark then stands above many of them."""
    second = (F.col("event_id") % 7 == 0) | (F.col("ts") >= CUT)
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("coin_id"),
        F.col("value").alias("price_usd"),
        F.col("ts").alias("fetched_at_utc"),
        second.alias("second_batch"),
    )
    state = prices.state_after(rows.filter(~F.col("second_batch")))
    late = prices.late_rows(rows.filter("second_batch"), state)
    return late.groupBy("coin_id").agg(F.count(F.lit(1)).alias("late_rows"))


def json_flatten(spark, sf):
    """A payload per event with two keys; the second one lacks the market cap."""
    entry = F.struct(F.col("value").alias("usd"), (F.col("value") * 1000).alias("usd_market_cap"))
    peg = F.struct(F.lit(1.0).alias("usd"), F.lit(None).cast("double").alias("usd_market_cap"))
    payload = F.to_json(F.create_map(F.col("user_id").cast("string"), entry, F.lit("peg"), peg))
    landed = table(spark, sf, "events").select(payload.alias("payload"), F.col("ts").alias("fetched_at_utc"))
    return flatten_price_payload(landed)


def landed_insert(spark, sf):
    """Every price lands twice, the second time lower, in a later file; the first row of a key and time stays."""
    events, path = table(spark, sf, "events"), scratch_path(spark, "landed")
    for number, less in enumerate((0, 1)):
        entry = F.struct((F.col("value") - less).alias("usd"), (F.col("value") * 1000).alias("usd_market_cap"))
        payload = F.to_json(F.create_map(F.col("user_id").cast("string"), entry))
        landed = events.select(payload.alias("payload"), F.col("ts").cast("timestamp").alias("fetched_at_utc"))
        landed.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{path}/{number}")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.commit(*prices.load_landed(warehouse, read_landed_json(spark, f"{path}/*", schemas.LANDED_PRICES)))
    return _as_given(warehouse.read("raw_price_snapshot", schemas.RAW_PRICES))


def payload_rejects(spark, sf):
    """Payloads that are missing, no JSON or empty, stored by the load beside the prices."""
    every = lambda n: F.col("event_id") % n == 0
    good = F.to_json(F.create_map(F.col("user_id").cast("string"), F.struct(F.col("value").alias("usd"))))
    payload = F.when(every(11), "<html>").when(every(13), "{}").when(~every(7), good)
    landed = table(spark, sf, "events").select(payload.alias("payload"), F.col("ts").cast("timestamp").alias("fetched_at_utc"))
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.commit(*prices.load_landed(warehouse, landed))
    return _as_given(warehouse.read("price_payload_reject", schemas.PRICE_REJECTS))


def _as_given(stored: DataFrame) -> DataFrame:
    """Keys and times in the types of the events table."""
    columns = {"fetched_at_utc": F.col("fetched_at_utc").cast("timestamp_ntz")}
    if "coin_id" in stored.columns:
        columns["coin_id"] = F.col("coin_id").cast("bigint")
    return stored.withColumns(columns)


def run_increment(spark, sf):
    """The job itself, three times over a growing raw table and once with nothing new, beside a key that never appears."""
    raw = raw_prices(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW_PRICES])
    never = spark.range(1).select(F.lit("never").alias("coin_id"))
    keys = write_once(raw.select("coin_id").distinct().unionByName(never), "wanted-keys")
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    bounds = ["2024-01-01", "2024-01-10", CUT, "9999-01-01"]
    for low, high in zip(bounds, bounds[1:]):
        part = raw.filter((F.col("fetched_at_utc") >= low) & (F.col("fetched_at_utc") < high))
        warehouse.commit(prices.load_snapshots(warehouse, part))
        version = prices.run_increment(warehouse, keys)
    if prices.run_increment(warehouse, keys) != version:
        raise RuntimeError("a run without new rows has published something")
    return _rounded(_as_given(warehouse.read("fact_price_hourly", schemas.FACT_PRICES)))


def moving_avg(spark, sf):
    return _rounded(prices.price_metrics(raw_prices(spark, sf))).drop("pct_change_from_prev", "market_cap_usd")


def pct_change(spark, sf):
    return prices.price_metrics(raw_prices(spark, sf)).drop("moving_avg_3", "market_cap_usd")


def cut_keys(spark, sf):
    """The same metrics over many small ranges, so that nearly every key is cut several times."""
    return _rounded(prices.price_metrics(raw_prices(spark, sf), ranges=400))


def null_times(spark, sf):
    """Two rows in a hundred have lost their time, and every ninth one its key; both have a fixed place in the order."""
    raw = table(spark, sf, "events").select(
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("coin_id"),
        F.col("value").alias("price_usd"),
        F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("fetched_at_utc"),
    )
    return _rounded(prices.price_metrics(raw, ranges=30))


def selected_keys(spark, sf):
    """The snapshots of the keys that ever bought for more than 150."""
    bought = (F.col("event_type") == "purchase") & (F.col("value") > 150)
    keys = table(spark, sf, "events").filter(bought).select(F.col("user_id").alias("coin_id"))
    return restrict_to_keys(raw_prices(spark, sf), "coin_id", keys, [])


QUERIES = {
    "price_moving_avg": moving_avg,
    "price_pct_change": pct_change,
    "price_metrics_cut_keys": cut_keys,
    "price_metrics_null_times": null_times,
    "price_selected_keys": selected_keys,
    "price_incremental": incremental,
    "price_last_two": lambda s, d: keep_latest(raw_prices(s, d), ["coin_id"], ["fetched_at_utc"], n=2),
    "price_watermark_state": lambda s, d: prices.state_after(raw_prices(s, d)),
    "price_latest": lambda s, d: prices.latest_prices(prices.price_metrics(raw_prices(s, d))),
    "price_overview": lambda s, d: prices.overview(raw_prices(s, d)),
    "price_snapshot_counts": lambda s, d: prices.snapshot_counts(raw_prices(s, d)),
    "price_json_flatten": json_flatten,
    "price_late_rows": late_rows,
    "price_landed_insert": landed_insert,
    "price_payload_rejects": payload_rejects,
    "price_run_increment": run_increment,
    "price_alerts": lambda s, d: prices.price_alerts(
        prices.price_metrics(raw_prices(s, d)).drop("moving_avg_3"), threshold_pct=100.0
    ),
}

RAW = """SELECT user_id AS coin_id, value AS price_usd, value * 1000 AS market_cap_usd, ts AS fetched_at_utc FROM events"""
METRICS = f"""
WITH raw AS ({RAW}), lagged AS (
  SELECT *, lag(price_usd) OVER w AS p1, lag(price_usd, 2) OVER w AS p2
  FROM raw WINDOW w AS (PARTITION BY coin_id ORDER BY fetched_at_utc)
), metrics AS (
  SELECT coin_id, price_usd, market_cap_usd, fetched_at_utc,
    round((coalesce(p2, 0) + coalesce(p1, 0) + price_usd)
      / (1 + CASE WHEN p1 IS NULL THEN 0 ELSE 1 END + CASE WHEN p2 IS NULL THEN 0 ELSE 1 END), 6) AS moving_avg_3,
    (price_usd - p1) / nullif(p1, 0) * 100 AS pct_change_from_prev
  FROM lagged
)
"""
_SPOILT = """SELECT CASE WHEN event_id % 9 <> 0 THEN user_id END AS coin_id, value AS price_usd,
  CASE WHEN event_id % 50 <> 0 THEN ts END AS fetched_at_utc FROM events"""
_ORDER = "ORDER BY fetched_at_utc NULLS FIRST, price_usd"
_DIRECTION = """CASE WHEN pct_change_from_prev > 0 THEN 'up' WHEN pct_change_from_prev < 0 THEN 'down' ELSE 'flat' END"""

ORACLE = {
    "price_moving_avg": METRICS + "SELECT coin_id, price_usd, fetched_at_utc, moving_avg_3 FROM metrics",
    "price_pct_change": METRICS + "SELECT coin_id, price_usd, fetched_at_utc, pct_change_from_prev FROM metrics",
    "price_metrics_cut_keys": METRICS + "SELECT * FROM metrics",
    "price_metrics_null_times": METRICS.replace(RAW, _SPOILT).replace("ORDER BY fetched_at_utc", _ORDER).replace(
        "coin_id, price_usd, market_cap_usd,", "coin_id, price_usd,"
    ) + "SELECT * FROM metrics",
    "price_selected_keys": f"""
SELECT * FROM ({RAW}) WHERE coin_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 150)""",
    "price_overview": """
SELECT count(DISTINCT user_id) AS keys, count(*) AS snapshots, max(ts) AS last_refresh FROM events""",
    "price_incremental": METRICS + "SELECT * FROM metrics",
    "price_last_two": f"""SELECT * FROM ({RAW})
QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY fetched_at_utc DESC) <= 2""",
    "price_watermark_state": f"""
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY fetched_at_utc DESC) AS n FROM ({RAW}))
SELECT a.coin_id, a.fetched_at_utc AS last_processed_utc, a.price_usd AS last_price,
  b.fetched_at_utc AS previous_utc, b.price_usd AS previous_price
FROM ranked a LEFT JOIN ranked b ON a.coin_id = b.coin_id AND b.n = 2 WHERE a.n = 1""",
    "price_latest": METRICS + f"""
SELECT coin_id, fetched_at_utc, price_usd, pct_change_from_prev, {_DIRECTION} AS direction FROM metrics
QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY fetched_at_utc DESC) = 1""",
    "price_snapshot_counts": """
SELECT user_id AS coin_id, count(*) AS snapshots, max(ts) AS last_refresh FROM events GROUP BY 1""",
    "price_json_flatten": """
SELECT CAST(user_id AS VARCHAR) AS coin_id, value AS price_usd, value * 1000 AS market_cap_usd, ts AS fetched_at_utc
FROM events UNION ALL SELECT 'peg', 1.0, NULL, ts FROM events""",
    "price_landed_insert": RAW,
    "price_payload_rejects": """
SELECT CASE WHEN event_id % 11 = 0 THEN '<html>' WHEN event_id % 13 = 0 THEN '{}' END AS payload, ts AS fetched_at_utc,
  CASE WHEN event_id % 11 = 0 THEN 'no price map' WHEN event_id % 13 = 0 THEN 'empty price map' ELSE 'no payload' END
    AS reject_reason
FROM events WHERE event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 7 = 0""",
    "price_run_increment": METRICS + "SELECT * FROM metrics",
    "price_late_rows": f"""
WITH arrived AS (SELECT *, event_id % 7 = 0 OR ts >= TIMESTAMP '{CUT}' AS second_batch FROM events),
mark AS (SELECT user_id, max(ts) AS mark FROM arrived WHERE NOT second_batch GROUP BY 1)
SELECT user_id AS coin_id, count(*) AS late_rows FROM arrived JOIN mark USING (user_id)
WHERE second_batch AND ts <= mark GROUP BY 1""",
    "price_alerts": METRICS + f"""
SELECT coin_id, price_usd, market_cap_usd, fetched_at_utc, pct_change_from_prev, {_DIRECTION} AS direction
FROM metrics WHERE abs(pct_change_from_prev) >= 100.0""",
}
