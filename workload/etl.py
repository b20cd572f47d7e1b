"""Keyed writes: a stored part of the events meets an overlapping batch with repeats and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources.warehouse import Warehouse, absent_rows, replace_on_key
from workload.prices import raw_prices

KEYS = ["coin_id", "fetched_at_utc"]
STORED_UNTIL, BATCH_FROM = "2024-01-20", "2024-01-10"


def _batch(spark, sf):
    """Prices raised by 1, some missing, some NaN; every expensive row comes a second time, raised by 2."""
    raw = raw_prices(spark, sf)
    stored = raw.filter(F.col("fetched_at_utc") < STORED_UNTIL)
    price = F.col("price_usd")
    spoilt = F.when(price > 480, F.lit(float("nan"))).when(price >= 5, price + 1)
    fresh = raw.filter(F.col("fetched_at_utc") >= BATCH_FROM)
    once = fresh.withColumn("price_usd", spoilt).withColumn("seq", F.lit(1))
    again = fresh.filter(price > 400).withColumn("price_usd", price + 2).withColumn("seq", F.lit(2))
    return stored, once.unionByName(again)


def insert_if_absent(spark, sf):
    stored, batch = _batch(spark, sf)
    new = absent_rows(stored, batch, KEYS, ["seq"], ["coin_id", "price_usd", "fetched_at_utc"])
    return stored.unionByName(new.drop("seq"))


def upsert_replace(spark, sf):
    stored, batch = _batch(spark, sf)
    valid = batch.filter(F.col("price_usd").isNotNull() & ~F.isnan("price_usd"))
    return replace_on_key(stored, valid, KEYS, ["seq"])


def _day():
    return F.to_date("fetched_at_utc").cast("string")


def stored_insert(spark, sf):
    """The same through a warehouse: stored, published, inserted, published, read back."""
    stored, batch = _batch(spark, sf)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.commit(warehouse.append("prices", stored, _day()))
    required = ["coin_id", "price_usd", "fetched_at_utc"]
    warehouse.commit(warehouse.insert_if_absent("prices", batch, KEYS, ["seq"], required, _day()))
    return warehouse.read("prices", stored.schema)


def stored_upsert(spark, sf):
    """Replace on key through a warehouse; ``seq`` is kept to tell which row of the batch won."""
    stored, batch = _batch(spark, sf)
    valid = batch.filter(F.col("price_usd").isNotNull() & ~F.isnan("price_usd"))
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.commit(warehouse.append("prices", stored.withColumn("seq", F.lit(0)), _day()))
    warehouse.commit(warehouse.upsert("prices", valid, KEYS, ["seq"], _day()))
    return warehouse.read("prices", valid.schema)


QUERIES = {
    "etl_insert_if_absent": insert_if_absent,
    "etl_upsert_replace": upsert_replace,
    "etl_stored_insert": stored_insert,
    "etl_stored_upsert": stored_upsert,
}

_BATCH = f"""
WITH raw AS (
  SELECT user_id AS coin_id, value AS price_usd, value * 1000 AS market_cap_usd, ts AS fetched_at_utc FROM events
), stored AS (SELECT * FROM raw WHERE fetched_at_utc < TIMESTAMP '{STORED_UNTIL}'),
batch AS (
  SELECT coin_id, price_usd + 1 AS price_usd, market_cap_usd, fetched_at_utc, 1 AS seq FROM raw
  WHERE fetched_at_utc >= TIMESTAMP '{BATCH_FROM}' AND price_usd BETWEEN 5 AND 480
  UNION ALL
  SELECT coin_id, price_usd + 2, market_cap_usd, fetched_at_utc, 2 FROM raw
  WHERE fetched_at_utc >= TIMESTAMP '{BATCH_FROM}' AND price_usd > 400
)
"""
_RANK = "QUALIFY row_number() OVER (PARTITION BY coin_id, fetched_at_utc ORDER BY seq {}) = 1"
_COLUMNS = "coin_id, price_usd, market_cap_usd, fetched_at_utc"

ORACLE = {
    "etl_insert_if_absent": _BATCH + f"""
SELECT * FROM stored UNION ALL
SELECT {_COLUMNS} FROM (SELECT * FROM batch {_RANK.format('ASC')}) b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.coin_id = b.coin_id AND s.fetched_at_utc = b.fetched_at_utc)""",
    "etl_upsert_replace": _BATCH + f"""
SELECT {_COLUMNS} FROM (SELECT * FROM batch {_RANK.format('DESC')}) UNION ALL
SELECT * FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE s.coin_id = b.coin_id AND s.fetched_at_utc = b.fetched_at_utc)""",
}
ORACLE["etl_stored_insert"] = ORACLE["etl_insert_if_absent"]
ORACLE["etl_stored_upsert"] = _BATCH + f"""
SELECT {_COLUMNS}, seq FROM (SELECT * FROM batch {_RANK.format('DESC')}) UNION ALL
SELECT s.*, 0 FROM stored s
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE s.coin_id = b.coin_id AND s.fetched_at_utc = b.fetched_at_utc)"""
