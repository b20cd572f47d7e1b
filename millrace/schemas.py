"""Explicit schemas of the inputs and of the stored tables. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_TYPES = {
    "STRING": StringType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
    "TIMESTAMP_NTZ": TimestampNTZType(),
}


def _table(columns: str) -> StructType:
    """``name TYPE, ...`` as a schema. ``StructType.fromDDL`` would need a running session at import."""
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


SALES_COLUMNS = [
    "order_id", "order_date", "customer_name", "customer_email", "product_name",
    "category", "quantity", "unit_price", "city",
]
RAW_SALES = _table(", ".join(f"{c} STRING" for c in SALES_COLUMNS))

PRICE_PAYLOAD = "MAP<STRING, STRUCT<usd: DOUBLE, usd_market_cap: DOUBLE>>"
DIM_CUSTOMER = _table("customer_id BIGINT, customer_name STRING, customer_email STRING, city STRING")
DIM_PRODUCT = _table("product_id BIGINT, product_name STRING, category STRING, unit_price DOUBLE")
DIM_DATE = _table("date_id INT, full_date DATE, year INT, month INT, day INT, day_of_week STRING")
FACT_SALES = _table(
    "order_id BIGINT, date_id INT, customer_id BIGINT, product_id BIGINT, quantity BIGINT, unit_price DOUBLE,"
    " total_amount DOUBLE"
)

LANDED_PRICES = _table("payload STRING, fetched_at_utc TIMESTAMP")
RAW_PRICES = _table(
    "coin_id STRING, price_usd DOUBLE, market_cap_usd DOUBLE, fetched_at_utc TIMESTAMP"
)
PRICE_REJECTS = _table("payload STRING, fetched_at_utc TIMESTAMP, reject_reason STRING")
PRICE_RUNS = _table("processed BIGINT, late BIGINT, run_at_utc TIMESTAMP")
FACT_PRICES = _table(
    "coin_id STRING, price_usd DOUBLE, market_cap_usd DOUBLE, fetched_at_utc TIMESTAMP,"
    " moving_avg_3 DOUBLE, pct_change_from_prev DOUBLE"
)

LOG_EVENTS = _table(
    "ip_address STRING, event_time TIMESTAMP, event_time_local TIMESTAMP_NTZ, utc_offset STRING,"
    " http_method STRING, path STRING, status_code INT, response_size BIGINT, status_class STRING"
)
LOG_DEAD_LETTERS = _table("raw_line STRING, source_file STRING, run_id STRING")
LOG_HOURS = _table("hour TIMESTAMP_NTZ, requests BIGINT, errors BIGINT")
LOG_SUMMARY = _table(
    "run_id STRING, source_file STRING, total_lines BIGINT, parsed_ok BIGINT, parse_failed BIGINT,"
    " parse_success_rate DOUBLE, run_at_utc TIMESTAMP"
)

RAW_CUSTOMERS = _table(
    "customer_id INT, customer_name STRING, email STRING, signup_date STRING, country STRING"
)
RAW_SUBSCRIPTIONS = _table(
    "subscription_id INT, customer_id INT, plan_type STRING, start_date STRING, end_date STRING,"
    " monthly_price_cents BIGINT, status STRING"
)
RAW_PAYMENTS = _table(
    "payment_id INT, subscription_id INT, payment_date STRING, amount_cents BIGINT, status STRING"
)

# Leaf values are read as text: a quoted number is still a number, and a key that is present but null must be
# told apart from a key that is missing.
READING_PAYLOAD = "current_weather MAP<STRING, STRING>"
LANDED_READINGS = _table("run_id STRING, city_name STRING, payload STRING, fetched_at_utc TIMESTAMP")
FACT_READINGS = _table(
    "city_name STRING, temperature_c DOUBLE, windspeed_kmh DOUBLE, weather_code INT,"
    " observed_at STRING, fetched_at_utc TIMESTAMP"
)
RUN_LOG = _table(
    "run_id STRING, started_at_utc TIMESTAMP, finished_at_utc TIMESTAMP, cities_requested BIGINT,"
    " cities_succeeded BIGINT, cities_failed BIGINT, status STRING"
)

# Marts that are kept up to date by increments. Amounts are whole cents; ``plan_key`` tells plans apart, the null one too.
MRR_CHANGES = _table("plan_key BIGINT, plan_type STRING, month DATE, cents BIGINT, priced BIGINT, active BIGINT")
MRR_LEVELS = MRR_CHANGES
PLAN_DAYS = _table("customer_id BIGINT, start_date DATE, plan_type STRING, subscription_id BIGINT")
PLAN_OPEN = _table("customer_id BIGINT, plan_type STRING, valid_from DATE, last_day DATE, n BIGINT")
PLAN_CLOSED = _table("customer_id BIGINT, plan_type STRING, valid_from DATE, valid_to DATE, n BIGINT")
PLAN_RESETS = _table("customer_id BIGINT, n BIGINT")

PRICE_PROGRESS = _table("coin_id STRING, read_to BIGINT")
