"""Readings: every event is a payload of its event type's city; a run is a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import readings
from millrace.sources.warehouse import absent_rows, admissible_rows
from workload import table

CUT = "2024-01-15"
# The cities.
CITIES = ["click", "error", "purchase", "signup", "view"]


def _every(n: int):
    return F.col("event_id") % n == 0


def landed(events: DataFrame) -> DataFrame:
    """Payloads with empty objects, missing fields, nulls, quoted numbers, NaN, garbage and values out of range."""
    temperature = (
        F.when(_every(29), "null")
        .when(_every(37), F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        .when(_every(41), "NaN")
        .otherwise((F.col("value") / 4).cast("string"))
    )
    wind = (F.get_json_object("props", "$.k").cast("int") - 5).cast("string")
    minute = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    full = F.concat(
        F.lit('{"latitude": 1.5, "current_weather": {"temperature": '), temperature, F.lit(', "windspeed": '), wind,
        F.lit(', "weathercode": '), (F.col("event_id") % 100).cast("string"), F.lit(', "time": "'), minute, F.lit('"}}'),
    )
    partial = F.concat(F.lit('{"current_weather": {"temperature": '), F.col("value").cast("string"), F.lit(', "weathercode": 1}}'))
    payload = F.when(_every(19), "{}").when(_every(23), partial).when(_every(31), "<html>").otherwise(full)
    return events.select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.when(~_every(43), F.col("event_type")).otherwise("").alias("city_name"),
        payload.alias("payload"),
        F.col("ts").alias("fetched_at_utc"),
    )


def parsed(s, d):
    return readings.parse_readings(landed(table(s, d, "events")))


ORDER = ["fetched_at_utc", "temperature_c", "windspeed_kmh", "weather_code"]


def fact(s, d):
    return admissible_rows(readings.valid_readings(parsed(s, d)), readings.READING_KEY, ORDER, readings.NOT_NULL)


def insert_if_absent(s, d):
    """The first half of the month is stored; a batch of the whole month arrives."""
    stored = fact(s, d).filter(F.col("fetched_at_utc") < CUT)
    arriving = readings.valid_readings(parsed(s, d))
    return stored.unionByName(absent_rows(stored, arriving, readings.READING_KEY, ORDER, readings.NOT_NULL))


def requested_run_log(s, d):
    """Every daily run asks for the five cities and for one that never answers."""
    rows = landed(table(s, d, "events"))
    wanted = F.explode(F.array(*[F.lit(c) for c in [*CITIES, "harbour"]]))
    requested = rows.select("run_id").distinct().select("run_id", wanted.alias("city_name"))
    return readings.run_log(readings.parse_readings(readings.match_requests(rows, requested)))


QUERIES = {
    "wx_parse_validate": lambda s, d: parsed(s, d).drop("payload"),
    "wx_rejects": lambda s, d: readings.rejects(parsed(s, d)).drop("payload"),
    "wx_insert_if_absent": insert_if_absent,
    "wx_latest_per_city": lambda s, d: readings.latest_per_city(fact(s, d)),
    "wx_temperature_pivot": lambda s, d: readings.temperature_pivot(fact(s, d), CITIES),
    "wx_run_log": lambda s, d: readings.run_log(parsed(s, d)),
    "wx_requested_run_log": requested_run_log,
    "wx_run_health": lambda s, d: readings.run_health(readings.run_log(parsed(s, d))),
}

_PARSED = """
WITH landed AS (
  SELECT strftime(ts, '%Y%m%d') AS run_id, CASE WHEN event_id % 43 = 0 THEN '' ELSE event_type END AS city_name,
    ts AS fetched_at_utc, event_id % 19 = 0 OR (event_id % 23 <> 0 AND event_id % 31 = 0) AS empty,
    event_id % 23 = 0 AS partial, event_id % 29 = 0 AS nothing, event_id % 37 = 0 AS quoted, event_id % 41 = 0 AS nan,
    value, CAST(json_extract(props, '$.k') AS DOUBLE) - 5 AS wind, CAST(event_id % 100 AS INTEGER) AS code,
    strftime(ts, '%Y-%m-%dT%H:%M') AS minute
  FROM events
), fields AS (
  SELECT run_id, city_name, fetched_at_utc, empty, NOT empty AND partial AS partial,
    CASE WHEN empty THEN NULL WHEN partial THEN value WHEN nothing THEN NULL WHEN quoted THEN value
      WHEN nan THEN CAST('NaN' AS DOUBLE) ELSE value / 4 END AS temperature_c,
    CASE WHEN NOT empty AND NOT partial THEN wind END AS windspeed_kmh,
    CASE WHEN empty THEN NULL WHEN partial THEN 1 ELSE code END AS weather_code,
    CASE WHEN NOT empty AND NOT partial THEN minute END AS observed_at
  FROM landed
), parsed AS (
  SELECT run_id, city_name, fetched_at_utc, temperature_c, windspeed_kmh, weather_code, observed_at,
    CASE WHEN empty THEN 'no current_weather' WHEN partial THEN 'missing windspeed, time'
      WHEN temperature_c IS NULL THEN 'unreadable value'
      WHEN isnan(temperature_c) OR temperature_c NOT BETWEEN -90 AND 60 THEN 'temperature out of range'
      WHEN windspeed_kmh < 0 THEN 'negative windspeed' WHEN city_name = '' THEN 'no city name' END AS reject_reason
  FROM fields
), fact AS (
  SELECT city_name, temperature_c, windspeed_kmh, weather_code, observed_at, fetched_at_utc FROM parsed
  WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY city_name, observed_at
    ORDER BY fetched_at_utc, temperature_c, windspeed_kmh, weather_code) = 1
), cities AS (
  SELECT run_id, city_name, min(fetched_at_utc) AS first_fetch, max(fetched_at_utc) AS last_fetch,
    count(*) > count(reject_reason) AS good
  FROM parsed GROUP BY 1, 2
), run_log AS (
  SELECT run_id, min(first_fetch) AS started_at_utc, max(last_fetch) AS finished_at_utc,
    count(*) AS cities_requested, count(*) FILTER (good) AS cities_succeeded, count(*) FILTER (NOT good) AS cities_failed,
    CASE WHEN bool_and(good) THEN 'success' WHEN bool_or(good) THEN 'partial_failure' ELSE 'failed' END AS status
  FROM cities GROUP BY 1
)
"""
_PIVOT = ", ".join(f"max(temperature_c) FILTER (city_name = '{c}') AS \"{c}\"" for c in CITIES)

ORACLE = {
    "wx_parse_validate": _PARSED + "SELECT * FROM parsed",
    "wx_rejects": _PARSED + """
SELECT run_id, city_name, fetched_at_utc, reject_reason FROM parsed WHERE reject_reason IS NOT NULL""",
    "wx_insert_if_absent": _PARSED + "SELECT * FROM fact",
    "wx_latest_per_city": _PARSED + """
SELECT * FROM fact
QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY fetched_at_utc DESC, observed_at DESC) = 1""",
    "wx_temperature_pivot": _PARSED + f"SELECT observed_at, {_PIVOT} FROM fact GROUP BY 1",
    "wx_run_log": _PARSED + "SELECT * FROM run_log",
    "wx_requested_run_log": _PARSED + f"""
, asked AS (
  SELECT * FROM parsed WHERE city_name <> ''
  UNION ALL BY NAME SELECT run_id, city AS city_name, 'no payload' AS reject_reason
  FROM (SELECT DISTINCT run_id FROM parsed) r, (SELECT unnest({[*CITIES, "harbour"]}) AS city)
  WHERE NOT EXISTS (SELECT 1 FROM parsed p WHERE p.run_id = r.run_id AND p.city_name = city)
)
SELECT run_id, min(first_fetch) AS started_at_utc, max(last_fetch) AS finished_at_utc,
  count(*) AS cities_requested, count(*) FILTER (good) AS cities_succeeded, count(*) FILTER (NOT good) AS cities_failed,
  CASE WHEN bool_or(good) THEN 'partial_failure' ELSE 'failed' END AS status
FROM (
  SELECT run_id, city_name, min(fetched_at_utc) AS first_fetch, max(fetched_at_utc) AS last_fetch,
    count(*) > count(reject_reason) AS good
  FROM asked GROUP BY 1, 2
) GROUP BY 1""",
    "wx_run_health": _PARSED + """
SELECT count(*) AS runs, count(*) FILTER (status = 'success') AS healthy_runs,
  count(*) FILTER (status = 'partial_failure') AS partial_runs,
  (SELECT status FROM run_log ORDER BY started_at_utc DESC, run_id DESC LIMIT 1) AS latest_status,
  CAST(count(*) FILTER (status = 'success') AS DOUBLE) / count(*) * 100 AS healthy_rate
FROM run_log""",
}
