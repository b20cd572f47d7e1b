"""Weather payloads per city to validated readings, rejects with a reason, and a run log.

A bad payload is a row with a reason, never a failed task, so one city cannot stop the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import percent, real_number, run_status
from millrace.operators.rows import compute_once, keep_latest
from millrace.session import write_once
from millrace.sources.warehouse import Change, Warehouse

REQUIRED_FIELDS = ["temperature", "windspeed", "weathercode", "time"]
NOT_NULL = ["city_name", "temperature_c", "windspeed_kmh", "weather_code", "observed_at", "fetched_at_utc"]
READING_KEY = ["city_name", "observed_at"]

# Cities a run covers when it names none, as (name, latitude, longitude).
DEFAULT_CITIES = [
    ("Jakarta", -6.2088, 106.8456),
    ("Bandung", -6.9175, 107.6191),
    ("Surabaya", -7.2575, 112.7521),
    ("Semarang", -6.9932, 110.4203),
    ("Medan", 3.5952, 98.6722),
]


def requested_cities(spark: SparkSession, run_id: str, cities: Sequence[str] | None = None) -> DataFrame:
    """The request list of a run: the given cities or the default ones."""
    names = list(cities or [name for name, _, _ in DEFAULT_CITIES])
    return spark.createDataFrame([(run_id, name) for name in names], "run_id string, city_name string")


def match_requests(landed: DataFrame, requested: DataFrame) -> DataFrame:
    """The payloads a run asked for, and a row without payload for each city that sent none, which counts as failed.

    The landed rows shrink to their distinct keys before they meet the request list; a city sending most of the payloads
    stays where it is.
    """
    key = ["run_id", "city_name"]
    silent = requested.join(landed.select(*key).distinct(), key, "left_anti")
    return landed.join(requested, key, "left_semi").unionByName(silent, allowMissingColumns=True)


def _number(field: str) -> Column:
    text = F.col(f"_x.{field}")
    # The JSON reader hands over a bare NaN or Infinity as quoted text.
    return real_number(F.when(text.startswith('"'), F.btrim(text, F.lit('"'))).otherwise(text))


def parse_readings(landed: DataFrame) -> DataFrame:
    """Add the reading columns and ``reject_reason`` (null for a good reading) to landed payload rows."""
    payload = F.from_json("payload", schemas.READING_PAYLOAD)
    numbers = F.struct(
        _number("temperature").alias("temperature_c"),
        _number("windspeed").alias("windspeed_kmh"),
        _number("weathercode").alias("_code"),
    )
    texts = F.struct(*[F.try_element_at("_w", F.lit(f)).alias(f) for f in REQUIRED_FIELDS])
    parsed = landed
    for name, value in (("_w", payload["current_weather"]), ("_x", texts), ("_n", numbers)):
        parsed = compute_once(parsed, name, value)
    return (
        parsed.select("*", "_n.*", F.col("_x.time").alias("observed_at"))
        .withColumn("reject_reason", _reject_reason())
        .withColumn("weather_code", F.when(_whole_code(), F.col("_code").cast("int")))
        .drop("_w", "_x", "_n", "_code")
    )


def _whole_code() -> Column:
    return ~F.isnan("_code") & (F.abs("_code") < 2**31)


def _reject_reason() -> Column:
    temperature = F.col("temperature_c")
    absent = [F.when(~F.map_contains_key("_w", F.lit(f)), f) for f in REQUIRED_FIELDS]
    unreadable = temperature.isNull() | F.col("windspeed_kmh").isNull() | ~F.coalesce(_whole_code(), F.lit(False))
    return (
        F.when(F.col("payload").isNull(), "no payload")
        .when(F.col("_w").isNull() | (F.size("_w") == 0), "no current_weather")
        .when(F.coalesce(*absent).isNotNull(), F.concat(F.lit("missing "), F.concat_ws(", ", *absent)))
        .when(unreadable, "unreadable value")
        # NaN lies above every number, so the upper bound rejects it too.
        .when(~temperature.between(-90, 60), "temperature out of range")
        .when(F.col("windspeed_kmh") < 0, "negative windspeed")
        .when(F.coalesce("city_name", F.lit("")) == "", "no city name")
    )


def valid_readings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*schemas.FACT_READINGS.names)


def rejects(parsed: DataFrame) -> DataFrame:
    """Dead letters: the payload as it arrived, with the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(
        "run_id", "city_name", "payload", "fetched_at_utc", "reject_reason"
    )


def run_log(parsed: DataFrame) -> DataFrame:
    """One row per run. A city counts once, however many payloads it sent, and succeeded if one of them is good.

    A reading the insert will ignore as a repeat still succeeded.
    """
    per_city = parsed.groupBy("run_id", "city_name").agg(
        F.min("fetched_at_utc").alias("started_at_utc"),
        F.max("fetched_at_utc").alias("finished_at_utc"),
        F.bool_or(F.col("reject_reason").isNull()).alias("good"),
    )
    return (
        per_city.groupBy("run_id")
        .agg(
            F.min("started_at_utc").alias("started_at_utc"),
            F.max("finished_at_utc").alias("finished_at_utc"),
            F.count(F.lit(1)).alias("cities_requested"),
            F.count_if("good").alias("cities_succeeded"),
            F.count_if(~F.col("good")).alias("cities_failed"),
        )
        .withColumn("status", run_status(F.col("cities_succeeded"), F.col("cities_failed")))
    )


def ingest(warehouse: Warehouse, landed: DataFrame) -> list[Change]:
    """Readings inserted if absent, rejects appended, run-log rows replaced. Returns the unpublished changes."""
    parsed = parse_readings(landed)
    # Only rejects need their payload again.
    payload = F.when(F.col("reject_reason").isNotNull(), F.col("payload"))
    parsed = write_once(parsed.withColumn("payload", payload), "parsed-readings")
    readings = valid_readings(parsed)
    return [
        warehouse.insert_if_absent(
            "fact_weather_reading",
            readings,
            READING_KEY,
            ["fetched_at_utc", "temperature_c", "windspeed_kmh", "weather_code"],
            NOT_NULL,
            F.substring("observed_at", 1, 7),
        ),
        warehouse.append("reading_reject", rejects(parsed)),
        warehouse.upsert("pipeline_run_log", run_log(parsed), ["run_id"], ["finished_at_utc"]),
    ]


def latest_per_city(readings: DataFrame) -> DataFrame:
    return keep_latest(readings, ["city_name"], ["fetched_at_utc", "observed_at"])


def temperature_pivot(readings: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Observation times by cities. Of several readings the one that comes last newest-first, i.e. the oldest fetch."""
    return readings.groupBy("observed_at").pivot("city_name", list(cities)).agg(
        F.min_by("temperature_c", "fetched_at_utc")
    )


def run_health(log: DataFrame) -> DataFrame:
    """One row over the run log."""
    newest = F.max_by("status", F.struct("started_at_utc", "run_id"))
    return log.agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "success").alias("healthy_runs"),
        F.count_if(F.col("status") == "partial_failure").alias("partial_runs"),
        F.coalesce(newest, F.lit("unknown")).alias("latest_status"),
    ).withColumn("healthy_rate", percent(F.col("healthy_runs"), F.col("runs")))
