from __future__ import annotations

import json
from datetime import datetime

import pytest

from millrace import schemas
from millrace.plans import readings
from tests.helpers import rows

AT = datetime(2024, 1, 10, 8)


def payload(**changes):
    fields = {"temperature": 31.5, "windspeed": 12.3, "weathercode": 1, "time": "2024-01-10T08:00"} | changes
    return json.dumps({"latitude": 1.0, "current_weather": fields})


def land(spark, *data, run="r1"):
    return spark.createDataFrame([(run, city, text, AT) for city, text in data], schemas.LANDED_READINGS)


def reason(spark, text, city="Oslo"):
    return readings.parse_readings(land(spark, (city, text))).first().reject_reason


def test_good_reading(spark):
    r = readings.parse_readings(land(spark, ("Oslo", payload()))).first()
    assert (r.temperature_c, r.windspeed_kmh, r.weather_code, r.observed_at) == (31.5, 12.3, 1, "2024-01-10T08:00")
    assert r.reject_reason is None


@pytest.mark.parametrize(
    "changes", [{"temperature": "31.5"}, {"temperature": -90}, {"temperature": 60}, {"windspeed": 0}, {"weathercode": "3"}]
)
def test_accepted_values(spark, changes):
    assert reason(spark, payload(**changes)) is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{}", "no current_weather"),
        ("<html>", "no current_weather"),
        ('{"current_weather": {}}', "no current_weather"),
        ('{"current_weather": null}', "no current_weather"),
        ('{"current_weather": [1]}', "no current_weather"),
        ('{"current_weather": {"temperature": 30}}', "missing windspeed, weathercode, time"),
        (payload(temperature=None), "unreadable value"),
        (payload(windspeed="fast"), "unreadable value"),
        (payload(weathercode=None), "unreadable value"),
        (payload(weathercode=float("nan")), "unreadable value"),
        (payload(temperature=999), "temperature out of range"),
        (payload(temperature=-90.1), "temperature out of range"),
        (payload(temperature=float("nan")), "temperature out of range"),
        (payload(windspeed=-5), "negative windspeed"),
    ],
)
def test_rejected_values(spark, text, expected):
    assert reason(spark, text) == expected


def test_a_city_needs_a_name(spark):
    assert reason(spark, payload(), city="") == "no city name"
    assert reason(spark, payload(), city=None) == "no city name"


def ingest(warehouse, landed):
    warehouse.commit(*readings.ingest(warehouse, landed))


def read(warehouse, *columns):
    return rows(warehouse.read("fact_weather_reading", schemas.FACT_READINGS), *columns)


def run_log(warehouse):
    return rows(
        warehouse.read("pipeline_run_log", schemas.RUN_LOG), "run_id", "cities_requested", "cities_succeeded",
        "cities_failed", "status",
    )


def test_insert_twice_and_one_bad_city(spark, warehouse):
    ingest(warehouse, land(spark, ("Oslo", payload()), ("Oslo", payload()), ("Bern", "{}")))
    ingest(warehouse, land(spark, ("Oslo", payload(temperature=1)), run="r2"))
    ingest(warehouse, land(spark, ("Bern", "{}"), run="r3"))
    assert read(warehouse, "city_name", "temperature_c") == [("Oslo", 31.5)]
    assert run_log(warehouse) == [
        ("r1", 2, 1, 1, "partial_failure"), ("r2", 1, 1, 0, "success"), ("r3", 1, 0, 1, "failed")
    ]
    health = readings.run_health(warehouse.read("pipeline_run_log", schemas.RUN_LOG)).first()
    assert (health.runs, health.healthy_runs, health.partial_runs, health.latest_status) == (3, 1, 1, "failed")


def test_a_city_that_sends_nothing_counts_as_failed(spark, warehouse):
    landed = land(spark, ("Oslo", payload()), ("Rome", payload()))
    requested = readings.requested_cities(spark, "r1", ["Oslo", "Bern"])
    ingest(warehouse, readings.match_requests(landed, requested))
    assert read(warehouse, "city_name") == [("Oslo",)], "a city nobody asked for is left out"
    assert run_log(warehouse) == [("r1", 2, 1, 1, "partial_failure")]
    assert readings.requested_cities(spark, "r1").count() == 5


def test_a_repeated_run_replaces_its_log_row(spark, warehouse):
    for text in ("{}", payload()):
        ingest(warehouse, land(spark, ("Oslo", text)))
    assert run_log(warehouse) == [("r1", 1, 1, 0, "success")]


def test_values_the_table_cannot_hold_are_skipped_but_succeed(spark, warehouse):
    ingest(warehouse, land(spark, ("Oslo", payload(time=None)), ("Bern", payload(windspeed=float("nan")))))
    assert read(warehouse) == [] and run_log(warehouse)[0][2:] == (2, 0, "success")


def test_rejects_keep_payload_and_reason(spark):
    parsed = readings.parse_readings(land(spark, ("Oslo", payload(temperature=99)), ("Bern", payload())))
    assert rows(readings.rejects(parsed), "city_name", "payload", "reject_reason") == [
        ("Oslo", payload(temperature=99), "temperature out of range")
    ]


def test_reports(spark, warehouse):
    later = payload(time="2024-01-10T09:00", temperature=20)
    ingest(warehouse, land(spark, ("Oslo", payload()), ("Bern", payload(temperature=5)), ("Oslo", later)))
    stored = warehouse.read("fact_weather_reading", schemas.FACT_READINGS)
    assert rows(readings.latest_per_city(stored), "city_name", "temperature_c") == [("Bern", 5.0), ("Oslo", 20.0)]
    assert rows(readings.temperature_pivot(stored, ["Bern", "Oslo"])) == [
        ("2024-01-10T08:00", 5.0, 31.5), ("2024-01-10T09:00", None, 20.0)
    ]
    empty = readings.run_health(warehouse.read("none", schemas.RUN_LOG)).first()
    assert (empty.runs, empty.healthy_rate, empty.latest_status) == (0, 0.0, "unknown")
