from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import weblog
from millrace.sources.files import read_log_lines
from tests.helpers import rows

GOOD = '10.1.2.3 - - [10/Jan/2024:08:15:22 +0700] "GET /a/b?x=1 HTTP/1.1" 200 512 "-" "Agent"'


def parse(spark, *lines):
    df = spark.createDataFrame([(line, "f.log") for line in lines], "raw_line string, source_file string")
    return weblog.parse_combined(df)


def test_valid_line(spark):
    r = parse(spark, GOOD).withColumn("iso", weblog.iso_time()).withColumn("epoch", F.unix_seconds("event_time")).first()
    assert r.parsed and (r.ip_address, r.http_method, r.path, r.status_code, r.response_size, r.status_class) == (
        "10.1.2.3", "GET", "/a/b?x=1", 200, 512, "success"
    )
    assert r.iso == "2024-01-10T08:15:22+07:00" and r.epoch == 1704849322
    assert r.event_time_local == datetime(2024, 1, 10, 8, 15, 22) and r.utc_offset == "+07:00"


@pytest.mark.parametrize(
    "line",
    [
        GOOD.replace("+0700", "+07:00"),
        GOOD.replace("22 +0700", "22   +0700"),
        GOOD.replace("Jan", "jAN"),
        "\t " + GOOD + "  ",
        GOOD.replace("10/Jan", "9/Jan"),
        GOOD.replace("08:15", "8:15"),
        GOOD[: GOOD.index("512") + 3],
        GOOD.replace("512", "-"),
        GOOD.replace("512", "512garbage\x01 more"),
        GOOD.replace("/a/b", "/\x01\x02"),
        GOOD.replace("- -", "ident user"),
        GOOD.replace("+0700", "Z"),
    ],
)
def test_accepted_variants(spark, line):
    r = parse(spark, line).first()
    assert r.parsed and r.status_code == 200 and r.http_method == "GET"
    assert r.response_size == (None if " 200 -" in line else 512)


@pytest.mark.parametrize(
    "line",
    [
        "no log line at all",
        GOOD.replace("10/Jan", "31/Feb"),
        GOOD.replace("10/Jan", "32/Jan"),
        GOOD.replace("Jan", "Foo"),
        GOOD.replace("08:15:22", "25:15:22"),
        GOOD.replace("08:15:22", "08:61:22"),
        GOOD.replace(" +0700", ""),
        GOOD.replace("GET", "get"),
        GOOD.replace("200", "20"),
        GOOD.replace("HTTP/1.1", "FTP/1.1"),
        GOOD.replace("/a/b", "/a b"),
        "x " + GOOD.replace("10.1.2.3", ""),
        GOOD.replace("512", "x"),
    ],
)
def test_malformed_lines(spark, line):
    r = parse(spark, line).first()
    assert not r.parsed and r.event_time is None


def test_json_lines_give_the_same_events(spark):
    lines = [
        '{"ip": "1.1.1.1", "time": "2024-01-10T08:15:22+07:00", "method": "GET", "path": "/a b", "status": 404, "size": 7}',
        '{"ip": "1.1.1.1", "time": "2024-01-10T08:15:22Z", "method": "GET", "path": "/", "status": 200, "size": "-"}',
        '{"ip": "1.1.1.1", "time": "2024-01-10 08:15:22", "method": "GET", "path": "/", "status": 200}',
        '{"ip": "1.1.1.1", "time": "2024-01-10T08:15:22Z", "method": "GET", "status": 200}',
        '{"ip": "1.1.1.1", "time": "2024-02-30T08:15:22Z", "method": "GET", "path": "/", "status": 200}',
        "not json",
    ]
    df = spark.createDataFrame([(i, line, "f") for i, line in enumerate(lines)], "i int, raw_line string, source_file string")
    parsed = weblog.parse_json(df)
    assert rows(parsed.filter("parsed"), "i", "path", "status_class", "response_size", "utc_offset") == [
        (0, "/a b", "client_error", 7, "+07:00"), (1, "/", "success", None, "+00:00")
    ]


@pytest.fixture
def log_dir(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    second = GOOD.replace("08:15", "10:00").replace(" 200 ", " 500 ").replace("10.1.2.3", "10.9.9.9")
    (folder / "one.log").write_bytes((GOOD + "\r\n\r\n   \n  broken \xff line\n").encode("latin-1") + second.encode() + b"\n")
    (folder / "two.log").write_text(GOOD.replace("GET /a/b?x=1", "POST /c").replace(" 200 ", " 404 ") + "\n")
    return str(folder)


def load(warehouse, path, **kwargs):
    lines = read_log_lines(warehouse.spark, path)
    run_at = F.lit("2024-01-11 00:00:00").cast("timestamp")
    warehouse.commit(*weblog.ingest(warehouse, lines, "r1", run_at, **kwargs))


def test_every_line_ends_up_as_event_or_dead_letter(warehouse, log_dir):
    load(warehouse, log_dir)
    events = warehouse.read("fact_log_event", schemas.LOG_EVENTS)
    dead = warehouse.read("parse_error_log", schemas.LOG_DEAD_LETTERS)
    assert events.count() == 3
    assert rows(dead) == [("  broken � line", "one.log", "r1")]
    summary = warehouse.read("pipeline_run_summary", schemas.LOG_SUMMARY)
    assert rows(summary, "source_file", "total_lines", "parsed_ok", "parse_failed") == [("one.log", 3, 2, 1), ("two.log", 1, 1, 0)]
    assert rows(weblog.success_series(summary), "source_file", "parse_success_rate") == [
        ("one.log", 2 / 3 * 100), ("two.log", 100.0)
    ]


def test_refresh_drops_earlier_runs_and_append_keeps_them(warehouse, log_dir):
    for refresh, expected in ((False, 3), (False, 6), (True, 3)):
        load(warehouse, log_dir, refresh=refresh)
        assert warehouse.read("fact_log_event", schemas.LOG_EVENTS).count() == expected


def test_a_run_without_lines_is_recorded(warehouse, tmp_path):
    (tmp_path / "empty.log").write_text("\n \n")
    load(warehouse, str(tmp_path / "empty.log"), source="empty.log")
    summary = warehouse.read("pipeline_run_summary", schemas.LOG_SUMMARY)
    assert rows(summary, "source_file", "total_lines", "parse_success_rate") == [("empty.log", 0, 0.0)]


def test_traffic(warehouse, log_dir):
    load(warehouse, log_dir)
    log = warehouse.read("fact_log_event", schemas.LOG_EVENTS)
    hours = [(r.hour.hour, r.requests) for r in weblog.requests_per_hour(log).collect()]
    assert hours == [(8, 2), (10, 1)], "hours are local to the source"
    assert rows(weblog.requests_per_hour_filled(log), "requests") == [(0,), (1,), (2,)]
    assert rows(weblog.status_mix(log)) == [("client_error", 1), ("server_error", 1), ("success", 1)]
    assert [tuple(r) for r in weblog.method_mix(log).collect()] == [("GET", 2), ("POST", 1)]
    assert [tuple(r) for r in weblog.top_ips(log, 1).collect()] == [("10.1.2.3", 2)]
    assert weblog.top_paths(log).first().path == "/a/b?x=1"
    kpis = weblog.health_kpis(log).first()
    assert kpis.error_rate == pytest.approx(200 / 3) and kpis.server_errors == 1
    assert [r.hour.hour for r in weblog.error_alerts(log, 50.0).collect()] == [10]


def test_the_match_runs_once_per_line(spark):
    """A filter on parsed rows must not copy the pattern match into every expression above it."""
    log = weblog.events(parse(spark, GOOD)).groupBy("path").count()
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 1


def test_lines_end_at_every_mark(spark, tmp_path):
    from millrace.sources.files import read_log_lines

    text = "".join(f"line {i}{end}" for i, end in enumerate(["\n", "\r\n", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x85", " ", " ", " \t"]))
    (tmp_path / "a.log").write_bytes(text.encode())
    got = [r.raw_line for r in read_log_lines(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(line for line in text.splitlines() if line.strip())
