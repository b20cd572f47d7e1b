"""Web log: every event becomes a log line; some lines are broken or carry a day that does not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.top_k import exact_top_k
from millrace.plans import weblog
from millrace.session import scratch_path
from millrace.sources.files import read_log_lines
from workload import table

RUN = "run-1"


def _every(n: int):
    return F.col("event_id") % n == 0


def _fields(events: DataFrame) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("10.0."), (user % 3).cast("string"), F.lit("."), (user % 251).cast("string")).alias("ip"),
        F.when(F.col("value") < 350, "GET").otherwise("POST").alias("method"),
        F.concat(F.lit("/api/"), F.col("event_type"), F.lit("/"), (user % 20).cast("string")).alias("path"),
        F.element_at(F.array(*[F.lit(c) for c in ("200", "301", "404", "500", "199")]), (event % 5 + 1).cast("int")).alias(
            "status"
        ),
        F.when(_every(6), "-").otherwise(event.cast("string")).alias("size"),
        F.when(_every(4), "Z").when(_every(3), "+05:30").otherwise("+0700").alias("offset"),
    )


def log_lines(events: DataFrame) -> DataFrame:
    day = F.when(_every(23), "31/Feb/2024").otherwise(F.date_format("ts", "dd/MMM/yyyy"))
    line = F.concat(
        F.col("ip"), F.lit(" - - ["), day, F.date_format("ts", ":HH:mm:ss "), F.col("offset"), F.lit('] "'),
        F.col("method"), F.lit(" "), F.col("path"), F.lit(' HTTP/1.1" '), F.col("status"), F.lit(" "), F.col("size"),
        F.lit(' "-" "Agent/1.0"'),
    )
    broken = F.concat(F.lit("%%% broken "), F.col("event_id").cast("string"))
    return _fields(events).select(
        F.when(_every(17), broken).otherwise(line).alias("raw_line"),
        F.concat(F.lit("access-"), F.date_format("ts", "yyyyMMdd"), F.lit(".log")).alias("source_file"),
    )


def json_lines(events: DataFrame) -> DataFrame:
    offset = F.when(F.col("offset") == "+0700", "+07:00").otherwise(F.col("offset"))
    time = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("time")
    line = F.to_json(F.struct("ip", time, "method", "path", "status", "size"))
    return _fields(events).select(
        F.when(_every(17), F.concat(F.lit("{broken "), line)).otherwise(line).alias("raw_line"),
        F.lit("api.json").alias("source_file"),
    )


def parsed(spark, sf):
    return weblog.parse_combined(log_lines(table(spark, sf, "events")))


def events(spark, sf):
    return weblog.events(parsed(spark, sf))


def shown(log: DataFrame) -> DataFrame:
    return log.select(
        "ip_address",
        weblog.iso_time().alias("event_timestamp"),
        F.unix_seconds("event_time").alias("event_epoch"),
        "http_method",
        "path",
        "status_code",
        "response_size",
        "status_class",
    )


def health(spark, sf):
    kpis = weblog.health_kpis(events(spark, sf))
    return kpis.withColumn("error_rate", F.round("error_rate", 6)).withColumn(
        "latest_event", F.unix_seconds("latest_event")
    )


def success_rate(spark, sf):
    """The runs of the month, one per daily file."""
    summaries = weblog.run_summary(parsed(spark, sf), RUN, "source_file")
    day = F.to_date(F.substring("source_file", 8, 8), "yyyyMMdd")
    return weblog.success_series(summaries.withColumn("run_at_utc", day))


def scan_log(spark, sf):
    """The lines written as text files, two with one of all marks between them, read back and parsed."""
    path = scratch_path(spark, "log")
    events = table(spark, sf, "events")
    lines = log_lines(events).select("raw_line")
    ends = F.array(*[F.lit(c) for c in ("\n", "\r\n", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")])
    end = F.get(ends, F.pmod(F.xxhash64("raw_line"), F.lit(11)).cast("int"))
    lines.select(F.concat("raw_line", end, F.lit("  "), end, F.lit("%% two")).alias("value")).write.text(path)
    return shown(weblog.events(weblog.parse_combined(read_log_lines(spark, path))))


def top_ips_exact(spark, sf):
    """By summaries far smaller than the number of addresses, so that most of these are never counted."""
    return exact_top_k(events(spark, sf), "ip_address", "request_count", 10, capacity=200)


QUERIES = {
    "log_top_ips_exact": top_ips_exact,
    "log_parse_events": lambda s, d: shown(events(s, d)),
    "log_parse_json": lambda s, d: shown(weblog.events(weblog.parse_json(json_lines(table(s, d, "events"))))),
    "log_dead_letters": lambda s, d: weblog.dead_letters(parsed(s, d), RUN),
    "log_run_summary": lambda s, d: weblog.run_summary(parsed(s, d), RUN, "source_file"),
    "log_success_rate": success_rate,
    "log_requests_per_hour": lambda s, d: weblog.requests_per_hour(events(s, d)),
    "log_requests_per_hour_filled": lambda s, d: weblog.requests_per_hour_filled(
        events(s, d).filter(F.col("status_code") == 500)
    ),
    "scan_log_text": scan_log,
    "log_status_mix": lambda s, d: weblog.status_mix(events(s, d)),
    "log_method_mix": lambda s, d: weblog.method_mix(events(s, d)),
    "log_top_paths": lambda s, d: weblog.top_paths(events(s, d)),
    "log_top_ips": lambda s, d: weblog.top_ips(events(s, d)),
    "log_health_kpis": health,
    "log_error_alerts": lambda s, d: weblog.error_alerts(events(s, d), threshold_pct=60.0),
}

FIELDS = """
WITH fields AS (
  SELECT event_id, ts, '10.0.' || (user_id % 3) || '.' || (user_id % 251) AS ip,
    CASE WHEN value < 350 THEN 'GET' ELSE 'POST' END AS method,
    '/api/' || event_type || '/' || (user_id % 20) AS path,
    CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 404 WHEN 3 THEN 500 ELSE 199 END AS status,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id END AS size,
    CASE WHEN event_id % 4 = 0 THEN 0 WHEN event_id % 3 = 0 THEN 330 ELSE 420 END AS offset_minutes,
    CASE WHEN event_id % 4 = 0 THEN 'Z' WHEN event_id % 3 = 0 THEN '+05:30' ELSE '+0700' END AS offset_text,
    'access-' || strftime(ts, '%Y%m%d') || '.log' AS source_file,
    event_id % 17 <> 0 AND event_id % 23 <> 0 AS parsed
  FROM events
), shown AS (
  SELECT event_id, source_file, date_trunc('hour', ts) AS hour, ip AS ip_address,
    strftime(ts, '%Y-%m-%dT%H:%M:%S')
      || CASE offset_minutes WHEN 0 THEN '+00:00' WHEN 330 THEN '+05:30' ELSE '+07:00' END AS event_timestamp,
    CAST(epoch(date_trunc('second', ts)) AS BIGINT) - offset_minutes * 60 AS event_epoch,
    method AS http_method, path, CAST(status AS INTEGER) AS status_code, CAST(size AS BIGINT) AS response_size,
    CASE WHEN status IN (200, 301) THEN 'success' WHEN status = 404 THEN 'client_error' ELSE 'server_error' END
      AS status_class
  FROM fields
), log AS (SELECT s.* FROM shown s JOIN fields f USING (event_id) WHERE f.parsed)
"""
_COLUMNS = """SELECT ip_address, event_timestamp, event_epoch, http_method, path, status_code, response_size,
  status_class"""
_SUMMARY = """SELECT source_file, count(*) AS total_lines, count(*) FILTER (parsed) AS parsed_ok,
  count(*) FILTER (NOT parsed) AS parse_failed,
  CAST(count(*) FILTER (parsed) AS DOUBLE) / count(*) * 100 AS parse_success_rate, 'run-1' AS run_id
FROM fields GROUP BY source_file"""


def _frequency(col: str, alias: str = "requests", limit: str = "") -> str:
    return FIELDS + f"SELECT {col}, count(*) AS {alias} FROM log GROUP BY 1 ORDER BY 2 DESC, 1 {limit}"


ORACLE = {
    "log_parse_events": FIELDS + f"{_COLUMNS} FROM log",
    "log_parse_json": FIELDS + f"{_COLUMNS} FROM shown WHERE event_id % 17 <> 0",
    "log_dead_letters": FIELDS + """
SELECT CASE WHEN event_id % 17 = 0 THEN '%%% broken ' || event_id
  ELSE ip || ' - - [31/Feb/2024' || strftime(ts, ':%H:%M:%S ') || offset_text || '] "' || method || ' ' || path
    || ' HTTP/1.1" ' || status || ' ' || coalesce(CAST(size AS VARCHAR), '-') || ' "-" "Agent/1.0"' END AS raw_line,
  source_file, 'run-1' AS run_id
FROM fields WHERE NOT parsed""",
    "log_run_summary": FIELDS + _SUMMARY,
    "log_success_rate": FIELDS + f"""
SELECT CAST(strptime(source_file[8:15], '%Y%m%d') AS DATE) AS run_at_utc, run_id, source_file, total_lines, parse_failed,
  parse_success_rate FROM ({_SUMMARY})""",
    "log_requests_per_hour": FIELDS + "SELECT hour, count(*) AS requests FROM log GROUP BY 1 ORDER BY 1",
    "log_requests_per_hour_filled": FIELDS + """
, counts AS (SELECT hour, count(*) AS n FROM log WHERE status_code = 500 GROUP BY 1),
spine AS (SELECT unnest(generate_series((SELECT min(hour) FROM counts), (SELECT max(hour) FROM counts),
  INTERVAL 1 HOUR)) AS hour)
SELECT hour, coalesce(n, 0) AS requests FROM spine LEFT JOIN counts USING (hour)""",
    "log_status_mix": _frequency("status_class"),
    "log_method_mix": _frequency("http_method"),
    "log_top_paths": _frequency("path", limit="LIMIT 10"),
    "log_top_ips": _frequency("ip_address", "request_count", "LIMIT 10"),
    "log_health_kpis": FIELDS + """
SELECT round(avg(CASE WHEN status_class <> 'success' THEN 1 ELSE 0 END) * 100, 6) AS error_rate,
  count(*) FILTER (status_class = 'server_error') AS server_errors, max(event_epoch) AS latest_event FROM log""",
    "log_error_alerts": FIELDS + """
SELECT * FROM (
  SELECT hour, count(*) AS requests, count(*) FILTER (status_class <> 'success') AS errors,
    CAST(count(*) FILTER (status_class <> 'success') AS DOUBLE) / count(*) * 100 AS error_rate
  FROM log GROUP BY 1) WHERE error_rate > 60""",
}
ORACLE["scan_log_text"] = ORACLE["log_parse_events"]
ORACLE["log_top_ips_exact"] = ORACLE["log_top_ips"]
