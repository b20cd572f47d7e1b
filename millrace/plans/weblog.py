"""Web-server log lines to events, dead letters and a run summary, and the traffic questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import percent, status_class
from millrace.functions.text import WHITESPACE
from millrace.operators.calendar import fill_hours
from millrace.operators.rows import compute_once, frequency
from millrace.sources.warehouse import Change, Warehouse

# Month names of the log format, four characters apart.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"

# White space and runs of anything else. Testing a character against the full set is slow, so the usual characters, a
# space and printable ASCII, are told apart before. Nothing is given back, since a space must follow a run.
_SPACE = f"(?: |(?![!-~])[{WHITESPACE}])"
_WORD = f"(?:[!-~]++|(?! )[^{WHITESPACE}])++"
# Hours up to 23, then minutes, then seconds, the last with a colon only if the minutes have one.
_OFFSET = r"Z|[+-](?:[01]\d|2[0-3])(?:[0-5]\d(?:[0-5]\d)?|:[0-5]\d(?::[0-5]\d)?)"
# Anchored at the start only: whatever follows the size (referrer, agent) is free text.
_COMBINED = (
    rf"^{_SPACE}*+({_WORD}) {_WORD} {_WORD} "
    r"\[(\d{1,2})/([A-Za-z]{3})/(\d{4}):(\d{1,2}:\d{1,2}:\d{1,2})"
    rf"{_SPACE}++({_OFFSET})\] "
    rf'"([A-Z]+) ({_WORD}) HTTP/[\d.]+" (\d{{3}}) (\d+|-)'
)
# The captured parts, none of which can contain a space, in the order the rewrite below puts them.
_PARTS = ["mark", "ip", "method", "path", "status", "size", "year", "month", "day", "time", "offset"]


def parse_combined(lines: DataFrame) -> DataFrame:
    """Add the event columns to ``raw_line``; a malformed line gets ``parsed`` false and null columns.

    One match per line decides and extracts all parts at once: it rewrites the line to the parts behind a line break,
    so the result begins with a line break only if the pattern matched. (A text that begins with one itself is not a
    line of a file; it is matched separately.) A time that does not exist makes the line malformed too.
    """
    line = F.col("raw_line")
    rewritten = F.regexp_replace(line, f"(?s){_COMBINED}.*$", "\n $1 $7 $8 $9 $10 $4 $3 $2 $5 $6")
    matched = F.col("_r").startswith("\n") & (~line.startswith("\n") | line.rlike(_COMBINED))
    tokens = F.when(matched, F.split("_r", " "))
    part = {name: F.get("_t", F.lit(i)) for i, name in enumerate(_PARTS)}
    at = F.position(F.lower(part["month"]), F.lit(_MONTHS))
    part["month"] = F.when(at > 0, ((at + 3) / 4).cast("int").cast("string"))
    once = lines.transform(compute_once, "_r", rewritten).transform(compute_once, "_t", tokens).drop("_r")
    return _events(once, part)


def parse_json(lines: DataFrame) -> DataFrame:
    """The same columns from JSON lines with ``ip, time, method, path, status, size`` (time as ISO text with offset)."""
    names = ["ip", "method", "path", "status", "size"]
    fields = F.from_json("raw_line", ", ".join(f"{name} STRING" for name in [*names, "time"]))
    iso = rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[T ](\d{{1,2}}:\d{{1,2}}:\d{{1,2}})(?:\.\d+)?({_OFFSET})$"
    time = F.col("_j.time")
    valid = time.rlike(iso) & F.col("_j.status").rlike(r"^\d{3}$")
    tokens = F.when(valid, F.split(F.regexp_replace(time, iso, "$1 $2 $3 $4 $5"), " "))
    part = {name: F.col(f"_j.{name}") for name in names}
    part |= {name: F.get("_t", F.lit(i)) for i, name in enumerate(["year", "month", "day", "time", "offset"])}
    parsed = lines.transform(compute_once, "_j", fields).transform(compute_once, "_t", tokens).transform(_events, part)
    return parsed.drop("_j")


def _size_fits(size: Column) -> Column:
    """A size beyond 64 bits makes the line malformed; an absent one does not."""
    return size.isNull() | (size == "-") | size.try_cast("bigint").isNotNull()


def _offset(offset: Column) -> tuple[Column, Column]:
    """Seconds east of UTC of ``+hhmm``, ``+hhmmss`` or the same with colons, and the offset written with colons.

    The two usual forms, of five and six characters, are read off directly; the general way takes many more steps.
    """
    size, sign = F.length(offset), F.when(offset.startswith("-"), -1).otherwise(1)
    usual = size <= 6
    minutes = F.substring(offset, -2, 2)
    digits = F.replace(F.substring(offset, 2, 9), F.lit(":"), F.lit(""))
    part = lambda at: F.substring(F.rpad(digits, 6, "0"), at, 2).cast("int")
    pairs = [F.nullif(F.substring(digits, at, 2), F.lit("")) for at in (1, 3, 5)]
    seconds = F.when(usual, F.substring(offset, 2, 2).cast("int") * 3600 + minutes.cast("int") * 60).otherwise(
        part(1) * 3600 + part(3) * 60 + part(5)
    )
    written = F.when(size == 6, offset).when(size == 5, F.concat(F.substring(offset, 1, 3), F.lit(":"), minutes))
    return sign * seconds, written.otherwise(F.concat(F.substring(offset, 1, 1), F.concat_ws(":", *pairs)))


def _events(lines: DataFrame, part: dict[str, Column]) -> DataFrame:
    written = F.when(part["offset"] == "Z", "+00:00").otherwise(part["offset"])
    seconds, offset = _offset(written)
    offset = F.when(written.isNotNull(), offset)
    local = F.concat_ws(" ", F.concat_ws("-", part["year"], part["month"], part["day"]), part["time"])
    complete = F.lit(True)
    for name in ("ip", "method", "path", "month", "offset"):
        complete = complete & part[name].isNotNull()
    times = F.struct(
        # Spark's own parser stops at 18 hours, so the instant is the local time, read as UTC, less the offset.
        F.timestamp_seconds(F.when(complete, F.unix_seconds(F.concat(local, F.lit("Z")).try_cast("timestamp")) - seconds)).alias(
            "event_time"
        ),
        F.when(complete, local).try_cast("timestamp_ntz").alias("event_time_local"),
        offset.alias("utc_offset"),
    )
    status = part["status"].try_cast("int")
    return (
        compute_once(lines, "_e", times)
        .select(
            "*",
            part["ip"].alias("ip_address"),
            "_e.*",
            part["method"].alias("http_method"),
            part["path"].alias("path"),
            status.alias("status_code"),
            F.nullif(part["size"], F.lit("-")).try_cast("bigint").alias("response_size"),
            F.when(status.isNotNull(), status_class(status)).alias("status_class"),
            (F.col("_e.event_time").isNotNull() & _size_fits(part["size"])).alias("parsed"),
        )
        .drop("_t", "_e")
    )


def events(parsed: DataFrame) -> DataFrame:
    return parsed.filter("parsed").select(*schemas.LOG_EVENTS.names)


def dead_letters(parsed: DataFrame, run_id: str) -> DataFrame:
    """Malformed lines as they arrived."""
    return parsed.filter(~F.col("parsed")).select("raw_line", "source_file", F.lit(run_id).alias("run_id"))


def iso_time() -> Column:
    """Time of an event as ISO text with the offset of its source."""
    return F.concat(F.date_format("event_time_local", "yyyy-MM-dd'T'HH:mm:ss"), F.col("utc_offset"))


def run_summary(parsed: DataFrame, run_id: str, *by: str) -> DataFrame:
    """Lines, successes and failures of a run; 0.0 percent when there were no lines. ``by`` splits it, e.g. per file."""
    ok = F.count_if("parsed")
    counts = (parsed.groupBy(*by) if by else parsed).agg(
        F.count(F.lit(1)).alias("total_lines"),
        ok.alias("parsed_ok"),
        F.count_if(~F.col("parsed")).alias("parse_failed"),
    )
    return counts.withColumn("parse_success_rate", percent(F.col("parsed_ok"), F.col("total_lines"))).withColumn(
        "run_id", F.lit(run_id)
    )


def ingest(
    warehouse: Warehouse, lines: DataFrame, run_id: str, run_at: Column, source: str | None = None,
    refresh: bool = False,
) -> list[Change]:
    """Parse and write once, dealing the lines out to events and dead letters; the summary counts what was written.

    Returns the unpublished changes. With ``refresh`` they replace the tables of earlier runs. ``source`` names the file
    of a run; without it there is one summary line per file, and none for a file without lines.
    """
    parsed = parse_combined(lines)
    stored = parsed.select(
        *schemas.LOG_EVENTS.names,
        "parsed",
        "source_file",
        F.lit(run_id).alias("run_id"),
        F.when(~F.col("parsed"), F.col("raw_line")).alias("raw_line"),
    )
    day = F.to_date("event_time_local").cast("string")
    routes = {"fact_log_event": (F.col("parsed"), day), "parse_error_log": (~F.col("parsed"), None)}
    good, bad = warehouse.deal_out(stored, routes, refresh)

    written = good.rows.select("source_file", "parsed").unionAll(bad.rows.select("source_file", "parsed"))
    if source is not None:
        summary = run_summary(written, run_id).withColumn("source_file", F.lit(source))
    else:
        summary = run_summary(written, run_id, "source_file")
    summary = summary.withColumn("run_at_utc", run_at).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.LOG_SUMMARY]
    )
    write = warehouse.replace if refresh else warehouse.append
    return [good, bad, write("pipeline_run_summary", summary)]


# Traffic ---------------------------------------------------------------------------------------------------------


def local_hour() -> Column:
    """Hour on the clock of the source, as the dashboards count it; independent of the session time zone."""
    local = F.col("event_time_local")
    return F.to_date(local).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(local))


def requests_per_hour(log: DataFrame) -> DataFrame:
    return log.groupBy(local_hour().alias("hour")).agg(F.count(F.lit(1)).alias("requests")).orderBy("hour")


def requests_per_hour_filled(log: DataFrame) -> DataFrame:
    return fill_hours(requests_per_hour(log), "hour", "requests")


def status_mix(log: DataFrame) -> DataFrame:
    return frequency(log, "status_class", "requests")


def method_mix(log: DataFrame) -> DataFrame:
    return frequency(log, "http_method", "requests")


def top_paths(log: DataFrame, k: int = 10) -> DataFrame:
    return frequency(log, "path", "requests", k)


def top_ips(log: DataFrame, k: int = 10) -> DataFrame:
    return frequency(log, "ip_address", "request_count", k)


def health_kpis(log: DataFrame) -> DataFrame:
    return log.agg(
        (F.avg((F.col("status_class") != "success").cast("int")) * 100).alias("error_rate"),
        F.count_if(F.col("status_class") == "server_error").alias("server_errors"),
        F.max("event_time").alias("latest_event"),
    )


def _hour_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_class") != "success").alias("errors")]


def error_alerts(log: DataFrame, threshold_pct: float) -> DataFrame:
    """Hours whose share of failed requests exceeds the threshold."""
    return alerts_of(log.groupBy(local_hour().alias("hour")).agg(*_hour_counts()), threshold_pct)


def alerts_of(hours: DataFrame, threshold_pct: float) -> DataFrame:
    """The same from counted hours."""
    rated = hours.withColumn("error_rate", percent(F.col("errors"), F.col("requests")))
    return rated.filter(F.col("error_rate") > threshold_pct)


def closing_hours(log: DataFrame, delay: str) -> DataFrame:
    """Requests and errors per hour of a stream of events, in event-time windows on the clock of the source.

    The state store keeps the hours that may still change. An hour is handed on, once and for good, when the newest event
    is ``delay`` past its end; events of an hour that was due before their batch are dropped. Local times stand for
    instants here (the session's zone is UTC): clocks of sources may differ by less than ``delay``.
    """
    local = F.col("event_time_local").cast("timestamp")
    hours = log.withColumn("_local", local).withWatermark("_local", delay).groupBy(F.window("_local", "1 hour"))
    return hours.agg(*_hour_counts()).select(F.col("window.start").cast("timestamp_ntz").alias("hour"), "requests", "errors")


def success_series(summaries: DataFrame) -> DataFrame:
    """Parse success over the recorded runs, newest first."""
    return summaries.select(
        "run_at_utc", "run_id", "source_file", "total_lines", "parse_failed", "parse_success_rate"
    ).orderBy(F.desc("run_at_utc"), "run_id", "source_file")
