"""Price snapshots: append-only load, increments behind per-key high-water marks, reports.

The state table holds, per key, the mark (time of the newest processed row) and the last two processed prices. Those two
rows are all a trailing three-row metric needs from the past, so an increment reads new rows and the small state only,
never the stored fact. Fact and state are published by one commit: a crash cannot leave them out of step.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from millrace import schemas
from millrace.functions import change_direction, percent_change
from millrace.operators.rows import keep_latest
from millrace.operators.trailing import trailing_metrics
from millrace.session import own_scratch, write_once
from millrace.sources.files import flatten_price_payload, price_payload_rejects, restrict_to_keys
from millrace.sources.warehouse import Change, Warehouse

KEY, TIME, PRICE = "coin_id", "fetched_at_utc", "price_usd"
EPOCH = datetime(1970, 1, 1)

# Keys processed when a run names none.
DEFAULT_KEYS = ["bitcoin", "ethereum", "solana"]


def state_schema(time_type: DataType, key_type: DataType) -> StructType:
    price = schemas.RAW_PRICES[PRICE].dataType
    return StructType(
        [
            StructField(KEY, key_type),
            StructField("last_processed_utc", time_type),
            StructField("last_price", price),
            StructField("previous_utc", time_type),
            StructField("previous_price", price),
        ]
    )


STATE = state_schema(schemas.RAW_PRICES[TIME].dataType, schemas.RAW_PRICES[KEY].dataType)


def day_of(col: str = TIME) -> Column:
    """Partition of the price tables: the day of the timestamp, which is part of the key."""
    return F.to_date(col).cast("string")


# Metrics ---------------------------------------------------------------------------------------------------------


def price_metrics(rows: DataFrame, history: DataFrame | None = None, ranges: int | None = None) -> DataFrame:
    """Add the trailing three-row mean and the change against the row before, per key in time order."""
    return (
        trailing_metrics(rows, KEY, TIME, PRICE, history, ranges)
        .withColumn("pct_change_from_prev", percent_change(F.col(PRICE), F.col("previous")))
        .withColumnRenamed("moving_avg", "moving_avg_3")
        .drop("previous")
    )


# Increments ------------------------------------------------------------------------------------------------------


def beyond_mark(raw: DataFrame, state: DataFrame) -> DataFrame:
    """Rows newer than the mark of their key; a key without state starts at the epoch. Late rows never pass."""
    mark = F.coalesce("last_processed_utc", F.lit(EPOCH).cast(raw.schema[TIME].dataType))
    marked = raw.join(state.select(KEY, "last_processed_utc"), KEY, "left")
    return marked.filter(F.col(TIME) > mark).select(*raw.columns)


def late_rows(raw: DataFrame, state: DataFrame) -> DataFrame:
    """The rows ``beyond_mark`` leaves out."""
    return raw.join(state.select(KEY, "last_processed_utc"), KEY).filter(F.col(TIME) <= F.col("last_processed_utc"))


def carried_rows(state: DataFrame) -> DataFrame:
    """The state as the price rows it remembers, up to two per key."""
    pairs = F.array(
        F.struct(F.col("last_processed_utc").alias(TIME), F.col("last_price").alias(PRICE)),
        F.struct(F.col("previous_utc").alias(TIME), F.col("previous_price").alias(PRICE)),
    )
    return state.select(KEY, F.inline(pairs)).filter(F.col(TIME).isNotNull())


def state_after(rows: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """State of the keys in ``rows`` once these are processed; without ``state`` this rebuilds it from a fact."""
    newest = keep_latest(rows.select(KEY, TIME, PRICE, F.lit(True).alias("_new")), [KEY], [TIME], n=2)
    if state is not None:
        earlier = carried_rows(state).withColumn("_new", F.lit(False))
        newest = keep_latest(newest.unionByName(earlier), [KEY], [TIME], n=2)
    time, price = F.col(TIME), F.col(PRICE)
    return (
        newest.groupBy(KEY)
        .agg(
            F.max(TIME).alias("last_processed_utc"),
            F.max_by(price, time).alias("last_price"),
            F.min(TIME).alias("previous_utc"),
            F.min_by(price, time).alias("previous_price"),
            F.count(F.lit(1)).alias("_n"),
            F.max("_new").alias("_new"),
        )
        .filter("_new")
        .select(
            KEY,
            "last_processed_utc",
            "last_price",
            *[F.when(F.col("_n") > 1, F.col(c)).alias(c) for c in ("previous_utc", "previous_price")],
        )
    )


def next_increment(raw: DataFrame, state: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fact rows for everything beyond the marks; the metrics continue across runs."""
    return price_metrics(beyond_mark(raw, state), carried_rows(state), ranges)


def load_snapshots(warehouse: Warehouse, snapshots: DataFrame) -> Change:
    """Append snapshots whose key and time are new; rows without a price are skipped. Returns the unpublished change."""
    rows = snapshots.select(*schemas.RAW_PRICES.names, *[c for c in snapshots.columns if c == "seq"])
    return warehouse.insert_if_absent(
        "raw_price_snapshot",
        rows,
        [KEY, TIME],
        ["seq"] if "seq" in rows.columns else [PRICE, "market_cap_usd"],
        [KEY, PRICE, TIME],
        day_of(),
    )


def load_landed(warehouse: Warehouse, landed: DataFrame) -> list[Change]:
    """Append the prices of landed payloads, the first row of a key and time in their ingest order, and keep the payloads
    that hold none as rejects. Returns the unpublished changes."""
    rejects = price_payload_rejects(landed).select(*schemas.PRICE_REJECTS.names)
    rejected = [] if rejects.isEmpty() else [warehouse.append("price_payload_reject", rejects)]
    return [load_snapshots(warehouse, flatten_price_payload(landed)), *rejected]


def read_state(warehouse: Warehouse, keys: DataFrame | None = None) -> DataFrame:
    """The state of every key, or of those wanted: increments append theirs, and marks only grow, so the newest counts."""
    state = restrict_to_keys(warehouse.read("price_state", STATE), KEY, keys, []) if keys is not None else warehouse.read("price_state", STATE)
    return keep_latest(state, [KEY], ["last_processed_utc"])


def _read_to(warehouse: Warehouse) -> DataFrame:
    """Up to which version the rows of each key have been read."""
    return warehouse.read("price_progress", schemas.PRICE_PROGRESS).groupBy(KEY).agg(F.max("read_to").alias("read_to"))


def run_increment(warehouse: Warehouse, keys: Sequence[str] | DataFrame | None = None) -> int:
    """Process all keys in one job and publish fact, state and run together. Without new rows nothing is written.

    ``keys`` is a list or, for any number of them, a frame with a column of keys. For every wanted key it is remembered up to
    which version its rows have been read, whether it had any or not. A run opens each directory added since the lowest of
    these once, so a key that is idle, or that never appears, costs nothing. Rows at or below the mark of their key are left
    out, and counted in the run.
    """
    spark = warehouse.spark
    if not isinstance(keys, DataFrame):
        keys = spark.createDataFrame([(key,) for key in keys or DEFAULT_KEYS], StructType([schemas.RAW_PRICES[KEY]]))
    with own_scratch(spark):
        version = warehouse.version()
        wanted = keys.select(KEY).filter(F.col(KEY).isNotNull()).distinct().join(_read_to(warehouse), KEY, "left")
        wanted = write_once(wanted.select(KEY, F.coalesce("read_to", F.lit(0).cast("long")).alias("read_to")), "price-keys")
        steps = sorted(r.read_to for r in wanted.select("read_to").distinct().collect())  # versions, at most
        since = [warehouse.added("raw_price_snapshot", step) for step in steps]
        if not since or not since[0]:
            return version
        raw = None
        for step, dirs, later in zip(steps, since, [*since[1:], []], strict=True):
            # What came between two steps is new to the keys that have been read to the first of them, or less far.
            rows = warehouse.open([d for d in dirs if d not in set(later)], schemas.RAW_PRICES)
            rows = rows.join(wanted.filter(F.col("read_to") <= step), KEY, "left_semi")
            raw = rows if raw is None else raw.unionByName(rows)
        changes = _advance(warehouse, raw, read_state(warehouse, wanted))
        progress = wanted.select(KEY, F.lit(version).cast("long").alias("read_to"))
        return warehouse.commit(*changes, warehouse.append("price_progress", progress))


def process_arrivals(warehouse: Warehouse, snapshots: DataFrame, batch: tuple[str, int]) -> int:
    """Load and process a batch of any keys with one commit.

    Whatever is new arrives in this batch, so the increment reads the rows just inserted instead of the raw table.
    """
    with own_scratch(warehouse.spark):
        loaded = load_snapshots(warehouse, snapshots)
        arrived = loaded.rows.select(KEY).distinct()
        return warehouse.commit(loaded, *_advance(warehouse, loaded.rows, read_state(warehouse, arrived)), batch=batch)


def _advance(warehouse: Warehouse, raw: DataFrame, state: DataFrame) -> list[Change]:
    """Rows beyond a mark are new by definition, so the fact is appended to, and so is the state of the keys that move."""
    state = write_once(state, "price-state")
    fact = warehouse.append("fact_price_hourly", next_increment(raw, state).select(*schemas.FACT_PRICES.names), day_of())
    processed, arrived = fact.rows.count(), raw.count()
    if not arrived:
        return []
    run = warehouse.spark.range(1).select(
        F.current_timestamp().alias("run_at_utc"), F.lit(processed).cast("long").alias("processed"), F.lit(arrived - processed).cast("long").alias("late")
    )
    changes = [warehouse.append("price_run_log", run.select(*schemas.PRICE_RUNS.names))]
    if not fact.parts:
        return changes
    return [fact, warehouse.append("price_state", state_after(fact.rows, state).select(*STATE.names)), *changes]


def compact_state(warehouse: Warehouse) -> int:
    """Rewrite state and progress with one row per key, after many increments."""
    return warehouse.commit(warehouse.replace("price_state", read_state(warehouse)), warehouse.replace("price_progress", _read_to(warehouse)))


# Reports ---------------------------------------------------------------------------------------------------------


def latest_prices(fact: DataFrame) -> DataFrame:
    """Newest row per key with its direction; plain maxima, so each task sends one row per key."""
    return (
        fact.groupBy(KEY)
        .agg(
            F.max(TIME).alias(TIME),
            F.max_by(PRICE, TIME).alias(PRICE),
            F.max_by("pct_change_from_prev", TIME).alias("pct_change_from_prev"),
        )
        .withColumn("direction", change_direction(F.col("pct_change_from_prev")))
    )


def snapshot_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy(KEY).agg(F.count(F.lit(1)).alias("snapshots"), F.max(TIME).alias("last_refresh"))


def overview(fact: DataFrame) -> DataFrame:
    """One row: keys, snapshots, newest refresh."""
    return snapshot_counts(fact).agg(
        F.count(F.lit(1)).alias("keys"),
        F.sum("snapshots").alias("snapshots"),
        F.max("last_refresh").alias("last_refresh"),
    )


def price_alerts(fact: DataFrame, threshold_pct: float) -> DataFrame:
    """Rows whose move against the row before reaches the threshold, up or down."""
    return fact.filter(F.abs("pct_change_from_prev") >= threshold_pct).withColumn(
        "direction", change_direction(F.col("pct_change_from_prev"))
    )
