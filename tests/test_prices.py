from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans import prices
from millrace.sources.files import flatten_price_payload, read_landed_json
from millrace.sources.warehouse import Warehouse, replace_on_key
from tests.helpers import rows

T0 = datetime(2024, 1, 1)
KEYS = ["bitcoin", "solana"]


def at(hours):
    return T0 + timedelta(hours=hours)


def snapshots(spark, *data):
    return spark.createDataFrame([(k, p, 1e12, at(h)) for k, p, h in data], schemas.RAW_PRICES)


def fact(warehouse, *columns):
    return rows(warehouse.read("fact_price_hourly", schemas.FACT_PRICES), *columns)


def marks(warehouse):
    return dict(rows(prices.read_state(warehouse), "coin_id", "last_processed_utc"))


def load_and_run(warehouse, df, keys=KEYS):
    warehouse.commit(prices.load_snapshots(warehouse, df))
    return prices.run_increment(warehouse, keys)


def test_only_new_rows_are_processed(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 40000.0, 0), ("bitcoin", 41000.0, 1)))
    expected = [(at(0), 40000.0, None), (at(1), 40500.0, 2.5)]
    assert fact(warehouse, "fetched_at_utc", "moving_avg_3", "pct_change_from_prev") == expected
    assert marks(warehouse) == {"bitcoin": at(1)}

    version = warehouse.version()
    assert prices.run_increment(warehouse, KEYS) == version, "no new data publishes nothing"
    assert len(fact(warehouse)) == 2 and marks(warehouse) == {"bitcoin": at(1)}


def test_metrics_continue_across_runs_and_late_rows_are_left_out(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 10.0, 0), ("bitcoin", 20.0, 30), ("solana", 1.0, 1)))
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 60.0, 31), ("bitcoin", 5.0, 2), ("solana", 2.0, 90)))
    assert fact(warehouse, "coin_id", "fetched_at_utc", "moving_avg_3", "pct_change_from_prev") == [
        ("bitcoin", at(0), 10.0, None), ("bitcoin", at(30), 15.0, 100.0), ("bitcoin", at(31), 30.0, 200.0),
        ("solana", at(1), 1.0, None), ("solana", at(90), 1.5, 100.0),
    ]
    assert marks(warehouse) == {"bitcoin": at(31), "solana": at(90)}


def test_keys_not_listed_wait(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0, 0), ("solana", 2.0, 0)), ["bitcoin"])
    assert set(marks(warehouse)) == {"bitcoin"}
    prices.run_increment(warehouse, KEYS)
    assert set(marks(warehouse)) == {"bitcoin", "solana"}


def test_a_run_reads_only_directories_added_since_the_last(spark, warehouse, monkeypatch):
    """Neither an idle key nor one that never appears brings back what was read."""
    opened = []
    added = Warehouse.added
    monkeypatch.setattr(Warehouse, "added", lambda self, *a, **k: opened.append((a[0], added(self, *a, **k))) or opened[-1][1])
    wanted = ["bitcoin", "solana", "never"]
    for day in range(4):
        hours = [("bitcoin", float(day + 1), 24 * day)] + ([("solana", 5.0, 0)] if day == 0 else [])
        opened.clear()
        load_and_run(warehouse, snapshots(spark, *hours), wanted)
        assert {len(dirs) for table, dirs in opened if table == "raw_price_snapshot"} == {1}
    assert len(fact(warehouse)) == 5 and marks(warehouse) == {"bitcoin": at(72), "solana": at(0)}


def test_keys_may_be_a_frame_and_state_is_compacted(spark, warehouse):
    keys = spark.createDataFrame([("bitcoin", 1), ("bitcoin", 2), (None, 3), ("solana", 4)], "coin_id string, n int")
    for day in range(3):
        load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0 + day, day), ("solana", 2.0, day)), keys if day else ["bitcoin"])
    assert marks(warehouse) == {"bitcoin": at(2), "solana": at(2)} and len(fact(warehouse)) == 6
    before = rows(prices.read_state(warehouse))
    prices.compact_state(warehouse)
    assert rows(prices.read_state(warehouse)) == rows(warehouse.read("price_state", prices.STATE)) == before
    assert prices.run_increment(warehouse, keys) == warehouse.version() and len(fact(warehouse)) == 6


def test_late_rows_are_counted(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0, 5)))
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 2.0, 3), ("bitcoin", 3.0, 4)))
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 2.0, 2), ("bitcoin", 3.0, 9)))
    assert rows(warehouse.read("price_run_log", schemas.PRICE_RUNS), "processed", "late") == [(0, 2), (1, 0), (1, 1)]


def test_the_first_landed_price_stays_and_bad_payloads_are_kept(spark, warehouse, tmp_path):
    lines = ['{"bitcoin": {"usd": 9.0}}', '{"bitcoin": {"usd": 5.0}}', "<html>", None, "{}"]
    landed = "".join(json.dumps({"payload": x, "fetched_at_utc": "2024-01-01T00:00:00Z"}) + "\n" for x in lines)
    (tmp_path / "landed.json").write_text(landed)
    read = read_landed_json(spark, str(tmp_path / "landed.json"), schemas.LANDED_PRICES)
    warehouse.commit(*prices.load_landed(warehouse, read))
    assert rows(warehouse.read("raw_price_snapshot", schemas.RAW_PRICES), "price_usd") == [(9.0,)]
    assert rows(warehouse.read("price_payload_reject", schemas.PRICE_REJECTS), "payload", "reject_reason") == [
        ("<html>", "no price map"), ("{}", "empty price map"), (None, "no payload")
    ]


def test_default_keys(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0, 0), ("other", 2.0, 0)), None)
    assert set(marks(warehouse)) == {"bitcoin"}


def test_raw_load_skips_known_keys_and_missing_prices(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0, 0)))
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 9.0, 0), ("bitcoin", None, 1), ("bitcoin", float("nan"), 2)))
    assert rows(warehouse.read("raw_price_snapshot", schemas.RAW_PRICES), "price_usd") == [(1.0,)]


def test_change_is_null_after_a_zero_price(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 5.0, 0), ("bitcoin", 0.0, 1), ("bitcoin", 3.0, 2)))
    assert fact(warehouse, "fetched_at_utc", "pct_change_from_prev") == [(at(0), None), (at(1), -100.0), (at(2), None)]


def test_a_crash_before_publishing_is_repaired_by_the_next_run(spark, warehouse, monkeypatch):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 10.0, 0), ("bitcoin", 20.0, 1)))
    warehouse.commit(prices.load_snapshots(warehouse, snapshots(spark, ("bitcoin", 30.0, 2), ("bitcoin", 70.0, 3))))
    monkeypatch.setattr(Warehouse, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        prices.run_increment(warehouse, KEYS)
    monkeypatch.undo()
    assert marks(warehouse) == {"bitcoin": at(1)} and len(fact(warehouse)) == 2
    prices.run_increment(Warehouse(spark, warehouse.root), KEYS)
    assert fact(warehouse, "fetched_at_utc", "moving_avg_3") == [(at(0), 10.0), (at(1), 15.0), (at(2), 20.0), (at(3), 40.0)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.integers(0, 9), min_size=1, max_size=10),
    cuts=st.lists(st.integers(0, 10), max_size=2),
    ranges=st.sampled_from([None, 7]),
)
def test_increments_cut_anywhere_equal_one_run(spark, values, cuts, ranges):
    raw = snapshots(spark, *[("bitcoin" if i % 3 else "solana", float(v), i * 5) for i, v in enumerate(values)])
    state = spark.createDataFrame([], prices.STATE)
    parts = []
    for cut in [*sorted(cuts), 99]:
        arrived = raw.filter(F.col("fetched_at_utc") < at(cut * 5))
        part = prices.next_increment(arrived, state, ranges).collect()
        parts += [tuple(r) for r in part]
        if part:
            done = spark.createDataFrame(part, schemas.FACT_PRICES)
            after = replace_on_key(state, prices.state_after(done, state), ["coin_id"], ["last_processed_utc"])
            state = spark.createDataFrame(after.collect(), prices.STATE)
    assert sorted(parts, key=repr) == rows(prices.price_metrics(raw).select(*schemas.FACT_PRICES.names))


def test_state_can_be_rebuilt_from_the_fact(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0, 0), ("bitcoin", 2.0, 1), ("bitcoin", 3.0, 2), ("solana", 4.0, 0)))
    rebuilt = prices.state_after(warehouse.read("fact_price_hourly", schemas.FACT_PRICES))
    assert rows(rebuilt) == rows(prices.read_state(warehouse)) == [
        ("bitcoin", at(2), 3.0, at(1), 2.0), ("solana", at(0), 4.0, None, None)
    ]


def test_payload_to_rows(spark):
    landed = spark.createDataFrame(
        [('{"bitcoin": {"usd": 40000, "usd_market_cap": 8e11}, "solana": {"usd": 95.5}, "odd": {}}', T0)],
        "payload string, fetched_at_utc timestamp",
    )
    assert rows(flatten_price_payload(landed)) == [
        ("bitcoin", 40000.0, 8e11, T0), ("odd", None, None, T0), ("solana", 95.5, None, T0)
    ]


def test_reports(spark, warehouse):
    load_and_run(warehouse, snapshots(spark, ("bitcoin", 1.0, 0), ("bitcoin", 3.0, 1), ("solana", 4.0, 0)))
    stored = warehouse.read("fact_price_hourly", schemas.FACT_PRICES)
    assert rows(prices.latest_prices(stored), "coin_id", "price_usd", "direction") == [("bitcoin", 3.0, "up"), ("solana", 4.0, "flat")]
    assert rows(prices.snapshot_counts(stored), "coin_id", "snapshots") == [("bitcoin", 2), ("solana", 1)]
    assert rows(prices.price_alerts(stored, 200.0), "coin_id", "direction") == [("bitcoin", "up")]
    assert prices.price_alerts(stored, 200.1).count() == 0
