"""Marts kept up to date batch by batch equal those computed from everything at once."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.plans import increments, subscriptions
from tests.helpers import rows

SCHEMA = "subscription_id long, customer_id long, plan_type string, start_date date, end_date date, monthly_price_usd double, status string"
PLANS = ["basic", "pro", "", None]


def version(r: random.Random, key: int) -> tuple:
    start = None if r.random() < 0.05 else date(2023, 1, 1) + timedelta(days=r.randrange(500))
    end = None if start is None or r.random() < 0.4 else start + timedelta(days=r.randrange(-20, 300))
    return key, r.randrange(6), r.choice(PLANS), start, end, r.choice([None, 9.99, 20.0, 0.1]), "active"


@pytest.mark.parametrize("seed", [1, 2])
def test_revenue_by_increments_equals_a_rebuild(spark, warehouse, seed):
    r = random.Random(seed)
    now: dict[int, tuple] = {}
    for number, as_of in enumerate([date(2023, 6, 15), date(2023, 6, 30), date(2024, 3, 1)]):
        changed = [k for k in now if r.random() < 0.5]
        before = [now[k] for k in changed]
        gone = {k for k in changed if r.random() < 0.2}
        for k in changed:
            now[k] = version(r, k)
        fresh = list(range(number * 30, number * 30 + 30))
        for k in fresh:
            now[k] = version(r, k)
        for k in gone:
            del now[k]
        after = [now[k] for k in [*changed, *fresh] if k in now]
        frames = [spark.createDataFrame(x, SCHEMA) for x in (before, after)]
        increments.increment_mrr(warehouse, increments.signed_rows(*frames), as_of, ("mrr", number))
        whole = subscriptions.fct_mrr(spark.createDataFrame(list(now.values()), SCHEMA), as_of)
        assert rows(increments.read_mrr(warehouse)) == rows(whole)
    assert warehouse.tables() == ["mrr_change", "mrr_level"] and warehouse.seen("mrr", 2)  # no subscriptions are kept
    before = warehouse.added("mrr_level")
    increments.increment_mrr(warehouse, spark.createDataFrame([], SCHEMA).withColumn("sign", F.lit(1)), date(2024, 3, 9))
    assert warehouse.added("mrr_level") == before  # nothing has changed
    with pytest.raises(ValueError, match="reached"):
        increments.increment_mrr(warehouse, frames[0].withColumn("sign", F.lit(1)), date(2024, 1, 1))


def test_only_touched_months_are_rewritten(spark, warehouse):
    as_of = date(2024, 12, 31)
    old = [(1, 1, "a", date(2023, 1, 5), None, 5.0, "active"), (2, 1, "b", date(2023, 2, 5), None, 7.0, "active")]
    nothing = spark.createDataFrame([], SCHEMA)
    increments.increment_mrr(warehouse, increments.signed_rows(nothing, spark.createDataFrame(old, SCHEMA)), as_of)
    before = set(warehouse.added("mrr_level"))
    ended = [(1, 1, "a", date(2023, 1, 5), date(2024, 10, 2), 5.0, "canceled")]
    increments.increment_mrr(warehouse, increments.signed_rows(spark.createDataFrame(old[:1], SCHEMA), spark.createDataFrame(ended, SCHEMA)), as_of)
    assert {d.rpartition("=")[2] for d in before - set(warehouse.added("mrr_level"))} == {"2024-11", "2024-12"}
    assert rows(increments.read_mrr(warehouse)) == rows(subscriptions.fct_mrr(spark.createDataFrame([*ended, old[1]], SCHEMA), as_of))


@pytest.mark.parametrize("seed", [1, 2])
def test_history_by_increments_equals_a_rebuild_in_any_order(spark, warehouse, seed):
    r = random.Random(seed)
    data = [(k, r.choice([None, *range(5)]), r.choice(PLANS), date(2023, 1, 1) + timedelta(days=r.randrange(25)), None, 1.0, "x") for k in range(70)]
    data += [(99, 1, "pro", None, None, 1.0, "x")]
    if seed > 1:
        r.shuffle(data)
    else:  # most days in order
        data.sort(key=lambda x: (x[3] or date(2023, 1, 1)))
    seen: list[tuple] = []
    for number in range(4):
        part = data[number * 18 : number * 18 + 18]
        seen += part
        increments.increment_history(warehouse, spark.createDataFrame(part, SCHEMA), ("history", number))
        whole = subscriptions.plan_history(spark.createDataFrame(seen, SCHEMA))
        assert rows(increments.read_history(warehouse)) == rows(whole)
    increments.compact_history(warehouse)
    assert rows(increments.read_history(warehouse)) == rows(whole)
    assert warehouse.read("plan_reset", increments.schemas.PLAN_RESETS).count() == 0
    increments.increment_history(warehouse, spark.createDataFrame(data[:5], SCHEMA))  # the same rows again
    assert rows(increments.read_history(warehouse)) == rows(whole)


def test_newer_days_read_no_old_ones(spark, warehouse, monkeypatch):
    first = [(1, 1, "a", date(2023, 1, 1), None, 1.0, "x"), (2, 2, "a", date(2023, 1, 1), None, 1.0, "x")]
    increments.increment_history(warehouse, spark.createDataFrame(first, SCHEMA))
    read = type(warehouse).read
    opened = []
    monkeypatch.setattr(type(warehouse), "read", lambda self, table, *a, **k: opened.append(table) or read(self, table, *a, **k))
    second = [(3, 1, "b", date(2023, 2, 1), None, 1.0, "x"), (4, 3, "b", date(2022, 2, 1), None, 1.0, "x")]
    increments.increment_history(warehouse, spark.createDataFrame(second, SCHEMA))
    assert opened == ["plan_open"]
    monkeypatch.undo()
    assert rows(increments.read_history(warehouse)) == rows(subscriptions.plan_history(spark.createDataFrame(first + second, SCHEMA)))
