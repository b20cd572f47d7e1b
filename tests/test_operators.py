from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import calendar, keys, quality, rows as picking
from millrace.operators.trailing import trailing_metrics
from tests.helpers import rows

START = datetime(2024, 1, 1)


# Picking rows ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 7])
def test_keep_first_whatever_the_partitioning(spark, partitions):
    df = spark.createDataFrame(
        [("a", 3, "z"), ("a", 1, "x"), ("b", 2, "y"), (None, 5, "n2"), (None, 4, "n1")], "k string, seq int, v string"
    ).repartition(partitions)
    assert rows(picking.keep_first(df, ["k"], ["seq"]), "k", "v") == [("a", "x"), ("b", "y"), (None, "n1")]


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = picking.keep_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_keep_latest_breaks_ties(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1), 7), (1, date(2024, 1, 1), 9), (1, None, 11)], "k int, d date, id int")
    assert rows(picking.keep_latest(df, ["k"], ["d", "id"]), "id") == [(9,)]
    assert rows(picking.keep_latest(df, ["k"], ["d", "id"], n=2), "id") == [(7,), (9,)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert picking.duplicate_count(df, ["k"]).first()[0] == 3
    assert picking.duplicate_count(df.limit(0), ["k"]).first()[0] == 0


def test_frequency_orders_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"], "v string")
    assert [tuple(r) for r in picking.frequency(df, "v", "n", 2).collect()] == [("a", 2), ("b", 2)]


# Trailing metrics ----------------------------------------------------------------------------------------------------


def by_hand(points):
    """Expected multiset of (key, ts, value, moving average, previous) from (key, ts, value) points."""
    expected, seen = [], {}
    for key, ts, value in sorted(points, key=lambda p: (p[0] is not None, p[0] or "", p[1] is not None, p[1] or START, p[2])):
        past = seen.setdefault(key, [])
        window = [*past[-2:], value]
        expected.append((key, ts, value, round(sum(window) / len(window), 9), past[-1] if past else None))
        past.append(value)
    return sorted(expected, key=repr)


def trailing(spark, points, kind="timestamp_ntz", history=None, **kwargs):
    frames = [
        spark.createDataFrame(rows_, "k string, ts timestamp_ntz, v double").withColumn("ts", F.col("ts").cast(kind))
        for rows_ in (points, history or [])
    ]
    got = trailing_metrics(frames[0], "k", "ts", "v", frames[1] if history else None, **kwargs)
    return sorted(((r.k, r.ts, r.v, round(r.moving_avg, 9), r.previous) for r in got.collect()), key=repr)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    points=st.lists(
        st.tuples(st.sampled_from(["a", "a", "a", "b", None]), st.none() | st.integers(0, 40), st.integers(0, 50)), min_size=1, max_size=40
    ),
    ranges=st.sampled_from([None, 1, 3, 40]),
    kind=st.sampled_from(["timestamp", "timestamp_ntz"]),
)
def test_cuts_null_times_null_keys_and_bursts_change_nothing(spark, points, ranges, kind):
    points = [(k, None if s is None else START + timedelta(seconds=s), float(v)) for k, s, v in points]
    assert trailing(spark, points, kind, ranges=ranges) == by_hand(points)


@pytest.mark.parametrize("ranges", [None, 50])
def test_one_key_with_all_rows_in_one_minute_uses_many_tasks(spark, ranges):
    points = [("a", START + timedelta(milliseconds=n), float(n % 97)) for n in range(2000)]
    assert trailing(spark, points, ranges=ranges) == by_hand(points)
    cut = trailing_metrics(spark.createDataFrame(points, "k string, ts timestamp_ntz, v double"), "k", "ts", "v", ranges=50)
    assert cut.count() == 2000


@pytest.mark.parametrize("ranges", [None, 6])
def test_history_feeds_the_metrics_but_is_not_returned(spark, ranges):
    points = [("a", START + timedelta(minutes=m), float(m)) for m in range(6)]
    got = trailing(spark, points[4:], history=points[:4], ranges=ranges)
    assert got == [r for r in by_hand(points) if r[1] >= START + timedelta(minutes=4)]


# Keys ------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 5])
def test_dense_ids_number_without_gaps_in_order(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(partitions)
    numbered = keys.dense_ids(df, "n", ["v"])
    assert rows(numbered, "n", "v") == sorted(((i + 1, i) for i in range(1000)), key=repr)


def test_hashed_keys_and_their_collisions(spark):
    dim = spark.range(500).select(F.col("id").cast("string").alias("name")).withColumn("key", keys.hashed_key("name"))
    assert keys.key_collisions(dim, "key", ["name"]).count() == 0
    forced = dim.withColumn("key", F.lit(1))
    assert keys.key_collisions(forced, "key", ["name"]).first().natural_keys == 500


def test_lookup_key_leaves_unknown_keys_null(spark):
    fact = spark.createDataFrame([("a", 1.5), ("b", 2.0), ("a", 9.0)], "name string, price double")
    dim = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.0)], "id int, name string, price double")
    assert rows(keys.lookup_key(fact, dim, ["name", "price"], "id"), "name", "id") == [("a", 1), ("a", None), ("b", 2)]


# Quality ---------------------------------------------------------------------------------------------------------------


def checks():
    return [
        quality.Check("price > 0", quality.not_positive("price")),
        quality.Check("name is filled", F.col("name") == ""),
    ]


def test_gate_counts_nan_null_and_zero(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "a"), (2, float("nan"), "b"), (3, None, ""), (3, 0.0, "c"), (None, 1.0, "d"), (None, 1.0, None)],
        "id int, price double, name string",
    )
    report = quality.gate_report(df, checks(), unique_key="id")
    assert rows(report, "check_name", "violations") == [("id is unique", 2), ("name is filled", 2), ("price > 0", 3)]
    with pytest.raises(quality.DataQualityError, match="price > 0, name is filled, id is unique"):
        quality.enforce(report)


def test_gate_passes_on_no_rows(spark):
    empty = spark.createDataFrame([], "id int, price double, name string")
    for unique_key in (None, "id"):
        report = quality.gate_report(empty, checks(), unique_key)
        assert {r.violations for r in report.collect()} == {0}
        quality.enforce(report)
    assert quality.error_rate(empty, checks(), 0.05).first().passed


def test_error_rate_gate(spark):
    df = spark.range(100).select(F.when(F.col("id") < 5, 0.0).otherwise(1.0).alias("price"), F.lit("x").alias("name"))
    quality.enforce_error_rate(df, checks(), 0.05)
    with pytest.raises(quality.DataQualityError, match="5 of 100"):
        quality.enforce_error_rate(df, checks(), 0.04)


def test_declarative_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (4, "d")], "id int, v string")
    parent = spark.createDataFrame([(1,), (None,)], "pid int")
    assert rows(quality.not_null(df, "id"), "v") == [("c",), (None,)]
    assert rows(quality.unique(df, "id")) == [(1, 2)]
    assert rows(quality.relationships(df, "id", parent, "pid"), "id") == [(4,)]
    assert rows(quality.accepted_values(df, "v", ["a", "b", "c"]), "v") == [("d",)]
    in_one_pass = quality.model_report(df, "m", "id", ["id", "v"], {"v": ["a", "b", "c"]})
    assert rows(in_one_pass, "check_name", "violations") == [
        ("accepted_values m.v", 1), ("not_null m.id", 2), ("not_null m.v", 1), ("unique m.id", 1)
    ]
    assert {r.violations for r in quality.model_report(df.limit(0), "m", "id", ["v"]).collect()} == {0}
    report = quality.run_tests({"n": quality.not_null(df, "id"), "none": df.limit(0)})
    assert rows(report) == [("n", 2, False), ("none", 0, True)]


# Calendar --------------------------------------------------------------------------------------------------------------


def test_month_spine(spark):
    df = spark.createDataFrame([(date(2023, 11, 30),), (date(2024, 2, 1),), (None,)], "d date")
    assert rows(calendar.month_spine(df, "d", date(2024, 2, 15))) == [
        (date(2023, 11, 1),), (date(2023, 12, 1),), (date(2024, 1, 1),), (date(2024, 2, 1),)
    ]
    assert calendar.month_spine(df, "d", date(2023, 10, 31)).count() == 0
    assert calendar.month_spine(df.limit(0), "d", date(2023, 10, 31)).count() == 0


def test_fill_hours(spark):
    counts = spark.createDataFrame([(START, 2), (START + timedelta(hours=3), 1)], "hour timestamp_ntz, n bigint")
    assert [r.n for r in calendar.fill_hours(counts, "hour", "n").orderBy("hour").collect()] == [2, 0, 0, 1]
    assert calendar.fill_hours(counts.limit(0), "hour", "n").count() == 0
