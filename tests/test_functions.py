from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace import functions as fn
from tests.helpers import one


@pytest.mark.parametrize(
    "text, expected",
    [(" a b ", "a b"), ("\t x　\r\n", "x"), (" \x1c\x85y", "y"), (" ", ""), ("", ""), ("z", "z")],
)
def test_strip_all(spark, text, expected):
    assert one(spark, text, "string", fn.strip_all) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-05", date(2024, 1, 5)),
        ("2024-1-5", date(2024, 1, 5)),
        (" 05/01/2024\t", date(2024, 1, 5)),
        ("5/1/2024", date(2024, 1, 5)),
        ("29/02/2024", date(2024, 2, 29)),
        ("31/02/2024", None),
        ("2023-02-29", None),
        ("13/13/2024", None),
        ("2024/01/05", None),
        ("2024-01", None),
        ("2024-01-05 10:00", None),
        ("05-01-2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_mixed_date(spark, text, expected):
    assert one(spark, text, "string", fn.parse_mixed_date) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        (" 2023-01-05 ", date(2023, 1, 5)),
        ("2023-1-5", date(2023, 1, 5)),
        ("2023/01/05", date(2023, 1, 5)),
        ("2023 1 5", date(2023, 1, 5)),
        ("2023-01-05 10:00:00", date(2023, 1, 5)),
        ("2023-01-05T10:00", date(2023, 1, 5)),
        ("2023-01-05 garbage", None),
        ("2023-01/05", None),
        ("2023-02-30", None),
        ("2023-02", None),
        ("2023", None),
        ("  ", None),
        (None, None),
    ],
)
def test_tolerant_date(spark, text, expected):
    assert one(spark, text, "string", fn.tolerant_date) == expected


@pytest.mark.parametrize("text, expected", [("2", 2), (" 7 ", 7), ("", 1), (None, 1), ("3.0", None), ("x", None), ("-1", -1)])
def test_quantity_defaults_to_one(spark, text, expected):
    assert one(spark, text, "string", lambda c: fn.whole_number(c, "1")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [(" 80.5\t", 80.5), ("1e3", 1000.0), ("-inf", -math.inf), ("5d", None), ("5.f", None), ("0x1p3", None), ("", None),
     ("1,5", None), (None, None)],
)
def test_real_number(spark, text, expected):
    assert one(spark, text, "string", fn.real_number) == expected


def test_cents(spark):
    assert one(spark, 49900, "bigint", fn.cents_to_dollars) == 499.0
    assert one(spark, 12345, "bigint", lambda c: fn.cents_to_dollars(c, 1)) == 123.5


@pytest.mark.parametrize(
    "start, end, months",
    [
        (date(2024, 1, 31), date(2024, 2, 1), 1),
        (date(2024, 1, 1), date(2024, 1, 31), 0),
        (date(2023, 12, 15), date(2024, 3, 1), 3),
        (date(2024, 3, 1), date(2024, 1, 31), -2),
    ],
)
def test_months_crossed(spark, start, end, months):
    assert one(spark, start, "date", lambda c: fn.months_crossed(c, F.lit(end))) == months


def test_date_key(spark):
    assert one(spark, date(2024, 1, 5), "date", fn.date_key) == 20240105


@pytest.mark.parametrize(
    "code, name",
    [(199, "server_error"), (200, "success"), (301, "success"), (399, "success"), (404, "client_error"),
     (499, "client_error"), (500, "server_error"), (600, "server_error")],
)
def test_status_class(spark, code, name):
    assert one(spark, code, "int", fn.status_class) == name


def test_change_direction(spark):
    assert [one(spark, v, "double", fn.change_direction) for v in (1.5, -0.1, 0.0, None)] == ["up", "down", "flat", "flat"]


def test_percent_without_rows_is_zero(spark):
    assert one(spark, 0, "bigint", lambda c: fn.percent(c, c)) == 0.0
    assert math.isclose(one(spark, 28, "bigint", lambda c: fn.percent(c, F.lit(30))), 93.33333333333333)


def test_percent_change_needs_a_previous_value_other_than_zero(spark):
    assert one(spark, 41000.0, "double", lambda c: fn.percent_change(c, F.lit(40000.0))) == 2.5
    assert one(spark, 1.0, "double", lambda c: fn.percent_change(c, F.lit(0.0))) is None
    assert one(spark, 1.0, "double", lambda c: fn.percent_change(c, F.lit(None).cast("double"))) is None


def test_missing_markers(spark):
    assert one(spark, "NA", "string", fn.missing_markers_to_null) is None
    assert one(spark, " ", "string", fn.missing_markers_to_null) == " "
