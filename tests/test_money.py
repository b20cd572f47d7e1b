from __future__ import annotations

import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import money
from tests.helpers import one


def test_sums_do_not_depend_on_partitions(spark):
    r = random.Random(2)
    cents = [r.randrange(-10**9, 10**12) for _ in range(3_000)]
    data = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "v double")
    wanted = float(Fraction(sum(cents), 100))
    for parts in (1, 7, 50):
        assert data.repartition(parts).agg(money.exact_sum("v")).first()[0] == wanted
    assert data.filter("v IS NULL").agg(money.exact_sum("v")).first()[0] is None


@pytest.mark.parametrize("value", [float("nan"), float("inf"), -1e13])
def test_what_cannot_be_exact_is_an_error(spark, value):
    with pytest.raises(Exception, match="no exact amount"):
        one(spark, value, "double", money.units)


def test_a_sum_beyond_64_bits_is_an_error(spark):
    data = spark.range(20_000).select(F.lit(9e11).alias("v"))
    with pytest.raises(Exception, match="(?i)overflow"):
        data.agg(money.exact_sum("v")).collect()


@settings(max_examples=200, deadline=None)
@given(st.integers(-(10**13), 10**13))
def test_units_of_cents(cents):
    import math

    assert math.floor(cents / 100 * money.UNITS + 0.5) == cents * 100
