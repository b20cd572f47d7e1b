"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from workload import dq, etl, logs, prices, sales, streams, subs, weather

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# The text operators, if they are there, have tests of their own.
TABULAR = sorted(name for family in (sales, prices, etl, logs, subs, weather, dq, streams) for name in family.QUERIES)


def test_every_query_has_a_counterpart():
    assert set(TABULAR) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", TABULAR)
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
