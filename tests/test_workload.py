"""How the mappings of the test tables spread their work."""

from __future__ import annotations

from pathlib import Path

import pytest

from tests.helpers import shuffled
from workload import sales

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


def test_landed_files_of_the_block_reader_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sales, "LINES_PER_FILE", 200, raising=False)
    monkeypatch.setattr(sales, "scratch_path", lambda spark, label: str(tmp_path / label))
    got = sales.scan_csv_blocks(spark, SF_DIR)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert len(list((tmp_path / "csv").glob("*.csv"))) == -(-lines // 200) > 2
    assert got.count() == lines


def test_lines_are_shuffled_by_part_order_and_order_id_only(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        lines = [s for s in shuffled(sales.cleaned(spark, SF_DIR)) if "l_linenumber" in s]
    finally:
        spark.conf.set(key, before)
    assert len(lines) == 3
    assert not any("c_name" in s for s in lines)


def test_the_failed_gate_joins_its_rows_once(spark, monkeypatch):
    joined = []
    real = sales.raw_sales
    monkeypatch.setattr(sales, "raw_sales", lambda *a: joined.append(1) or real(*a))
    landed = []
    write = sales.write_once
    monkeypatch.setattr(sales, "write_once", lambda df, label, **o: landed.append(label) or write(df, label, **o))
    assert sales.failed_gate(spark, SF_DIR).count() > 100
    assert (len(joined), landed) == (1, ["raw-sales"])
