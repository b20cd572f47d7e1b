"""Files with line breaks in fields, read block by block with cuts in every position, against Spark's reader of whole files."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.sources import csv_blocks
from millrace.sources.files import MissingColumn, read_csv, read_csv_parallel, read_sales_csv

COLUMNS = ["a", "b", "c"]
AWKWARD = (
    'a,c,b\n1,"two\nlines",x\n2,"say ""hi""\n\nand, more",y\n\n3,5" pipe,"z"\n4,,\n5,"",e\n'
    '6,"ends ""\n","q""\n"\n7,short\n8,"a"b,"c,\nd"x\n9,é"é,"ü\n"\n10,last,"without\nan end"'
)


@pytest.fixture
def cut(spark):
    """Sets the size of the blocks that files are read in."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, before)


def whole(spark, path):
    return [tuple(r) for r in read_csv(spark, path, COLUMNS).select(*COLUMNS).collect()]


def in_blocks(spark, path):
    return [tuple(r)[:3] for r in read_csv_parallel(spark, path, COLUMNS).orderBy("seq").collect()]


@pytest.mark.parametrize("end", ["\n", "\r\n"], ids=["unix", "windows"])
def test_cuts_in_every_position(spark, cut, tmp_path, end):
    path = tmp_path / "in.csv"
    path.write_bytes(AWKWARD.replace("\n", end).encode())
    wanted = whole(spark, str(path))
    assert len(wanted) == 10 and any("\n" in (r[1] or "") for r in wanted)
    for size in (1, 7, 1000):  # with blocks of one byte there is a cut in every position
        cut(size)
        assert in_blocks(spark, str(path)) == wanted, size


def test_random_files_of_many_records(spark, cut, tmp_path):
    r = random.Random(4)
    wanted = []
    for number in range(3):
        rows = [[str(i), "".join(r.choice(['"', "\n", ",", "x", "é", " "]) for _ in range(r.randrange(9))), r.choice(["", "k"])] for i in range(200)]
        quoted = [",".join('"' + f.replace('"', '""') + '"' if set(f) & set('",\n') or r.random() < 0.2 else f for f in row) for row in rows]
        (tmp_path / f"{number}.csv").write_text("\n".join(["a,b,c", *quoted]))
    wanted = sorted(whole(spark, str(tmp_path)), key=str)
    for size in (97, 10_000_000):
        cut(size)
        assert sorted(in_blocks(spark, str(tmp_path)), key=str) == wanted


def test_headers_are_found_and_must_agree(spark, tmp_path):
    (tmp_path / "1.csv").write_bytes(b"\xef\xbb\xbfb,a,c\n1,2,3\n")
    assert in_blocks(spark, str(tmp_path)) == [("2", "1", "3")]
    with pytest.raises(MissingColumn, match="d"):
        read_csv_parallel(spark, str(tmp_path), ["a", "d"])
    (tmp_path / "2.csv").write_text("a,b,c\n1,2,3\n")
    with pytest.raises(Exception, match="another header"):
        in_blocks(spark, str(tmp_path))


def test_sales_rows_are_the_same_either_way(spark, cut, tmp_path):
    names = "order_id,order_date,customer_name,customer_email,product_name,category,quantity,unit_price,city"
    rows = [f'{i},2024-01-01,"Ann{i}\nof {i % 7}",a@x,p,c,{"" if i % 5 else 1},2.5,N/A' for i in range(300)]
    (tmp_path / "s.csv").write_text("\n".join([names, *rows]) + "\n")
    cut(700)
    plain, parallel = (read_sales_csv(spark, str(tmp_path), parallel=p) for p in (False, True))
    assert plain.columns == parallel.columns and parallel.select(F.countDistinct("seq")).first()[0] == 300
    assert [tuple(r)[:-1] for r in parallel.orderBy("seq").collect()] == [tuple(r)[:-1] for r in plain.orderBy("seq").collect()]


field = st.text(st.sampled_from('",\nx'), max_size=6)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(field, min_size=1, max_size=3), min_size=1, max_size=4))
def test_states_of_well_formed_lines(rows):
    """Behind every line of a quoted record the field is open until the record ends."""
    for row in rows:
        inside = False
        lines = ",".join('"' + f.replace('"', '""') + '"' for f in row).encode().split(b"\n")
        for i, line in enumerate(lines):
            inside = csv_blocks.next_state(line, inside)
            assert inside == (i < len(lines) - 1)
