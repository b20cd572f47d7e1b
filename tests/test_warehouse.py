from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.sources.warehouse import Change, Warehouse, absent_rows, replace_on_key
from tests.helpers import rows

DDL = "k string, day string, v double"
KEYS = ["k", "day"]


def frame(spark, *data):
    return spark.createDataFrame(data, f"{DDL}, seq int")


def insert(warehouse, df):
    return warehouse.insert_if_absent("t", df, KEYS, ["seq"], ["k", "v"], F.col("day"))


def stored(warehouse, **kwargs):
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([StructField("k", StringType()), StructField("day", StringType()), StructField("v", DoubleType())])
    return rows(warehouse.read("t", schema, **kwargs))


def test_unknown_table_is_empty(warehouse):
    assert stored(warehouse) == [] and warehouse.version() == 0


def test_insert_if_absent_keeps_what_is_stored(spark, warehouse):
    warehouse.commit(insert(warehouse, frame(spark, ("a", "d1", 1.0, 2), ("a", "d1", 9.0, 1), ("b", "d2", 2.0, 1))))
    assert stored(warehouse) == [("a", "d1", 9.0), ("b", "d2", 2.0)]
    change = insert(
        warehouse,
        frame(spark, ("a", "d1", 5.0, 1), ("c", "d1", 3.0, 1), ("d", "d3", 4.0, 1), ("e", "d1", None, 1),
              ("f", "d1", float("nan"), 1), (None, "d1", 1.0, 1)),
    )
    assert rows(change.rows) == [("c", "d1", 3.0), ("d", "d3", 4.0)]
    warehouse.commit(change)
    assert stored(warehouse) == [("a", "d1", 9.0), ("b", "d2", 2.0), ("c", "d1", 3.0), ("d", "d3", 4.0)]
    assert stored(warehouse, since="d2") == [("b", "d2", 2.0), ("d", "d3", 4.0)]


def test_inserting_twice_changes_nothing(spark, warehouse):
    batch = frame(spark, ("a", "d1", 1.0, 1), ("b", "d1", 2.0, 1))
    for _ in range(2):
        warehouse.commit(insert(warehouse, batch))
    assert stored(warehouse) == [("a", "d1", 1.0), ("b", "d1", 2.0)]


def test_upsert_replaces_whole_rows_and_the_last_of_a_batch_wins(spark, warehouse):
    def upsert(*data):
        df = frame(spark, *data)
        return warehouse.upsert("t", df.drop("seq"), KEYS, ["v"], F.col("day"))

    warehouse.commit(upsert(("a", "d1", 1.0, 0), ("b", "d1", 2.0, 0), ("c", "d2", 3.0, 0)))
    untouched = dict(warehouse._state()["tables"]["t"])["d2"]
    warehouse.commit(upsert(("a", "d1", 7.0, 0), ("a", "d1", 8.0, 0), ("z", "d1", 0.0, 0)))
    assert stored(warehouse) == [("a", "d1", 8.0), ("b", "d1", 2.0), ("c", "d2", 3.0), ("z", "d1", 0.0)]
    assert warehouse._state()["tables"]["t"]["d2"] == untouched


def test_an_upsert_that_hits_no_key_rewrites_nothing(spark, warehouse):
    def upsert(*data):
        return warehouse.upsert("t", frame(spark, *data).drop("seq"), KEYS, ["v"], F.col("day"))

    warehouse.commit(upsert(("a", "d1", 1.0, 0)))
    first = warehouse._state()["tables"]["t"]["d1"]
    warehouse.commit(upsert(("b", "d1", 2.0, 0)))
    assert warehouse._state()["tables"]["t"]["d1"][:1] == first
    assert stored(warehouse) == [("a", "d1", 1.0), ("b", "d1", 2.0)]


def test_rows_are_dealt_out_to_the_first_table_that_takes_them(spark, warehouse):
    df = frame(spark, ("a", "d1", 1.0, 1), ("b", "d2", 2.0, 1), ("c", "d1", 9.0, 1), (None, "d1", 0.0, 1)).drop("seq")
    routes = {"t": (F.col("v") < 5, F.col("day")), "u": (F.col("k").isNotNull(), None)}
    for _ in range(2):
        warehouse.commit(*warehouse.deal_out(df, routes))
    assert stored(warehouse, since="d2") == [("b", "d2", 2.0)] * 2
    assert rows(warehouse.read("u", df.schema)) == [("c", "d1", 9.0)] * 2
    warehouse.commit(*warehouse.deal_out(df.filter("v > 5"), routes, refresh=True))
    assert stored(warehouse) == [] and warehouse.read("u", df.schema).count() == 1


def test_a_change_built_on_an_older_version_is_refused(spark, warehouse):
    one, two = (insert(warehouse, frame(spark, (k, "d1", 1.0, 1))) for k in "ab")
    with pytest.raises(RuntimeError, match="has changed"):
        warehouse.commit(one, two)
    warehouse.commit(one)
    with pytest.raises(RuntimeError, match="has changed"):
        warehouse.commit(two)
    assert stored(warehouse) == [("a", "d1", 1.0)]


def test_compaction_changes_directories_not_rows(spark, warehouse):
    df = frame(spark, ("a", "d1", 1.0, 1), ("b", "d2", 2.0, 1)).drop("seq")
    for _ in range(3):
        warehouse.commit(warehouse.append("t", df, F.col("day")))
    warehouse.commit(warehouse.append("t", df.filter("day = 'd1'"), F.col("day")))
    before = stored(warehouse)
    warehouse.commit(warehouse.compact("t", df.schema, F.col("day"), max_dirs=3))
    assert {v: len(dirs) for v, dirs in warehouse._state()["tables"]["t"].items()} == {"d1": 1, "d2": 3}
    assert stored(warehouse) == before
    assert not warehouse.compact("t", df.schema, F.col("day")).parts


def test_nothing_shows_before_the_commit(spark, warehouse):
    """A job that dies between writing and publishing leaves the last commit in force."""
    warehouse.commit(insert(warehouse, frame(spark, ("a", "d1", 1.0, 1))))
    insert(warehouse, frame(spark, ("b", "d1", 2.0, 1)))
    warehouse.replace("t", frame(spark, ("x", "d9", 0.0, 1)).drop("seq"), F.col("day"))
    again = Warehouse(spark, warehouse.root)
    assert stored(again) == [("a", "d1", 1.0)]
    again.commit(insert(again, frame(spark, ("b", "d1", 2.0, 1))))
    assert stored(warehouse) == [("a", "d1", 1.0), ("b", "d1", 2.0)]


def test_full_refresh_replaces_all_tables_at_once(spark, warehouse):
    old = frame(spark, ("a", "d1", 1.0, 1)).drop("seq")
    warehouse.commit(warehouse.replace("t", old, F.col("day")), warehouse.replace("u", old))
    new = frame(spark, ("b", "d2", 2.0, 1)).drop("seq")
    assert warehouse.commit(warehouse.replace("t", new, F.col("day")), warehouse.replace("u", new)) == 2
    assert stored(warehouse) == [("b", "d2", 2.0)] == rows(warehouse.read("u", new.schema))


def test_append_keeps_duplicates(spark, warehouse):
    df = frame(spark, ("a", "d1", 1.0, 1)).drop("seq")
    for _ in range(2):
        warehouse.commit(warehouse.append("t", df, F.col("day")))
    assert stored(warehouse) == [("a", "d1", 1.0)] * 2


def test_a_refresh_may_read_the_table_it_replaces(spark, warehouse):
    df = frame(spark, ("a", "d1", 1.0, 1)).drop("seq")
    warehouse.commit(warehouse.replace("t", df))
    doubled = warehouse.read("t", df.schema).withColumn("v", F.col("v") * 2)
    warehouse.commit(warehouse.replace("t", doubled))
    assert stored(warehouse) == [("a", "d1", 2.0)]


def test_batches_are_remembered(warehouse):
    assert not warehouse.seen("s", 0)
    warehouse.commit(batch=("s", 0))
    assert warehouse.seen("s", 0) and not warehouse.seen("s", 1) and not warehouse.seen("other", 0)


def test_metadata_stays_linear_and_a_snapshot_changes_nothing(spark, warehouse, tmp_path):
    """Commits of directories that are only named, not written: their number is what counts here."""
    for n in range(60):
        warehouse.commit(Change("t", {"all": [f"{warehouse.root}/data/{n:05}/t"]}, n))
    state = warehouse._state()
    assert [d[-7:] for d, _ in state["tables"]["t"]["all"]] == [f"{n:05}/t" for n in range(60)]
    files = sorted((tmp_path / "warehouse" / "commits").glob("*"))
    sizes = [f.stat().st_size for f in files if f.suffix == ".json"]
    snapshots = [f for f in files if f.suffix == ".snapshot"]
    assert max(sizes) < 1.2 * min(sizes) and 1 <= len(snapshots) <= 4
    assert sum(f.stat().st_size for f in snapshots) < 2 * sum(sizes)
    for version in (1, 19, 44, 60):
        assert len(warehouse._state(version)["tables"]["t"]["all"]) == version


def test_clean_up_leaves_what_the_kept_versions_use(spark, warehouse, tmp_path):
    def folders():
        return {p.parent for p in (tmp_path / "warehouse" / "data").rglob("*.parquet")}

    df = frame(spark, ("a", "d1", 1.0, 1), ("b", "d2", 2.0, 1)).drop("seq")
    for _ in range(3):
        warehouse.commit(warehouse.replace("t", df, F.col("day")), warehouse.append("log", df))
    warehouse.replace("t", df)  # a job that died
    assert len(folders()) == 3 * 3 + 1
    assert warehouse.clean_up(keep=2) == 2 and len(folders()) == 2 * 2 + 3
    assert warehouse.clean_up() == 1 and len(folders()) == 2 + 3
    assert stored(warehouse) == [("a", "d1", 1.0), ("b", "d2", 2.0)]
    assert warehouse.read("log", df.schema).count() == 6 and warehouse.clean_up() == 0


def test_directories_since_a_version_and_rewrites(spark, warehouse):
    df = frame(spark, ("a", "d1", 1.0, 1)).drop("seq")
    for n in range(3):
        warehouse.commit(warehouse.append("t", df.withColumn("v", F.lit(float(n))), F.col("day")))
    assert stored(warehouse, after=1) == [("a", "d1", 1.0), ("a", "d1", 2.0)]
    warehouse.commit(warehouse.compact("t", df.schema, F.col("day"), max_dirs=2))
    assert stored(warehouse, after=3) == [] and len(stored(warehouse)) == 3
    warehouse.commit(progress={"job": {"a": 3}})
    warehouse.commit(progress={"job": {"b": 4}})
    assert warehouse.progress("job") == {"a": 3, "b": 4} and warehouse.progress("other") == {}


def test_which_tables_there_are(spark, warehouse):
    assert not warehouse.has("t") and warehouse.tables() == []
    warehouse.commit(warehouse.append("t", frame(spark, ("a", "d1", 1.0, 1))))
    assert warehouse.has("t") and warehouse.tables() == ["t"]


@pytest.mark.parametrize("partitions", [1, 6])
def test_plain_frame_forms(spark, partitions):
    target = frame(spark, ("a", "d1", 1.0, 0)).drop("seq")
    batch = frame(spark, ("a", "d1", 5.0, 1), ("b", "d1", 7.0, 2), ("b", "d1", 6.0, 1)).repartition(partitions)
    new = absent_rows(target, batch, KEYS, ["seq"], ["v"])
    assert rows(new, "k", "v") == [("b", 6.0)]
    assert rows(replace_on_key(target, batch, KEYS, ["seq"])) == [("a", "d1", 5.0), ("b", "d1", 7.0)]
