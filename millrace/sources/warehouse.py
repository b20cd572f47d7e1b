"""Versioned Parquet tables: full refresh, append, insert-if-absent and replace-on-key with one atomic publish.

Plain Parquet knows neither keys nor ``MERGE``. A warehouse is a folder of write-once directories plus a list of commits;
a commit names the directories it adds to the partitions of its tables and the partitions it takes away. Jobs first write
their new directories and then publish all of them with one commit, so a reader sees all tables of a job or none, a
directory is never overwritten while it is read, and a job that dies leaves the last commit in force. There is one writer
at a time, and the file system must rename files atomically, as HDFS and local disks do; on a store without that, two
writers at once are not told apart.

Commits hold their own changes only. Once they outnumber the directories in use, a snapshot of the state is written, from
which readers start: all metadata together grows with the number of directories ever added, not with its square.

A partitioned table needs a partition value that follows from the row's key (the day of a timestamp in the key, say).
Then a key can only ever be in one partition, and keyed writes read just the partitions the new rows fall in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from millrace.operators.rows import keep_first
from millrace.session import delete, empty_table

_TABLE, _PART = "_table", "_part"
_WHOLE = "all"  # the single partition of a table without partitions
_LEAST_COMMITS = 20  # between two snapshots


@dataclass
class Change:
    """New directories of one table, written but not yet published, and the version of the table they build on.

    ``parts`` adds to the partitions it names; those in ``dropped`` lose what they had before. ``content`` is the newest
    version whose rows a rewrite holds, which keeps rewritten rows from passing for new ones.
    """

    table: str
    parts: dict[str, list[str]]
    base: int
    replaces_table: bool = False
    dropped: list[str] = field(default_factory=list)
    content: int | None = None
    rows: DataFrame | None = field(default=None, repr=False)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._job = f"{self.root}/data/{uuid.uuid4().hex}"

    # Commits ------------------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def _names(self, path: str) -> list[str]:
        fs, jvm_path = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path)) if fs.exists(jvm_path) else []

    def _load(self, name: str) -> dict:
        fs, path = self._fs(f"{self.root}/commits/{name}")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _save(self, name: str, content: dict) -> bool:
        """Written aside and renamed, so that a file appears whole. False if the name is taken."""
        fs, target = self._fs(f"{self.root}/commits/{name}")
        _, draft = self._fs(f"{self.root}/commits/{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        return not fs.exists(target) and fs.rename(draft, target)

    def _state(self, before: int | None = None) -> dict:
        """What is published, or was with version ``before``: for each table its directories with their versions."""
        state = {"version": 0, "tables": {}, "changed": {}, "batches": {}, "progress": {}, "since_snapshot": 0}
        names = self._names(f"{self.root}/commits")
        within = lambda n: before is None or int(n[:10]) <= before
        if snapshots := [n for n in names if n.endswith(".snapshot") and within(n)]:
            state |= self._load(snapshots[-1])
        for name in [n for n in names if n.endswith(".json") and int(n[:10]) > state["version"] and within(n)]:
            _apply(state, self._load(name))
        return state

    def version(self) -> int:
        return self._state()["version"]

    def commit(
        self, *changes: Change, batch: tuple[str, int] | None = None, progress: dict[str, dict[str, int]] | None = None
    ) -> int:
        """Publish the changes together. ``batch`` records a stream's batch number with them (see ``seen``), ``progress``
        up to which version a job has read for each of its keys (see ``progress``)."""
        state = self._state()
        delta = {"version": state["version"] + 1, "changes": [], "batch": batch, "progress": progress or {}}
        for change in changes:
            if state["changed"].get(change.table, 0) > change.base:
                raise RuntimeError(f"{change.table} has changed since these rows were written")
            state["changed"][change.table] = delta["version"]
            fields = {"table": change.table, "add": change.parts}
            fields |= {"replace": True} if change.replaces_table else {}
            fields |= {"drop": change.dropped} if change.dropped else {}
            fields |= {"content": change.content} if change.content is not None else {}
            delta["changes"].append(fields)
        if not self._save(f"{delta['version']:010d}.json", delta):
            raise RuntimeError(f"version {delta['version']} was published by another writer")
        _apply(state, delta)
        if state["since_snapshot"] >= max(_LEAST_COMMITS, len(_directories(state))):
            self._save(f"{delta['version']:010d}.snapshot", state | {"since_snapshot": 0})
        self._job = f"{self.root}/data/{uuid.uuid4().hex}"
        return delta["version"]

    def progress(self, job: str) -> dict[str, int]:
        """Up to which version a job has read, for each key it has recorded."""
        return self._state()["progress"].get(job, {})

    def clean_up(self, keep: int = 1) -> int:
        """Remove the directories that none of the last ``keep`` versions uses, and the commits before the snapshot that
        these start from; returns how many directories went. Not to be called while a writer is at work."""
        newest = self.version()
        oldest = max(0, newest - keep + 1)
        used = set()
        for version in range(oldest, newest + 1):
            used |= _directories(self._state(version))
        removed = 0
        for job in self._names(f"{self.root}/data"):
            removed += self._prune(f"{self.root}/data/{job}", used)
        snapshots = [n for n in self._names(f"{self.root}/commits") if n.endswith(".snapshot") and int(n[:10]) <= oldest]
        for name in self._names(f"{self.root}/commits"):
            if name.endswith(".draft") or snapshots and name[:10] <= snapshots[-1][:10] and name != snapshots[-1]:
                delete(self.spark, f"{self.root}/commits/{name}")
        return removed

    def _prune(self, path: str, used: set[str]) -> int:
        """Remove what is unused below a folder, and the folder if nothing in it is used."""
        if path in used:
            return 0
        if not any(d.startswith(f"{path}/") for d in used):
            delete(self.spark, path)
            return 1
        return sum(self._prune(f"{path}/{name}", used) for name in self._names(path) if not name.startswith((".", "_SUCCESS")))

    def seen(self, stream: str, batch_id: int) -> bool:
        """Whether this batch of a stream is published already: a restarted stream repeats its last batch."""
        return self._state()["batches"].get(stream, -1) >= batch_id

    # Reading ------------------------------------------------------------------------------------------------------

    def open(self, dirs: Sequence[str], schema: StructType) -> DataFrame:
        """The rows of some of the directories that ``added`` names."""
        return self._open(dirs, schema)

    def _open(self, dirs: Sequence[str], schema: StructType) -> DataFrame:
        if not dirs:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*dirs)

    def tables(self) -> list[str]:
        """Names of the published tables."""
        return sorted(self._state()["tables"])

    def has(self, table: str) -> bool:
        return table in self._state()["tables"]

    def added(self, table: str, after: int = 0, since: str | None = None) -> list[str]:
        """Directories of rows that versions beyond ``after`` have brought; ``since`` skips partitions below that value."""
        parts = self._state()["tables"].get(table, {})
        wanted = [dirs for value, dirs in parts.items() if since is None or value >= since]
        return [d for dirs in wanted for d, version in dirs if version > after]

    def read(self, table: str, schema: StructType, after: int = 0, since: str | None = None) -> DataFrame:
        """The published rows, or a part of them as in ``added``. An unknown table is empty, see ``has``."""
        return self._open(self.added(table, after, since), schema)

    # Writing ------------------------------------------------------------------------------------------------------

    def _write(self, table: str, df: DataFrame, partition: Column | None) -> dict[str, list[str]]:
        path = f"{self._job}/{table}-{uuid.uuid4().hex}"
        if partition is None:
            df.write.parquet(path)
            return {_WHOLE: [path]}
        # Keyed writes come out of a shuffle by key with every partition in every task. The hint lets AQE gather small
        # partitions into few files and split a large one over many tasks.
        df.withColumn(_PART, partition).hint("rebalance", _PART).write.partitionBy(_PART).parquet(path)
        return self._parts(path)

    def _parts(self, path: str) -> dict[str, list[str]]:
        prefix = f"{_PART}="
        return {n[len(prefix):]: [f"{path}/{n}"] for n in self._names(path) if n.startswith(prefix)}

    def _change(self, state: dict, table: str, new: dict, schema: StructType, kept: dict | None = None) -> Change:
        """Adds ``new`` to its partitions; ``kept``, if given, takes the place of what they held."""
        parts, dropped, content = new, [], None
        if kept is not None:
            parts = {value: [*kept.get(value, []), *new.get(value, [])] for value in {**kept, **new}}
            held = state["tables"].get(table, {})
            dropped = [value for value in parts if value in held]
            content = max((version for value in dropped for _, version in held[value]), default=None) if not new else None
        return Change(table, parts, state["version"], dropped=dropped, content=content, rows=self._open(_all(new), schema))

    def replace(self, table: str, df: DataFrame, partition: Column | None = None) -> Change:
        """Full refresh."""
        state = self._state()
        new = self._write(table, df, partition)
        return Change(table, new, state["version"], replaces_table=True, rows=self._open(_all(new), df.schema))

    def append(self, table: str, df: DataFrame, partition: Column | None = None) -> Change:
        state = self._state()
        return self._change(state, table, self._write(table, df, partition), df.schema)

    def deal_out(
        self, df: DataFrame, routes: dict[str, tuple[Column, Column | None]], refresh: bool = False
    ) -> list[Change]:
        """Write ``df`` once and give each row to the first table whose condition it meets, as an append or a refresh.

        ``routes`` maps a table to its condition and its partition. The files keep all columns of ``df``; a reader of a
        table names the ones it wants. Rows are written by the task that has them, without a shuffle: this is for input
        straight from files, which cover few partitions each.
        """
        state = self._state()
        target, part = F.lit(None), F.lit(None)
        for table, (condition, partition) in reversed(routes.items()):
            target = F.when(condition, table).otherwise(target)
            part = F.when(condition, F.lit(_WHOLE) if partition is None else partition).otherwise(part)
        path = f"{self._job}/{uuid.uuid4().hex}"
        dealt = df.withColumns({_TABLE: target, _PART: part}).filter(F.col(_TABLE).isNotNull())
        dealt.write.partitionBy(_TABLE, _PART).parquet(path)
        changes = []
        for table in routes:
            new = self._parts(f"{path}/{_TABLE}={table}")
            change = self._change(state, table, new, df.schema)
            change.replaces_table = refresh
            changes.append(change)
        return changes

    def insert_if_absent(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[Column | str],
        required: Sequence[str],
        partition: Column | None = None,
    ) -> Change:
        """Append the rows whose key is new; see ``absent_rows`` for the rules."""
        state = self._state()
        schema = df.drop("seq").schema
        candidates = self._write(table, admissible_rows(df, keys, order, required).drop("seq"), partition)
        old = _held(state, table, candidates)
        new = {value: dirs for value, dirs in candidates.items() if value not in old}
        if old:
            arrived = self._open(_all({value: candidates[value] for value in old}), schema)
            absent = arrived.join(self._open(_all(old), schema).select(*keys), list(keys), "left_anti")
            new.update(self._write(table, absent.select(*schema.names), partition))
        return self._change(state, table, new, schema)

    def upsert(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[Column | str],
        partition: Column | None = None,
    ) -> Change:
        """Replace on key: an incoming row takes the place of the whole stored row, the last of a batch wins."""
        state = self._state()
        new = self._write(table, keep_first(df, keys, [_descending(c) for c in order]), partition)
        held = _held(state, table, new)
        arrived, stored = self._open(_all(new), df.schema).select(*keys), self._open(_all(held), df.schema)
        # Only if a stored key is hit do the partitions concerned have to be rewritten.
        kept = None
        if held and not stored.join(arrived, list(keys), "left_semi").isEmpty():
            kept = self._write(table, stored.join(arrived, list(keys), "left_anti").select(*df.columns), partition)
        return self._change(state, table, new, df.schema, kept)

    def compact(self, table: str, schema: StructType, partition: Column | None = None, max_dirs: int = 16) -> Change:
        """Rewrite the partitions that many small writes have spread over more than ``max_dirs`` directories."""
        state = self._state()
        parts = state["tables"].get(table, {})
        scattered = _held(state, table, [value for value, dirs in parts.items() if len(dirs) > max_dirs])
        kept = self._write(table, self._open(_all(scattered), schema), partition) if scattered else {}
        return self._change(state, table, {}, schema, kept)


def _apply(state: dict, delta: dict) -> None:
    """Bring a state up to the version of a commit."""
    version = state["version"] = delta["version"]
    state["since_snapshot"] += 1
    for change in delta["changes"]:
        table = change["table"]
        state["changed"][table] = version
        parts = {} if change.get("replace") else state["tables"].get(table, {})
        for value in change.get("drop", ()):
            parts.pop(value, None)
        for value, dirs in change["add"].items():
            parts.setdefault(value, []).extend([d, change.get("content", version)] for d in dirs)
        state["tables"][table] = parts
    if delta["batch"]:
        state["batches"][delta["batch"][0]] = delta["batch"][1]
    for job, versions in delta["progress"].items():
        state["progress"].setdefault(job, {}).update(versions)


def _directories(state: dict) -> set[str]:
    return {d for parts in state["tables"].values() for dirs in parts.values() for d, _ in dirs}


def _held(state: dict, table: str, values: Sequence[str]) -> dict[str, list[str]]:
    """Directories of the named partitions of a table, as far as it has them."""
    parts = state["tables"].get(table, {})
    return {value: [d for d, _ in parts[value]] for value in values if value in parts}


def _all(parts: dict[str, list[str]]) -> list[str]:
    return [d for dirs in parts.values() for d in dirs]


def _descending(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).desc_nulls_last()


# The same rules on plain frames, for use without a warehouse.


def admissible_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], required: Sequence[str]
) -> DataFrame:
    """Rows a keyed insert may take: required columns filled (NaN counts as empty), the first row of each key."""
    filled = F.lit(True)
    for name in required:
        filled = filled & F.col(name).isNotNull()
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            filled = filled & ~F.isnan(name)
    return keep_first(df.filter(filled), keys, order)


def absent_rows(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    required: Sequence[str] = (),
) -> DataFrame:
    """Incoming rows to insert: a key already stored wins, then the first row of a key in the batch.

    Rows with an empty required column are skipped without an error.
    """
    stored = target.select(*keys)
    candidates = admissible_rows(incoming, keys, order, required)
    return candidates.join(stored, list(keys), "left_anti").select(*incoming.columns)


def replace_on_key(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The target after a replace-on-key write of ``incoming``; the last row of a key in ``order`` wins."""
    latest = keep_first(incoming, keys, [_descending(c) for c in order]).select(*target.columns)
    return target.join(latest.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(latest)


def save_layer(df: DataFrame, layer: str, name: str, location: str | None = None) -> None:
    """Materialise a model in its layer: staging as a view, every other layer as a table of that database, whose folder is
    one of its own in ``location`` if it is new."""
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return
    where = f" LOCATION '{location}/{layer}'" if location else ""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{where}")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{layer}`.`{name}`")


def look_up(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``name``, ``found`` and ``columns`` of tables of the catalog, named with or without their layer."""
    rows = [(n, found := spark.catalog.tableExists(n), len(spark.table(n).columns) if found else None) for n in names]
    return spark.createDataFrame(rows, "name string, found boolean, columns int")
