"""Merkle manifest of a table, and octopus multiproofs that check its rows against it.

Every row is a leaf: the SHA-256 of its columns. The leaves of a group (a source) form a tree in the order of their ids,
sixteen nodes to a parent; the roots of the groups, in order, form the tree above them, whose root stands for the table.
Leaves are numbered by a range sort, so a group of any size is spread over tasks, and each level is one aggregation of
runs of sixteen.

Proofs are made for parts of ``PART_ROWS`` consecutive leaves. A part first names the minimal union of the nodes that the
proofs of all its leaves need and that it can't derive from its own leaves: going up level by level, the children of the
known nodes' parents that are not known themselves. These are fetched by one join. The part then derives its shared
interiors once and expands from them the proof of every single leaf: the siblings on its way to the root.

Defined cases: a null column is hashed as ``-``, so it differs from an empty text; null groups come first, null ids first
in their group; rows with equal ids are ordered by their leaf, and equal rows have equal leaves; a lone leaf is the root of
its group; an empty table has no rows and no root. Columns of the input that are not named take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.keys import dense_ids
from ..session import write_once
from .batches import release, tidy

FAN_OUT = 16
PART_ROWS = 4096
#: The tree of the groups' roots; the groups' own trees are numbered from 1.
_TOP = 0


def leaf_digest(*columns: Column) -> Column:
    """SHA-256, in hex, of the columns: each ``-`` if null, else its length in bytes, a colon and its value."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[written(c) for c in columns]), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass
class Manifest:
    """``leaves``: the rows with their ``tree``, ``place``, tree size ``n`` and ``part``. ``nodes``: ``tree, level, place,
    digest`` of every node. ``groups``: ``tree``, its ``group`` and size ``n``. ``root``: null for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None

    def save(self, path: str) -> None:
        for name in ("leaves", "nodes", "groups"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        root = StructType([StructField("root", StringType())])
        self.nodes.sparkSession.createDataFrame([(self.root,)], root).write.mode("overwrite").parquet(f"{path}/root")


def _levels(nodes: DataFrame, size: int) -> list[DataFrame]:
    """The levels of all trees (``tree, n, place, digest``, ``n`` nodes in the tree's level), up to single nodes."""
    levels = [nodes]
    while size > 1:
        size = -(-size // FAN_OUT)
        run = F.array_sort(F.collect_list(F.struct("place", "digest")))
        parents = levels[-1].filter("n > 1").groupBy(
            "tree", F.ceil(F.col("n") / FAN_OUT).cast("long").alias("n"), F.floor(F.col("place") / FAN_OUT).cast("long").alias("place")
        )
        level = parents.agg(F.sha2(F.concat_ws("", F.transform(run, lambda x: x["digest"])), 256).alias("digest"))
        levels.append(write_once(level, "merkle-level"))
    return levels


def _union(levels: list[DataFrame]) -> DataFrame:
    parts = [x.select("tree", F.lit(i).alias("level"), "place", "digest") for i, x in enumerate(levels)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build_manifest(rows: DataFrame, group: str, order: str, leaf: str, keep: list[str]) -> Manifest:
    """Trees over ``rows``, which hold a digest in ``leaf``; the leaves carry the columns ``keep`` on."""
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    rows = write_once(rows.select(F.col(group).alias("_group"), F.col(order).alias("_order"), F.col(leaf).alias("digest"), *kept), "merkle-leaves")
    placed = dense_ids(rows, "at", ["_group", "_order", "digest"])
    groups = placed.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    groups = write_once(dense_ids(groups, "tree", ["_group"]), "merkle-groups")
    count, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    # No hint: Catalyst broadcasts groups as long as they are few, else AQE splits a hot one.
    mine = groups.withColumnRenamed("_group", "_mine")
    leaves = placed.join(mine, F.col("_group").eqNullSafe(F.col("_mine"))).select(
        "tree",
        (F.col("at") - F.col("first")).alias("place"),
        "n",
        F.floor((F.col("at") - 1) / PART_ROWS).cast("long").alias("part"),
        "digest",
        *[f"_keep{i}" for i in range(len(keep))],
    )
    leaves = write_once(leaves, "merkle-placed")
    levels = _levels(leaves.select("tree", "n", "place", "digest"), largest or 0)
    tops = [x.filter("n = 1").select(F.lit(_TOP).cast("long").alias("tree"), F.lit(count).alias("n"), (F.col("tree") - 1).alias("place"), "digest") for x in levels]
    for other in tops[1:]:
        tops[0] = tops[0].unionByName(other)
    above = _levels(write_once(tops[0], "merkle-groups-roots"), count)
    nodes = _union(levels).unionByName(_union(above))
    root = above[-1].filter("n = 1").select("digest").first()
    return Manifest(leaves, nodes, groups.select("tree", F.col("_group").alias("group"), "n"), root and root.digest)


def missing_nodes(places: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each level the nodes, by place, that leaves at ``places`` of a tree of ``size`` leaves need for their proofs and
    can't derive together."""
    level, known = 0, np.unique(places)
    while size > 1:
        parents = np.unique(known // FAN_OUT)
        children = (parents[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
        yield level, np.setdiff1d(children[children < size], known, assume_unique=True)
        level, known, size = level + 1, parents, -(-size // FAN_OUT)


_REQUESTS = StructType(
    [StructField("part", LongType()), StructField("tree", LongType()), StructField("level", IntegerType()), StructField("place", LongType())]
)


def _requests(leaves: DataFrame, trees: int) -> DataFrame:
    """The nodes that each part has to fetch."""

    def wanted(part: int, tree: np.ndarray, place: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
        ends = np.append(first[1:], len(tree))
        own = [(int(tree[a]), place[a:b], int(n[a])) for a, b in zip(first, ends, strict=True)]
        for number, places, size in [*own, (_TOP, tree[first] - 1, trees)]:
            for level, nodes in missing_nodes(places, size):
                if len(nodes):
                    fixed = [pa.array(np.full(len(nodes), x), kind) for x, kind in ((part, pa.int64()), (number, pa.int64()), (level, pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*fixed, pa.array(nodes, pa.int64())], names=_REQUESTS.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            held = [np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(held, ("part", "tree", "place", "n"), strict=True)]
            cuts = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
            for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
                yield from wanted(int(held[0][a]), *[h[a:b] for h in held[1:]])
            if len(cuts):
                held = [h[cuts[-1] :] for h in held]
        if len(held[0]):
            yield from wanted(int(held[0][0]), *held[1:])

    rows = leaves.select("part", "tree", "place", "n").repartition("part").sortWithinPartitions("part", "tree", "place")
    return rows.mapInArrow(tidy(run), _REQUESTS)


class Ways:
    """The ways from some leaves of a tree up to its root, with everything beside them.

    ``known``: for each level the digests by place, those of the leaves and of fetched nodes; interiors are added here.
    ``above`` is the way of this tree's root in the tree above, if there is one.
    """

    def __init__(self, known: list[dict[int, str]], places: list[int], size: int, above: tuple[Ways, int] | None = None):
        self.known, self.above = known, above
        self.sizes = [size]
        while self.sizes[-1] > 1:
            self.sizes.append(-(-self.sizes[-1] // FAN_OUT))
        for level in range(len(self.sizes) - 1):
            places = sorted({place // FAN_OUT for place in places})
            for place in places:
                known[level + 1][place] = digest("".join(self._run(level, place)))
        self.root = known[len(self.sizes) - 1][0]
        self._siblings: dict[tuple[int, int], str] = {}
        self._folded: dict[tuple[int, int], str] = {}

    def _run(self, level: int, parent: int) -> list[str]:
        known = self.known[level]
        return [known[i] for i in range(parent * FAN_OUT, min((parent + 1) * FAN_OUT, self.sizes[level]))]

    def siblings(self, level: int, place: int) -> str:
        """Digests beside the way from a node to the topmost root, one after the other."""
        if (level, place) not in self._siblings:
            if self.sizes[level] == 1:
                out = self.above[0].siblings(0, self.above[1]) if self.above else ""
            else:
                run = self._run(level, place // FAN_OUT)
                del run[place % FAN_OUT]
                out = "".join(run) + self.siblings(level + 1, place // FAN_OUT)
            if level == 0:
                return out
            self._siblings[level, place] = out
        return self._siblings[level, place]

    def fold(self, level: int, place: int, value: str) -> str:
        """The topmost root that follows from the value of a node and its siblings. What is derived already is shared."""
        original = value == self.known[level][place]
        if original and (level, place) in self._folded:
            return self._folded[level, place]
        if self.sizes[level] == 1:
            out = self.above[0].fold(0, self.above[1], value) if self.above else value
        else:
            run = self._run(level, place // FAN_OUT)
            run[place % FAN_OUT] = value
            out = self.fold(level + 1, place // FAN_OUT, digest("".join(run)))
        if original and level:
            self._folded[level, place] = out
        return out


def _depth(size: int) -> int:
    depth = 1
    while size > 1:
        size, depth = -(-size // FAN_OUT), depth + 1
    return depth


def _expand(leaves: dict[str, list], fetched: dict[str, list], trees: int) -> dict[str, list[str]]:
    """Proofs of one part's leaves; ``leaves`` has columns ``tree, place, n, digest, claimed``."""
    known: dict[int, list[dict[int, str]]] = {_TOP: [{} for _ in range(_depth(trees))]}
    places: dict[int, list[int]] = {}
    sizes: dict[int, int] = {}
    for tree, place, n, value in zip(*(leaves[c] for c in ("tree", "place", "n", "digest")), strict=True):
        if tree not in sizes:
            sizes[tree], places[tree], known[tree] = n, [], [{} for _ in range(_depth(n))]
        places[tree].append(place)
        known[tree][0][place] = value
    for tree, level, place, value in zip(*(fetched[c] for c in ("tree", "level", "place", "digest")), strict=True):
        known[tree][level][place] = value
    ways = {tree: Ways(known[tree], places[tree], sizes[tree]) for tree in sizes}
    for tree, way in ways.items():
        known[_TOP][0][tree - 1] = way.root
    top = Ways(known[_TOP], [tree - 1 for tree in ways], trees)
    out: dict[str, list[str]] = {"subroot": [], "proof_sha256": [], "folded_root": []}
    for tree, way in ways.items():
        way.above = (top, tree - 1)
    for tree, place, claimed in zip(*(leaves[c] for c in ("tree", "place", "claimed")), strict=True):
        out["subroot"].append(ways[tree].root)
        out["proof_sha256"].append(digest(ways[tree].siblings(0, place)))
        out["folded_root"].append(ways[tree].fold(0, place, claimed))
    return out


def verify(manifest: Manifest, keep: list[str], claimed: str) -> DataFrame:
    """Columns ``keep``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the siblings of the leaf, one after the
    other), ``folded_root`` (what the column ``claimed`` and these siblings lead to) and ``verified``.

    ``keep`` is what the manifest was built to keep, in the same order; ``claimed`` is one of it.
    """
    trees = manifest.groups.count()
    fetched = _requests(manifest.leaves, trees).join(manifest.nodes, ["tree", "level", "place"])
    names = [f"_keep{i}" for i in range(len(keep))]
    claim = names[keep.index(claimed)]
    leaves = manifest.leaves.select("part", "tree", "place", "n", "digest", *names)
    made = ["subroot", "proof_sha256", "folded_root"]
    schema = StructType([*leaves.select("digest", *names).schema, *[StructField(c, StringType()) for c in made]])

    def prove(mine: pa.Table, others: pa.Table) -> pa.Table:
        rows = {c: mine[c].to_pylist() for c in ("tree", "place", "n", "digest")} | {"claimed": mine[claim].to_pylist()}
        found = _expand(rows, {c: others[c].to_pylist() for c in ("tree", "level", "place", "digest")}, trees)
        columns = [mine["digest"], *[mine[c] for c in names], *[pa.array(found[c], pa.string()) for c in made]]
        release()
        return pa.Table.from_arrays(columns, names=schema.fieldNames())

    proofs = leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(prove, schema)
    root = F.lit(manifest.root).cast("string")
    return proofs.select(
        *[F.col(a).alias(b) for a, b in zip(names, keep, strict=True) if b != claimed],
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def audit(docs: DataFrame, altered: Column, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id") -> DataFrame:
    """Manifest of ``docs``, against which every row is checked with ``altered`` in the place of its last column."""
    *others, last = [F.col(c) for c in columns]
    leaf = leaf_digest(*others, last)
    rows = docs.select(
        F.col(group).alias("_g"),
        F.col(order).alias("_o"),
        leaf.alias("_leaf"),
        F.when(altered.eqNullSafe(last), F.lit(None)).otherwise(leaf_digest(*others, altered)).alias("_claimed"),
    ).withColumn("_claimed", F.coalesce("_claimed", "_leaf"))
    manifest = build_manifest(rows, "_g", "_o", "_leaf", ["_o", "_claimed"])
    return verify(manifest, ["_o", "_claimed"], "_claimed").withColumnRenamed("_o", order)
