"""N-gram Jaccard join that skips by set relations: which documents share at least 80 % of their word shingles?

A document is the set of its distinct five-word shingles; documents with equal sets are one set from here on. All sets
use one order of shingles, rare ones first. Two sets over the threshold share a shingle among the first
``n - ceil(0.8 n) + 1`` of each, so these prefixes form the index.

Index level: an index list is sorted by size and position. From a set's size and the position of the shingle follows the
largest set it can still reach; where no set before reaches the next one, the list is cut into blocks, and blocks of one
set are skipped. Answer level: the sets of a block form the family of one of them, its pivot, so no pair of a block is
ever written out. In a family the answers of a set (how many shingles it shares with each other one) are counted from the
lists of its shingles; the answers of a set like it are derived from these, by the lists of the few shingles in which
the two differ. A family hands on one link per set at most, which is enough for the classes.

The order of shingles comes from a table of ``SLOTS`` counters, whose size does not depend on the input. It also bounds
the index lists: a shingle whose counter exceeds ``LIST_LIMIT`` is heavy, and its list is never brought together; its
pivot comes from a map-side aggregation. Families of more than ``FAMILY_SHINGLES`` are dealt out to cells so that any two
of their sets meet in one cell.

Defined cases: null texts and texts without words have an empty set, which links with nothing; a text of fewer than five
words is one shingle; repeated rows are equal sets; rows without an id belong to the class of their set, whose id is the
smallest one there is, or null; an empty table gives an empty result. Hashes have 64 bits: sets are told apart by size and
hash, shingles by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ..session import write_once
from .batches import SPACED, Texts, Words, mix, range_hashes, slices, tidy, window_hashes
from .components import components

SHINGLE = 5
PERCENT = 80
SLOTS = 1 << 20
LIST_LIMIT = 20_000
FAMILY_SHINGLES = 4_000_000
#: Ids of documents with the families they take part in, two numbers each, are broadcast up to this many families in all, and
#: joined by shuffle beyond.
BROADCAST_ROWS = 1_000_000

_BLOCK_SLOTS = 1 << 14
_SIGN = np.uint64(1 << 63)


def shingle_sets(texts: Texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles."""
    words = Words.of(texts, SPACED)
    hashes = words.hashes(lower=True)
    windows = window_hashes(hashes, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            found = np.sort(windows[a : b - size + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            yield mix(hashes[a:b] * np.arange(3, 2 * (b - a) + 3, 2, dtype=np.uint64)).sum(keepdims=True, dtype=np.uint64)
        else:
            yield hashes[:0]


def set_key(found: np.ndarray) -> int:
    """A hash of the set, as a signed number."""
    return int((mix(found ^ np.uint64(0x5BF03635)).sum(dtype=np.uint64) if len(found) else np.uint64(0)).astype(np.int64))


_SETS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text_key", LongType()),
        StructField("n", LongType()),
        StructField("k", LongType()),
        StructField("block", IntegerType()),
        StructField("slots", BinaryType()),
        StructField("uses", BinaryType()),
    ]
)


def _sets(docs: DataFrame, size: int, slots: int) -> DataFrame:
    """A row for each document with the size and hash of its set; and each task's shingle counts, slot by slot."""
    shift = np.uint64(64 - (slots - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses, waiting, held = np.zeros(slots, dtype=np.int64), [], 0
        for batch in batches:
            for piece in slices(batch, "text"):
                n, keys = [], []
                for found in shingle_sets(Texts.of(piece["text"]), size):
                    n.append(len(found))
                    keys.append(set_key(found))
                    waiting.append(found >> shift)
                held += sum(n)
                if held > 500_000:
                    uses += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=slots)
                    waiting, held = [], 0
                none = [pa.nulls(len(n), kind) for kind in (pa.int32(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [piece["doc_id"], piece["text_key"], pa.array(n, pa.int64()), pa.array(keys, pa.int64()), *none],
                    names=_SETS.fieldNames(),
                )
        if waiting:
            uses += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=slots)
        blocks = []
        for block, counts in enumerate(uses.reshape(-1, min(slots, _BLOCK_SLOTS))):
            if len(used := np.flatnonzero(counts)):
                blocks.append((block, used.astype(np.int32).tobytes(), counts[used].tobytes()))
        none = pa.nulls(len(blocks), pa.int64())
        columns = [pa.array([b[i] for b in blocks], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([none, none, none, none, *columns], names=_SETS.fieldNames())

    return docs.mapInArrow(tidy(run), _SETS)


def _uses(found: DataFrame, slots: int) -> np.ndarray:
    """How many shingles fall into each slot. Each block of slots is added up in a task of its own."""
    width = min(slots, _BLOCK_SLOTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(width, dtype=np.int64)

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "uses"])

        for batch in batches:
            for now, used, counts in zip(batch["block"].to_pylist(), batch["slots"], batch["uses"], strict=True):
                if now != block:
                    if block is not None:
                        yield sent()
                    block, total = now, np.zeros(width, dtype=np.int64)
                total[np.frombuffer(used.as_py(), dtype=np.int32)] += np.frombuffer(counts.as_py(), dtype=np.int64)
        if block is not None:
            yield sent()

    blocks = found.filter("block IS NOT NULL").select("block", "slots", "uses")
    uses = np.zeros(slots, dtype=np.int64)
    for row in blocks.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(run), "block int, uses binary").collect():
        uses[row.block * width : (row.block + 1) * width] = np.frombuffer(row.uses, dtype=np.int64)
    return uses


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


_ENTRIES = StructType([StructField(c, LongType()) for c in ("token", "place", "k", "heavy")])
_PLACE = 32


def _heavy(uses: np.ndarray, list_limit: int) -> np.ndarray:
    """Slots whose shingles may have lists too long for one task."""
    return uses > max(list_limit, 8 * uses.mean())


def _entries(docs: DataFrame, size: int, percent: int, uses: np.ndarray, list_limit: int) -> DataFrame:
    """The index: token, set size and position (``place``), set hash. A set that a task meets again is left out.

    Tokens are shingle hashes with the magnitude of their counter in front, which makes them sort rare first.
    """
    shift = np.uint64(64 - (len(uses) - 1).bit_length())
    magnitude = np.minimum(127, 4 * np.log2(np.maximum(uses, 1))).astype(np.uint64) << np.uint64(56)
    is_heavy = _heavy(uses, list_limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                columns: list[list[np.ndarray]] = [[], [], [], []]
                for found in shingle_sets(Texts.of(piece["text"]), size):
                    n, key = len(found), set_key(found)
                    if not n or key in met:
                        continue
                    met.add(key)
                    slot = (found >> shift).astype(np.int64)
                    token = magnitude[slot] | (found >> np.uint64(8))
                    first = _prefix_size(n, percent)
                    order = np.argpartition(token, first - 1)[:first]
                    order = order[np.argsort(token[order])]
                    columns[0].append(token[order].astype(np.int64))
                    columns[1].append((n << _PLACE) + np.arange(first, dtype=np.int64))
                    columns[2].append(np.full(first, key, dtype=np.int64))
                    columns[3].append(is_heavy[slot[order]].astype(np.int64))
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=_ENTRIES.fieldNames())

    return docs.mapInArrow(tidy(run), _ENTRIES)


_MEMBERS = StructType([StructField(c, LongType()) for c in ("k", "n", "pivot")])


def _members(entries: DataFrame, percent: int, any_heavy: bool) -> DataFrame:
    """For each block of more than one set: its sets with its pivot, the one with the smallest hash, itself included."""

    def blocks(token, place, k):
        n, position = place >> _PLACE, place & ((1 << _PLACE) - 1)
        # A set that first meets another at this position shares n - position shingles with it at most.
        reach = (n - position) * (100 + percent) // percent - n
        new = np.concatenate([[True], token[1:] != token[:-1]])
        group = np.cumsum(new) - 1
        span = int(max(reach.max(), n.max())) + 2
        furthest = np.maximum.accumulate(np.maximum(reach, 0) + group * span) - group * span
        cut = new.copy()
        cut[1:] |= furthest[:-1] < n[1:]
        first = np.flatnonzero(cut)
        sizes = np.diff(np.append(first, len(token)))
        block = np.repeat(np.arange(len(first)), sizes)
        pivot = np.minimum.reduceat(k, first)[block]
        several = (np.maximum.reduceat(k, first)[block] != pivot)
        return k[several], n[several], pivot[several]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3

        def send(part):
            found = np.unique(np.stack(blocks(*part), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(3)], names=_MEMBERS.fieldNames())

        for batch in batches:
            held = [np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(held, ("token", "place", "k"), strict=True)]
            if len(held[0]) and (end := int(np.searchsorted(held[0], held[0][-1]))):
                yield send([h[:end] for h in held])
                held = [h[end:] for h in held]
        if len(held[0]):
            yield send(held)

    light = entries.filter("heavy = 0").select("token", "place", "k")
    light = light.repartition("token").sortWithinPartitions("token", "place", "k").mapInArrow(tidy(run), _MEMBERS)
    if not any_heavy:
        return light.distinct()
    heavy = entries.filter("heavy = 1").select("token", "k", F.shiftright("place", _PLACE).alias("n")).distinct()
    pivots = heavy.groupBy("token").agg(F.min("k").alias("pivot"), F.max("k").alias("_last")).filter("pivot <> _last")
    heavy = heavy.join(pivots, "token").select("k", "n", "pivot")
    return light.unionByName(heavy).distinct()


class Classes:
    """Union-find over a few sets."""

    def __init__(self, size: int):
        self.up = list(range(size))
        self.count = size

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        self.count -= i != j
        return i != j


def family_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of sets over the threshold that connect all sets that such pairs connect, and no more of them than needed."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    classes, links = Classes(len(sets)), []

    def take(i: int, shared: np.ndarray) -> np.ndarray:
        linked = np.flatnonzero((100 + percent) * shared >= percent * (sizes + sizes[i]))
        links.extend((i, j) for j in linked.tolist() if classes.join(i, j))
        return linked

    if len(sets) == 2:
        shared = np.zeros(2, dtype=np.int64)
        shared[1] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        take(0, shared)
        return links
    owner = np.repeat(np.arange(len(sets)), sizes)
    token, column, used = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = used[column] > 1
    owner, column = owner[common], column[common]
    own = np.split(column, np.searchsorted(owner, np.arange(1, len(sets))))
    by_token = np.argsort(column, kind="stable")
    lists, at = owner[by_token], np.searchsorted(column[by_token], np.arange(len(token) + 1))

    def count(columns: np.ndarray) -> np.ndarray:
        """How often each set occurs in the lists of these tokens."""
        pieces = [lists[at[c] : at[c + 1]] for c in columns.tolist()]
        return np.bincount(np.concatenate(pieces), minlength=len(sets)) if pieces else np.zeros(len(sets), np.int64)

    done = np.zeros(len(sets), dtype=bool)
    for i in range(len(sets)):
        if classes.count == 1:
            break
        if done[i]:
            continue
        done[i] = True
        shared = count(own[i])
        for j in take(i, shared).tolist():
            if not done[j] and classes.count > 1:
                done[j] = True
                more = count(np.setdiff1d(own[j], own[i], assume_unique=True))
                take(j, shared + more - count(np.setdiff1d(own[i], own[j], assume_unique=True)))
    return links


_LINKS = StructType([StructField("a", LongType()), StructField("b", LongType())])


def exact_links(docs: DataFrame, owners: DataFrame, members: DataFrame, size: int, percent: int, family_shingles: int) -> DataFrame:
    """Links between sets, by their hashes, found within each family."""
    families = members.groupBy("pivot").agg(F.sum("n").alias("shingles"))
    parts = F.ceil(F.col("shingles") / F.lit(family_shingles)).cast("int")
    large = families.select("pivot", parts.alias("parts")).filter("parts > 1")
    dealt = members.join(large, "pivot", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("k"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.select("k", "pivot", "parts", mine.alias("mine"), other.alias("other")).filter("parts = 1 OR mine <> other")
    cell = F.least("mine", "other") * F.col("parts") + F.greatest("mine", "other")
    dealt = dealt.select("k", F.struct("pivot", cell.alias("cell")).alias("family"))

    wanted = owners.join(dealt.groupBy("k").agg(F.collect_list("family").alias("families")), "k")
    wanted = write_once(wanted.select(F.col("owner").alias("_owner"), "k", "families"), "join-wanted")
    if (wanted.agg(F.sum(F.size("families"))).first()[0] or 0) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_owner")))
    rows = rows.select("k", "text", F.explode("families").alias("f")).select("k", "text", "f.pivot", "f.cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, keys, sets = None, [], []

        def close():
            order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), keys[i]))
            found = family_links([sets[i] for i in order], percent) if len(sets) > 1 else []
            ends = [[keys[order[pair[side]]] for pair in found] for side in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], names=_LINKS.fieldNames())

        for batch in batches:
            for piece in slices(batch, "text"):
                columns = [piece[c].to_pylist() for c in ("pivot", "cell", "k")]
                for pivot, cell, k, found in zip(*columns, shingle_sets(Texts.of(piece["text"]), size), strict=True):
                    if (pivot, cell) != family:
                        if len(sets) > 1:
                            yield close()
                        family, keys, sets = (pivot, cell), [], []
                    if set_key(found) == k and (not keys or keys[-1] != k):  # rows of other texts may share an id
                        keys.append(k)
                        sets.append(found)
        if len(sets) > 1:
            yield close()

    return rows.repartition("pivot", "cell").sortWithinPartitions("pivot", "cell", "k").mapInArrow(tidy(run), _LINKS)


def jaccard_classes(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = SHINGLE,
    percent: int = PERCENT,
    slots: int = SLOTS,
    list_limit: int = LIST_LIMIT,
    family_shingles: int = FAMILY_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    ``text_key`` is ``xxhash64`` of the text. ``slots`` should be a power of two of about a shingle in a thousand.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = write_once(_sets(docs.withColumn("text_key", F.xxhash64("text")), size, slots), "join-sets")
    sets = found.filter("block IS NULL").select("doc_id", "text_key", "n", "k")
    uses = _uses(found, slots)

    entries = _entries(docs, size, percent, uses, list_limit)
    members = write_once(_members(entries, percent, bool(_heavy(uses, list_limit).any())), "join-members")
    owners = sets.filter("n > 0").groupBy("k", "n").agg(F.min("doc_id").alias("owner"))
    links = exact_links(docs, owners.select("k", "owner"), members, size, percent, family_shingles)
    labels = components(links)

    linked = owners.join(labels, F.col("k") == F.col("node")).select("k", "n", "owner", "label")
    smallest = linked.groupBy("label").agg(F.min("owner").alias("component_id"))
    linked = linked.join(smallest, "label").select("k", "n", "component_id")
    classes = owners.join(linked, ["k", "n"], "left").select(
        F.col("k").alias("_k"), F.col("n").alias("_n"), F.coalesce("component_id", "owner").alias("component_id")
    )
    # Written, so that the join can split the rows of a text with very many copies.
    classes = write_once(classes, "join-classes")
    joined = sets.join(classes, (F.col("k") == F.col("_k")) & (F.col("n") == F.col("_n")), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one_of_each_class(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id. Rows without words all stay."""
    classes = write_once(jaccard_classes(docs, text, doc_id, **options), "join-classes").filter("n_shingles > 0")
    twins = classes.groupBy("doc_id", "text_key", "component_id").agg(F.count(F.lit(1)).alias("rows"))
    chosen = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("chosen")
    stay = classes.groupBy(F.coalesce("component_id", "text_key").alias("c"), F.col("component_id").isNull().alias("x")).agg(chosen)
    stay = stay.select(F.col("chosen.doc_id").alias("d"), F.col("chosen.text_key").alias("t"))
    go = twins.join(stay, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left_anti")
    go = write_once(go.select(F.col("doc_id").alias("_go"), F.col("text_key").alias("_text_key")), "join-go")
    if go.count() <= BROADCAST_ROWS:
        go = F.broadcast(go)
    left = docs.join(go, F.col(doc_id).eqNullSafe(F.col("_go")) & (F.xxhash64(text) == F.col("_text_key")), "left_anti")
    if not twins.filter("rows > 1").isEmpty():
        has_words = F.col(text).rlike(r"[^\x20\x09-\x0D]")
        left = left.filter(has_words).dropDuplicates([doc_id, text]).unionByName(left.filter(~F.coalesce(has_words, F.lit(False))))
    return left
