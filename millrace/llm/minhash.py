"""Near duplicates by circulant MinHash: which documents share at least 80 % of their two-word shingles?

Two permutations make the whole signature. The first scatters the shingles of a document over a circle of 2**32 places, the
second gives every place its rank; coordinate ``k`` is the least rank among the document's places, each moved on by ``k``.
Both are invertible mixes of 32-bit numbers, so nothing is stored and no two shingles of a set are merged but by the 32-bit
hash they start from. ``BANDS`` bands of ``ROWS`` coordinates make the candidates: two sets that just reach the threshold
meet in some band but for one case in twenty million, those above it even more surely.

Equal sets are one set from here on. In each band the sets with equal coordinates form the family of the one with the
smallest hash; families are handed to the exact comparison on full shingle sets, which splits large ones into cells, derives
the answers of a set from those of a similar one and returns no more links than the classes need. No pair is confirmed from
signatures.

Defined cases: null texts and texts without words have an empty set, which links with nothing; a text of fewer than two
words is one shingle; repeated rows are equal sets; rows without an id belong to the class of their set, whose id is the
smallest one there is, or null; an empty table gives an empty result. Sets are told apart by size and 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ..session import write_once
from .batches import Texts, mix, slices, tidy
from .components import components
from .jaccard_join import FAMILY_SHINGLES, PERCENT, exact_links, set_key, shingle_sets

SHINGLE = 2
#: 1 - (1 - 0.8 ** ROWS) ** BANDS: the share of pairs at the threshold that meet.
BANDS, ROWS = 40, 5

#: Shingles that are ranked at a time: the arrays stay in the processor's cache.
_CHUNK = 1 << 14


def _scatter(hashes: np.ndarray) -> np.ndarray:
    """The first permutation: places on the circle."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    x ^= x >> np.uint32(17)
    x *= np.uint32(0xED5AD4BB)
    x ^= x >> np.uint32(11)
    x *= np.uint32(0xAC4C1B51)
    x ^= x >> np.uint32(15)
    return x


def _rank(places: np.ndarray) -> np.ndarray:
    """The second permutation: the rank of every place."""
    x = places ^ (places >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """A row of ``length`` coordinates for each of the sets, which must not be empty."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    places = _scatter(np.concatenate(sets)) if len(sets) else np.empty(0, np.uint32)
    out = np.full((len(sets), length), np.uint32(0xFFFFFFFF), dtype=np.uint32)
    for begin in range(0, len(places), _CHUNK):
        chunk = places[begin : begin + _CHUNK]
        low, high = np.searchsorted(first, begin, "right") - 1, np.searchsorted(first, begin + len(chunk))
        cuts = np.maximum(first[low:high] - begin, 0)
        for k in range(length):
            out[low:high, k] = np.minimum(out[low:high, k], np.minimum.reduceat(_rank(chunk + np.uint32(k)), cuts))
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit hash for each row and band, which differs between bands."""
    rows = signature.shape[1] // bands
    grouped = signature.astype(np.uint64).reshape(len(signature), bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), grouped.shape[:2]).copy()
    for i in range(rows):
        keys = mix(keys + grouped[:, :, i])
    return keys.view(np.int64)


_SETS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n", LongType()),
        StructField("k", LongType()),
        StructField("bands", ArrayType(LongType())),
    ]
)


def _sets(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """A row for each document with the size and hash of its set and its band keys. A set that a task meets again, or an
    empty one, goes without keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = list(shingle_sets(Texts.of(piece["text"]), size))
                keys = [set_key(s) for s in sets]
                new = []
                for i, k in enumerate(keys):
                    if len(sets[i]) and k not in met:
                        met.add(k)
                        new.append(i)
                made = band_keys(signatures([sets[i] for i in new], bands * rows), bands)
                ends = np.zeros(len(sets) + 1, dtype=np.int32)
                ends[np.array(new, dtype=np.int64) + 1] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(made.ravel()))
                columns = [piece["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=_SETS.fieldNames())

    return docs.mapInArrow(tidy(run), _SETS)


def _members(sets: DataFrame) -> DataFrame:
    """``k, n, pivot``: the sets of each band with equal coordinates, with the one of the smallest hash, itself included."""
    entries = sets.select("k", "n", F.explode("bands").alias("band")).distinct()
    pivots = entries.groupBy("band").agg(F.min("k").alias("pivot"), F.max("k").alias("_last")).filter("pivot <> _last")
    return entries.join(pivots, "band").select("k", "n", "pivot").distinct()


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    family_shingles: int = FAMILY_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` (the document stands for its class) for every row."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = write_once(_sets(docs, size, bands, rows), "minhash-sets")
    members = write_once(_members(found), "minhash-members")
    owners = found.filter("n > 0").groupBy("k", "n").agg(F.min("doc_id").alias("owner"))
    labels = components(exact_links(docs, owners.select("k", "owner"), members, size, percent, family_shingles))

    linked = owners.join(labels, F.col("k") == F.col("node")).select("k", "n", "owner", "label")
    smallest = linked.groupBy("label").agg(F.min("owner").alias("component_id"))
    classes = linked.join(smallest, "label").select(F.col("k").alias("_k"), F.col("n").alias("_n"), "component_id")
    classes = owners.join(classes, (F.col("k") == F.col("_k")) & (F.col("n") == F.col("_n")), "left").select(
        F.col("k").alias("_k"), F.col("n").alias("_n"), F.coalesce("component_id", "owner").alias("component_id")
    )
    # Written, so that the join can split the rows of a text with very many copies.
    classes = write_once(classes, "minhash-classes")
    joined = found.select("doc_id", "n", "k").join(classes, (F.col("k") == F.col("_k")) & (F.col("n") == F.col("_n")), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    result = joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
