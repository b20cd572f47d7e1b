"""Arrow batches of texts: bounded slices, words as byte ranges, and word hashes, all without a Python object per word.

A null text counts as an empty one everywhere. Batches are cut into slices of a few megabytes of text, so that memory
does not follow the number of rows in a batch; only one single text longer than that makes a slice larger.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 1 << 19
#: Bytes of an Arrow batch between Spark and its Python workers; rows are long texts, so counting rows would not bound it.
BATCH_BYTES = 4 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def byte_class(separators: bytes) -> np.ndarray:
    """True for each byte that belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: ``[^\x20\x09-\x0D]+``, and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text in which A-Z are lower-cased, so that they count
#: as word bytes before that too. Bytes from 0x80 on only occur inside other code points.
SPACED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
ALPHANUMERIC = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    out = []
    for base in (_MULTIPLIER, inverse):
        steps = np.full(size, base, dtype=np.uint64)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


_usual_powers = cache(lambda: _powers(2 * SLICE_BYTES))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the size of a slice they are kept; those for a single longer text are not."""
    up, down = _usual_powers() if size <= 2 * SLICE_BYTES else _powers(size)
    return up[:size], down[:size]


@dataclass
class Texts:
    """UTF-8 bytes of consecutive texts; text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
        column = pc.fill_null(column.cast(kind), pa.scalar("", kind))
        if column.offset:
            column = pa.concat_arrays([column])
        _, bounds, data = column.buffers()
        at = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
        return cls(whole[at[0] : at[-1]], at - at[0]) if len(at) else cls(whole[:0], np.zeros(1, np.int64))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def characters_before(self) -> np.ndarray:
        """For every byte position, and the end, the number of code points that begin before it."""
        out = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out


@dataclass
class Words:
    """Words of a slice as byte ranges; words of text ``i`` are those from ``first[i]`` to ``first[i + 1]``."""

    texts: Texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: Texts, word_bytes: np.ndarray) -> Words:
        inside = word_bytes[texts.data]
        before = np.zeros(len(inside), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), dtype=bool)
        after[:-1] = inside[1:]
        cuts = texts.bounds[1:-1]
        before[cuts[cuts < len(inside)]] = False
        after[cuts[cuts > 0] - 1] = False
        starts = np.flatnonzero(inside & ~before)
        return cls(texts, starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, texts.bounds))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word, alike in every batch."""
        return range_hashes(LOWER[self.texts.data] if lower else self.texts.data, self.starts, self.ends)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range that depends on its bytes alone; an empty range has hash ``mix(0)``."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@cache
def _place_values(size: int) -> tuple[np.uint64, ...]:
    return tuple(mix(np.arange(1000, 1000 + size, dtype=np.uint64)) | np.uint64(1))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each word on; the last ``size - 1`` places are missing."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k, factor in enumerate(_place_values(size)):
        total += words[k : k + n] * factor
    return mix(total)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(False)
    piece = np.concatenate([[0], np.cumsum(sizes)[:-1]]) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(int(a), int(b - a))


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand over texts in batches of bounded size; steers memory only, results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


@cache
def _trim() -> Callable[[], object]:
    try:
        return functools.partial(ctypes.CDLL("libc.so.6").malloc_trim, 0)
    except (OSError, AttributeError):  # another C library, which has its own ways
        return lambda: None


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same work, after which the Python worker, which Spark keeps for later tasks, hands its free memory back."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in run(batches):
                yield batch
                del batch
        finally:
            release()

    return wrapped


def release() -> None:
    pa.default_memory_pool().release_unused()
    _trim()()


Columns = Callable[[pa.RecordBatch], dict[str, pa.Array]]


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` but those named, in whatever case."""
    gone = {name.lower() for name in names}
    return [c for c in df.columns if c.lower() not in gone]


def with_text_columns(
    df: DataFrame,
    text: str,
    added: StructType,
    make: Columns,
    keep: list[str] | None = None,
    also: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """Columns ``keep`` of ``df`` (all of them by default) and those that ``make`` computes from a slice.

    A column of ``df`` that has the name of a computed one is replaced by it. ``make`` sees the text, and the columns
    ``also``, even if they are not kept.
    """
    kept = without(df.select(*(df.columns if keep is None else keep)), added.fieldNames())
    read = list(dict.fromkeys([*kept, text, *also]))
    schema = StructType([StructField(f.name, f.dataType, True) for f in df.select(*kept).schema] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                made = make(piece)
                arrays = [piece[c] for c in kept]
                yield pa.RecordBatch.from_arrays(arrays + list(made.values()), names=kept + list(made))
            release()

    return df.select(*read).mapInArrow(tidy(run), schema)
