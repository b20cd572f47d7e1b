"""Exact token counts of every prefix, for byte-pair vocabularies of the sentencepiece library.

The vocabulary has no piece in which white space follows something else, so no merge ever reaches across the start of a
segment: a run of white space with the text up to the next one. Segments are therefore encoded apart, and a text's
count at the end of each segment is a sum. Inside a segment a dynamic program over its prefixes finds the counts: the
encoding of a prefix is that of a shorter prefix and one more piece, and a piece may follow another one exactly if the
pair encodes to itself. That gives the token count at every prefix of the text, from which the count of the whole text,
truncation points and budget questions are read off without encoding anything again. ``with_prefix_counts`` stores the
counts beside the text; ``fitting_prefix`` and ``tokens_from`` answer from the stored ones alone.

A task runs the program once for each distinct segment and keeps its prefix counts, in a table that is emptied when it holds
``CACHE_SEGMENTS``. The program goes through many segments side by side, one prefix length at a time; only segments longer
than ``CACHED_LENGTH`` are gone through one by one. Every new segment's count is then held against the library's; a
difference fails the job.

Defined cases: a null text counts as empty: no bytes, no tokens; repeated rows are counted one by one; an empty table
gives an empty result; a computed column replaces one of the same name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from .batches import mix, range_hashes, with_text_columns

LIMIT = 4096
CACHE_SEGMENTS = 500_000
#: Segments longer than this are encoded each time: they seldom recur and would fill the table.
CACHED_LENGTH = 64
#: Characters of the segments that go through the program side by side.
CHUNK_CHARACTERS = 1 << 16
#: Pairs of pieces a task remembers: a table of 2 to this power, in which a pair replaces another one of its place.
PAIR_BITS = 22
_FILTER_BITS = 20

_MARK = "▁"
_SEGMENT = re.compile(f"[ {_MARK}]+[^ {_MARK}]*")


def _hashes(words: list[str]) -> np.ndarray:
    ends = np.cumsum([len(w.encode()) for w in words])
    return range_hashes(np.frombuffer("".join(words).encode(), dtype=np.uint8), np.append(0, ends[:-1]), ends)


class PrefixCounter:
    """Token counts of texts and all their prefixes for one sentencepiece model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(_MARK in piece.lstrip(_MARK) for piece in pieces):
            raise ValueError("a piece has white space inside: segments of this model cannot be counted apart")
        if self.library.encode("a b  c", out_type=str)[0] != f"{_MARK}a" or self.library.decode(self.library.encode("a b  c")) != "a b  c":
            raise ValueError("the model changes texts before it encodes them")
        control = (self.library.is_control, self.library.is_unknown, self.library.is_byte, self.library.is_unused)
        self.pieces = {p: i for i, p in enumerate(pieces) if not any(kind(i) for kind in control)}
        self.longest = max(map(len, self.pieces))
        self.known: dict[str, bytes] = {}  # 32-bit counts
        self.totals: dict[str, int] = {}
        self._followers: dict[tuple[str, str], bool] = {}
        # pieces in the order of their hashes; piece k of the list has number k + 1, as 0 stands for none
        hashes = {p: h for p, h in zip(self.pieces, _hashes(list(self.pieces)), strict=True)}
        self._names = sorted(self.pieces, key=hashes.__getitem__)
        self._hashes = np.array([hashes[p] for p in self._names], dtype=np.uint64)
        self._maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self._maybe[self._hashes >> np.uint64(64 - _FILTER_BITS)] = True
        self._pairs = np.zeros(1 << PAIR_BITS, dtype=np.uint64)

    @staticmethod
    def segments(text: str) -> list[str]:
        """The text as the library sees it, with its leading white space, cut before each run of white space."""
        return _SEGMENT.findall(" " + text) if text else []

    def _encoded(self, segments: list[str]) -> list[int]:
        """Token counts by the library, which puts a space in front of what it encodes: the segment's own first one."""
        found = self.library.encode([s[1:] for s in segments], num_threads=1)
        return [len(ids) if len(s) > 1 else 1 for s, ids in zip(segments, found, strict=True)]

    def learn(self, segments: set[str]) -> list[str]:
        """Have ``known`` hold the token counts of the prefixes of 1, 2, ... characters of each segment, ``totals`` the last.

        Returns the long segments, which should not stay there.
        """
        if len(self.known) > CACHE_SEGMENTS:
            self.known.clear()
            self.totals.clear()
        fresh = sorted(segments.difference(self.known), key=len)
        if not fresh:
            return []
        short = bisect_right(fresh, CACHED_LENGTH, key=len)
        counts = [*self._side_by_side(fresh[:short]), *map(self._inside, fresh[short:])]
        ends = np.cumsum([len(s) for s in fresh])
        every = np.concatenate(counts)
        totals = every[ends - 1].tolist()
        for segment, own, n in zip(fresh, totals, self._encoded(fresh), strict=True):
            if own != n:
                raise ValueError(f"{segment!r} has {n} tokens, not {own}: this model's pieces do not follow from pairs")
        stored, cuts = every.tobytes(), (every.itemsize * ends).tolist()
        self.known.update(zip(fresh, map(stored.__getitem__, map(slice, [0, *cuts], cuts)), strict=True))
        self.totals.update(zip(fresh, totals, strict=True))
        return fresh[short:]

    def count(self, text: str) -> int:
        return int(self.prefix_counts(text)[-1])

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, 2, ... characters of ``text``."""
        return self.of_texts([text])[0][0]

    def of_texts(self, texts: list[str], limit: int = 0, every: bool = True) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Counts at every prefix of each text (if ``every``), at its end, and the longest prefix of ``limit`` tokens at most.

        A text's first segment begins with a space that the library adds, so its first count is that of no character.
        """
        parts = [self.segments(t) for t in texts]
        long = self.learn(set(chain.from_iterable(parts)))
        prefixes, totals, cuts = [], [], []
        for text, segments in zip(texts, parts, strict=True):
            ends = np.cumsum([0, *map(self.totals.__getitem__, segments)])
            total = int(ends[-1])
            counts = None
            if every or total > limit:
                own = list(map(self.known.__getitem__, segments))
                inside = np.frombuffer(b"".join(own), dtype=np.int32)
                counts = inside + np.repeat(ends[:-1], np.fromiter(map(len, own), np.int64, len(own)) // inside.itemsize)
                counts = counts if own else np.zeros(1, dtype=np.int64)
                counts[0] = 0
            prefixes.append(counts)
            totals.append(total)
            cuts.append(len(text) if total <= limit else int(np.flatnonzero(counts <= limit)[-1]))
        for s in long:
            del self.known[s], self.totals[s]
        return prefixes, np.array(totals, dtype=np.int64), np.array(cuts, dtype=np.int64)

    def _are_encodings(self, pairs: list[tuple[str, str]]) -> list[bool]:
        """Whether the pieces of each pair side by side are the encoding of their text; the left one may be empty.

        Text that does not begin with a space is put behind a line break, which joins with nothing, as it is not at the
        start of a text: what the library then gives begins with the space it adds and the line break.
        """
        texts = ["".join(pair).replace(_MARK, " ") for pair in pairs]
        inner = [t[0] != " " for t in texts]
        found = self.library.encode(["\n" + t if i else t[1:] for t, i in zip(texts, inner, strict=True)], num_threads=1)
        ids = self.pieces
        return [
            t == " " or (f[2:] if i else f) == ([ids[a], ids[b]] if a else [ids[b]])
            for (a, b), t, i, f in zip(pairs, texts, inner, found, strict=True)
        ]

    def _follows(self, left: str, right: str) -> bool:
        key = left, right
        if key not in self._followers:
            if len(self._followers) > CACHE_SEGMENTS:
                self._followers.clear()
            self._followers[key] = self._are_encodings([key])[0]
        return self._followers[key]

    def _inside(self, segment: str) -> np.ndarray:
        """Token counts of the prefixes of 1, 2, ... characters of a segment."""
        text = segment.replace(" ", _MARK)
        count, last = [0] * (len(text) + 1), [""] * (len(text) + 1)
        for end in range(1, len(text) + 1):
            for begin in range(max(0, end - self.longest), end):
                piece = text[begin:end]
                if piece in self.pieces and self._follows(last[begin], piece):
                    count[end], last[end] = count[begin] + 1, piece
                    break
            else:  # a character without a piece is spelt out in bytes
                count[end], last[end] = count[end - 1] + len(text[end - 1].encode()), ""
        return np.array(count[1:], dtype=np.int32)

    def _side_by_side(self, segments: list[str]) -> Iterator[np.ndarray]:
        """What ``_inside`` gives for the segments, which come in order of length, one behind the other."""
        ends = np.cumsum([len(s) for s in segments])
        begin = 0
        while begin < len(segments):
            reach = (ends[begin - 1] if begin else 0) + CHUNK_CHARACTERS
            end = max(begin + 1, int(np.searchsorted(ends, reach, side="right")))
            yield self._chunk(segments[begin:end])
            begin = end

    def _chunk(self, segments: list[str]) -> np.ndarray:
        lengths = np.array([len(s) for s in segments])
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer("".join(segments).replace(" ", _MARK).encode(), dtype=np.uint8)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
        sizes = range(1, min(self.longest, int(lengths[-1])) + 1)
        where = [np.flatnonzero(place >= size - 1) for size in sizes]
        begins = np.concatenate([w - size + 1 for size, w in zip(sizes, where, strict=True)])
        numbers = self._numbers(range_hashes(data, at[begins], at[np.concatenate(where) + 1]))
        piece = np.zeros((len(sizes) + 1, len(place)), dtype=np.int64)  # the number of the piece of each size that ends here
        for size, w, found in zip(sizes, where, np.split(numbers, np.cumsum([len(w) for w in where])[:-1]), strict=True):
            piece[size, w] = found
        count, last = np.zeros(len(place), dtype=np.int32), np.zeros(len(place), dtype=np.int64)
        for length in range(1, int(lengths[-1]) + 1):
            open_ = starts[np.searchsorted(lengths, length) :] + length - 1
            for size in range(min(self.longest, length), 0, -1):
                right = piece[size][open_]
                has = np.flatnonzero(right)
                if not len(has):
                    continue
                ends, right = open_[has], right[has]
                before = ends - size
                fits = self._follow(last[before] if size < length else np.zeros_like(right), right)
                ends, before = ends[fits], before[fits]
                last[ends] = right[fits]
                count[ends] = 1 + (count[before] if size < length else 0)
                open_ = np.delete(open_, has[fits])
                if not len(open_):
                    break
            count[open_] = at[open_ + 1] - at[open_] + (count[open_ - 1] if length > 1 else 0)
        return count

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces that have these hashes, 0 for no piece."""
        out = np.zeros(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self._maybe[hashes >> np.uint64(64 - _FILTER_BITS)])
        wanted = hashes[maybe]
        found = np.minimum(np.searchsorted(self._hashes, wanted), len(self._hashes) - 1)
        out[maybe] = np.where(self._hashes[found] == wanted, found + 1, 0)
        return out

    def _follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_follows`` for numbers of pieces, 0 for an empty left one."""
        key = (left << 31 | right).astype(np.uint64)
        place = mix(key) >> np.uint64(64 - PAIR_BITS)
        held = self._pairs[place]
        fits = (held & np.uint64(1)).astype(bool)
        new = np.flatnonzero(held >> np.uint64(1) != key)
        if len(new):
            _, one, back = np.unique(key[new], return_index=True, return_inverse=True)
            one = new[one]
            pairs = [(self._names[a - 1] if a else "", self._names[b - 1]) for a, b in zip(left[one].tolist(), right[one].tolist(), strict=True)]
            answers = np.array(self._are_encodings(pairs))
            self._pairs[place[one]] = key[one] << np.uint64(1) | answers.astype(np.uint64)
            fits[new] = answers[back]
        return fits

    def longest_within(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most ``limit`` tokens."""
        return int(self.of_texts([text], limit, every=False)[2][0])


@cache
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


_TOKENS = StructType(
    [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType()), StructField("cut_at", LongType())]
)


def count_tokens(
    docs: DataFrame, model_file: Callable[[], str], text: str = "text", limit: int = LIMIT, keep: list[str] | None = None
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` and ``cut_at``, the longest prefix in characters within the limit.

    ``model_file`` is called in the tasks, so the file may lie elsewhere on each machine.
    """

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        tokens = counter(model_file())
        texts = pc.fill_null(batch[text], "")
        whole = texts.to_pylist()
        _, n, cut = tokens.of_texts(whole, limit, every=False)
        return {
            "n_bytes": pc.cast(pc.binary_length(texts), pa.int64()),
            "n_tokens": pa.array(n, pa.int64()),
            "over_limit": pa.array(n > limit),
            "cut_at": pa.array(cut, pa.int64()),
        }

    return with_text_columns(docs, text, _TOKENS, make, keep)


_PREFIXES = StructType([StructField("prefix_tokens", ArrayType(IntegerType()))])


def with_prefix_counts(docs: DataFrame, model_file: Callable[[], str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``prefix_tokens``: the token counts of the text's prefixes of 0, 1, 2, ... characters."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found, _, _ = counter(model_file()).of_texts(pc.fill_null(batch[text], "").to_pylist())
        ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        return {"prefix_tokens": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))}

    return with_text_columns(docs, text, _PREFIXES, make, keep)


def fitting_prefix(limit: Column | int, counts: Column | str = "prefix_tokens") -> Column:
    """Characters of the longest prefix of at most ``limit`` tokens, read off stored counts; a prefix may have more tokens
    than a longer one, so it is the last that fits."""
    at = F.transform(counts, lambda n, i: F.when(n <= limit, i))
    return F.array_max(at)


def tokens_from(prefix: Column | int, counts: Column | str = "prefix_tokens") -> Column:
    """Tokens of the whole text beyond those of the prefix of so many characters, read off stored counts."""
    return F.element_at(counts, -1) - F.element_at(counts, F.lit(prefix) + 1)
