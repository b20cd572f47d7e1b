"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Text is lower-cased (A-Z) and cut into words of letters, digits and code points from U+0080 on. The automaton holds every
word sequence of every item once. Documents are streamed through it word by word; it tracks the longest sequence of an
item that ends at the current word. Wherever that reaches the window (or a whole item shorter than the window), the words
of the match are hit. Hit spans go from the text; a document of which more than a set share is hit goes as a whole.

Items are dealt by hash to shards of bounded size. Each shard's automaton is built in a task and packed into arrays. With one
shard the documents are read once. With more, each shard is a pass over the texts that writes its hits alone, and the hits
of all shards are joined to their documents at the end, so neither the driver nor a task ever holds more than one shard.

Defined cases: null and empty texts have no words and are never hit; items that are null or without words match nothing;
repeated items count once per ``item_id``, and items without one hit words but are not named; repeated rows are judged one by
one; with an empty benchmark nothing is hit. Words and word runs are told apart by 64-bit hashes.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from ..session import write_once
from .batches import ALPHANUMERIC, LOWER, Texts, Words, slices, tidy, window_hashes, with_text_columns, without

WINDOW = 10
#: Bytes of benchmark text in one automaton, on average; a single item longer than that makes a shard larger. Packed, an
#: automaton has some ten times as many bytes.
SHARD_BYTES = 1 << 20
MAX_SHARE = 0.5
#: Words of the runs that all have to occur in items before the automaton is asked.
GRAM = 4

_SPANS = StructType(
    [
        StructField("n_words", LongType()),
        StructField("hit_from", ArrayType(IntegerType())),
        StructField("hit_to", ArrayType(IntegerType())),
        StructField("items", ArrayType(StringType())),
    ]
)

Spans = list[list[tuple[int, int]]]


@dataclass
class Packed:
    """An automaton as arrays: steps of a state in order of their words, links and lengths of the states, and the windows
    that end in a state, as sizes and item numbers. ``ending`` leads from a state to the nearest one, going up the links
    from itself on, that has windows."""

    window: int
    shortest: int
    vocabulary: np.ndarray
    grams: np.ndarray
    first_step: np.ndarray
    step_word: np.ndarray
    step_to: np.ndarray
    link: np.ndarray
    length: np.ndarray
    ending: np.ndarray
    first_window: np.ndarray
    window_size: np.ndarray
    window_item: np.ndarray
    names: list[str]

    @property
    def gram(self) -> int:
        return min(GRAM, self.shortest)

    def _runs(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, begin and end of the runs of words whose grams all occur in items, if a match fits in."""
        if not len(self.grams) or len(hashes) < self.gram:
            return
        windows = window_hashes(hashes, self.gram)
        place = np.minimum(np.searchsorted(self.grams, windows), len(self.grams) - 1)
        known = np.concatenate([self.grams[place] == windows, [False]])
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        known[:-1] &= text_of[: len(windows)] == text_of[self.gram - 1 :]
        # Grams of two texts are parted by one across them, if a text has more words than a gram; else by the texts.
        change = np.flatnonzero(known[1:] & ~known[:-1]) + 1
        begin = np.concatenate([[0] * int(known[0]), change]).astype(np.int64)
        end = np.flatnonzero(known[:-1] & ~known[1:]) + 1
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            cuts = [a, *(np.flatnonzero(np.diff(text_of[a:b])) + a + 1).tolist(), b]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y - x + self.gram - 1 >= self.shortest:
                    yield int(text_of[x]), x, y + self.gram - 1

    def scan(self, hashes: np.ndarray, first: np.ndarray) -> tuple[Spans, list[set[str]]]:
        """For each text its hit spans, as from and to in words, and the items found in it."""
        spans: Spans = [[] for _ in range(len(first) - 1)]
        items: list[set[str]] = [set() for _ in range(len(first) - 1)]
        steps, words, to = memoryview(self.first_step), memoryview(self.step_word), memoryview(self.step_to)
        link, lengths, ending = memoryview(self.link), memoryview(self.length), memoryview(self.ending)
        named: dict[int, list[tuple[int, list[str]]]] = {}
        for text, a, b in self._runs(hashes, first):
            mine = spans[text]
            state = length = 0
            for i, word in enumerate(np.searchsorted(self.vocabulary, hashes[a:b]).tolist(), a - int(first[text]) + 1):
                while True:  # the longest match that ends with this word
                    at, end = steps[state], steps[state + 1]
                    at = bisect_left(words, word, at, end)
                    if at < end and words[at] == word:
                        state, length = to[at], length + 1
                        break
                    state = link[state]
                    if state < 0:
                        state = length = 0
                        break
                    length = lengths[state]
                best, here = 0, ending[state]
                while here >= 0:
                    if here not in named:
                        named[here] = self._windows(here)
                    for size, found in named[here]:
                        if size <= length:
                            best = max(best, size)
                            items[text].update(found)
                    here = ending[link[here]]
                if best:
                    begin = i - best
                    while mine and mine[-1][1] >= begin:
                        begin = min(begin, mine.pop()[0])
                    mine.append((begin, i))
        return spans, items

    def _windows(self, state: int) -> list[tuple[int, list[str]]]:
        a, b = self.first_window[state], self.first_window[state + 1]
        by_size: dict[int, list[str]] = {}
        for size, item in zip(self.window_size[a:b].tolist(), self.window_item[a:b].tolist(), strict=True):
            by_size.setdefault(size, []).extend([self.names[item]] if item >= 0 else [])
        return list(by_size.items())


class Automaton:
    """All word sequences of the items, as states with transitions by word number."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        texts = Texts.of(pa.array([text for _, text in items], pa.string()))
        words = Words.of(texts, ALPHANUMERIC)
        self.hashes = words.hashes(lower=True)
        self.vocabulary, numbers = np.unique(self.hashes, return_inverse=True)
        numbers = numbers.tolist()
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = defaultdict(set)
        for i, (item, _) in enumerate(items):
            if sequence := tuple(numbers[words.first[i] : words.first[i + 1]]):
                sequences[sequence] |= {item} - {None}
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.shortest = min([window, *map(len, sequences)])
        self.text_of = words.text_of
        self._name_windows(sequences)

    def _new(self, length: int, steps: dict[int, int], link: int) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.steps) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state for the sequences of ``target`` no longer than those of ``state`` and the word."""
        if self.length[state] + 1 == self.length[target]:
            return target
        half = self._new(self.length[state] + 1, dict(self.steps[target]), self.link[target])
        self.link[target] = half
        while state >= 0 and self.steps[state].get(word) == target:
            self.steps[state][word] = half
            state = self.link[state]
        return half

    def _extend(self, last: int, word: int) -> int:
        if word in self.steps[last]:  # another item has taken this way already
            return self._split(last, word, self.steps[last][word])
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.steps[last]:
            self.steps[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word, self.steps[last][word])
        return new

    def follow(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest match that ends with ``word``."""
        steps, link = self.steps, self.link
        while (to := steps[state].get(word)) is None:
            state = link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
        return to, length + 1

    def _holder(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of a match that ``state`` stands for."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _name_windows(self, sequences: dict[tuple[int, ...], set[str]]) -> None:
        """``own[state]``: the items of every window that ends where the longest match of that state does, by its size."""
        self.own: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for sequence, names in sequences.items():
            state = length = 0
            size = min(self.window, len(sequence))
            for word in sequence:
                state, length = self.follow(state, length, word)
                if length >= size:
                    self.own[self._holder(state, size)][size] |= names

    def pack(self) -> Packed:
        names = sorted({name for by_size in self.own.values() for found in by_size.values() for name in found})
        number = {name: i for i, name in enumerate(names)}
        ending = np.full(len(self.link), -1, dtype=np.int32)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            ending[state] = state if state in self.own else ending[self.link[state]]
        windows = [[(size, i) for size, found in self.own[s].items() for i in ([number[n] for n in sorted(found)] or [-1])] if s in self.own else [] for s in range(len(self.link))]
        ordered = [sorted(step.items()) for step in self.steps]
        size = min(GRAM, self.shortest)
        grams = window_hashes(self.hashes, size)
        inside = self.text_of[: len(grams)] == self.text_of[size - 1 :] if len(grams) else np.zeros(0, dtype=bool)
        flat = lambda rows, i: np.array([x[i] for row in rows for x in row], dtype=np.int32)
        ends = lambda rows: np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
        return Packed(
            window=self.window,
            shortest=self.shortest,
            vocabulary=self.vocabulary,
            grams=np.unique(grams[inside]),
            first_step=ends(ordered),
            step_word=flat(ordered, 0),
            step_to=flat(ordered, 1),
            link=np.array(self.link, dtype=np.int32),
            length=np.array(self.length, dtype=np.int32),
            ending=ending,
            first_window=ends(windows),
            window_size=flat(windows, 0),
            window_item=flat(windows, 1),
            names=names,
        )


def _automata(benchmark: DataFrame, item: str, text: str, window: int, shard_bytes: int) -> Iterator[Packed]:
    """The automaton of each shard, one after the other. Tasks build them; the driver sees one at a time."""
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = -(-size // shard_bytes) or 1
    shard = F.pmod(F.xxhash64(item, text), F.lit(count)).cast("int")
    rows = benchmark.filter(F.col(text).isNotNull())
    rows = rows.select(shard.alias("shard"), F.col(item).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, items = None, []

        def built() -> pa.RecordBatch:
            packed = pickle.dumps(Automaton(items, window).pack(), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed], pa.binary())], names=["shard", "packed"])

        for batch in batches:
            for number, name, words in zip(*(batch[c].to_pylist() for c in ("shard", "item", "text")), strict=True):
                if number != now and items:
                    yield built()
                    items = []
                now = number
                items.append((name, words))
        if items:
            yield built()

    built = write_once(rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(tidy(run), "shard int, packed binary"), "automata")
    for i in range(count):
        for row in built.filter(F.col("shard") == i).select("packed").collect():
            yield pickle.loads(row.packed)


Located = Callable[[pa.RecordBatch, Words], tuple[Spans, list[set[str]]]]


def _located(docs: DataFrame, text: str, automata: Iterator[Packed]) -> tuple[DataFrame, list[str], Located]:
    """``docs``, what else of it to read, and a function that says the spans and items of the texts of a batch."""
    one = next(automata, None)
    if one is None:
        return docs, [], lambda batch, words: ([[] for _ in range(len(words.texts))], [set() for _ in range(len(words.texts))])
    other = next(automata, None)
    if other is None:
        return docs, [], lambda batch, words: one.scan(words.hashes(lower=True), words.first)
    docs = write_once(docs.withColumn("_hit_row", F.monotonically_increasing_id()), "to-scan")
    hits = write_once(_hits(docs, text, one), "hits").unionByName(write_once(_hits(docs, text, other), "hits"))
    for automaton in automata:
        hits = hits.unionByName(write_once(_hits(docs, text, automaton), "hits"))
    every = [F.flatten(F.collect_list(c)).alias(c) for c in _HITS.fieldNames()[1:]]
    docs = docs.join(hits.groupBy("_hit_row").agg(*every), "_hit_row", "left")

    def read(batch: pa.RecordBatch, words: Words) -> tuple[Spans, list[set[str]]]:
        columns = [[x or [] for x in batch[c].to_pylist()] for c in _HITS.fieldNames()[1:]]
        return [_union(zip(a, b, strict=True)) for a, b in zip(*columns[:2], strict=True)], [set(x) for x in columns[2]]

    return docs, _HITS.fieldNames()[1:], read


_HITS = StructType(
    [
        StructField("_hit_row", LongType()),
        StructField("_hit_from", ArrayType(IntegerType())),
        StructField("_hit_to", ArrayType(IntegerType())),
        StructField("_hit_items", ArrayType(StringType())),
    ]
)


def _span_columns(spans: Spans, items: list[set[str]]) -> list[pa.Array]:
    whole = pa.list_(pa.int32())
    return [
        pa.array([[a for a, _ in s] for s in spans], whole),
        pa.array([[b for _, b in s] for s in spans], whole),
        pa.array([sorted(i) for i in items], pa.list_(pa.string())),
    ]


def _hits(docs: DataFrame, text: str, automaton: Packed) -> DataFrame:
    """The rows that one shard hits, with their spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                words = Words.of(Texts.of(piece[text]), ALPHANUMERIC)
                spans, items = automaton.scan(words.hashes(lower=True), words.first)
                hit = [i for i, s in enumerate(spans) if s]
                columns = _span_columns([spans[i] for i in hit], [items[i] for i in hit])
                yield pa.RecordBatch.from_arrays([piece["_hit_row"].take(pa.array(hit, pa.int64())), *columns], names=_HITS.fieldNames())

    return docs.select("_hit_row", text).mapInArrow(tidy(run), _HITS)


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``n_words``, hit spans in words (``hit_from``, ``hit_to``) and found ``items``.

    Spans are disjoint, in order, and end where ``hit_to`` says, exclusive.
    """
    keep = without(docs.select(*(docs.columns if keep is None else keep)), _SPANS.fieldNames())
    docs, also, located = _located(docs.select(*dict.fromkeys([*keep, text])), text, _automata(benchmark, item, item_text, window, shard_bytes))

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = Words.of(Texts.of(batch[text]), ALPHANUMERIC)
        columns = [pa.array(words.counts, pa.int64()), *_span_columns(*located(batch, words))]
        return dict(zip(_SPANS.fieldNames(), columns, strict=True))

    return with_text_columns(docs, text, _SPANS, make, keep, also)


def _union(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def hit_words() -> Column:
    """Number of words in the hit spans."""
    return F.aggregate(F.zip_with("hit_from", "hit_to", lambda a, b: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_share: float = MAX_SHARE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` without the hit spans; a document of which more than ``max_share`` of the words are hit goes.

    A span goes from the start of its first word up to the start of the word after it, so that the white space of a line
    end before it stays. Texts that are not hit stay as they are, byte by byte.
    """
    columns = docs.columns
    docs, also, located = _located(docs, text, _automata(benchmark, item, item_text, window, shard_bytes))
    edited = StructType([StructField(text, StringType()), StructField("_stays", BooleanType())])

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = Texts.of(batch[text])
        words = Words.of(texts, ALPHANUMERIC)
        spans, _ = located(batch, words)
        limits = np.append(words.starts, len(texts.data))
        out = []
        for i, mine in enumerate(spans):
            if not mine:
                continue
            at, pieces = texts.bounds[i], []
            for a, b in mine:
                pieces.append(texts.data[at : words.starts[words.first[i] + a]].tobytes())
                at = min(limits[words.first[i] + b], texts.bounds[i + 1])
            out.append(b"".join([*pieces, texts.data[at : texts.bounds[i + 1]].tobytes()]).decode())
        hit = np.array([sum(b - a for a, b in mine) for mine in spans], dtype=np.int64)
        return {
            text: pc.replace_with_mask(batch[text], pa.array(hit > 0), pa.array(out, batch[text].type)),
            "_stays": pa.array(hit <= words.counts * max_share),
        }

    return with_text_columns(docs, text, edited, make, keep=columns, also=also).filter("_stays").select(*columns)
