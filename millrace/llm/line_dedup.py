"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that hold a word; a line is known by the hash of its words. The run of lines from
each line on that first reaches ``GRAM_WORDS`` words is a gram. Windows are the runs of lines that first reach
``WINDOW_WORDS`` words; each selects the smallest hash of the grams inside it, the first of equal ones. What a window
selects depends on its lines alone, so a run of at least ``WINDOW_WORDS`` words that two documents share yields the same
fingerprint in both; runs of fewer than ``GRAM_WORDS`` words yield none. Every place of a fingerprint is joined with the
first one in the corpus only, never with each other. From there the match is extended line by line to both sides, and all
its lines are deleted from the later document.

Passages need not be whole lines, and the first place of a fingerprint need not hold the whole run. So every word that lies
in a run of ``PASSAGE_WORDS`` words which stands in an earlier place too, in whatever lines, is deleted for certain, and
with it a line that loses its last word. For this all runs of that many words are winnowed over hashes of ``GRAM_WORDS``
words. Neighbouring runs that select the same gram make a span; a span with an earlier copy goes at once. The first places
of all spans hold the first place of every run. Where several spans share a gram, they are cut into zones by the place of
the gram in their runs, and zones are treated like spans, by the words that all runs of a zone hold. Only where several
zones share these are runs compared one by one, by their hash, each with its own first place.

Each deleted word still stands in an earlier place. The order of documents is that of their ids, null last, and of a hash
of the text.

Defined cases: null texts and texts without words stay as they are; lines without words are never deleted; a document
that loses its last word goes; repeated rows (same id and text) are one document and share its fate; an empty table gives
an empty result; columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from ..session import write_once
from .batches import SPACED, Texts, Words, mix, powers, tidy, with_text_columns

GRAM_WORDS = 25
WINDOW_WORDS = 50
#: Repeated runs of so many words go for certain, wherever in their lines they begin and end.
PASSAGE_WORDS = 50
#: Runs of a span whose gram begins at about the same place, so many words apart at most, make a zone.
ZONE_WORDS = 7
#: Documents that lose lines are broadcast up to this many, with up to so many ranges in all, and joined by shuffle beyond.
BROADCAST_ROWS, BROADCAST_RANGES = 200_000, 1_000_000

#: A bit map of keys has so many places, 16 MB.
KEY_BITS = 27

_NEWLINE = 0x0A


class Sums:
    """Running sums over the words of a slice, from which the hash of any row of them follows."""

    def __init__(self, words: Words):
        hashes = words.hashes()
        up, self.down = powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=self.sums[1:])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])


class Lines:
    """The lines with words of the texts of a slice; those of text ``i`` are ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, texts: Texts):
        words = Words.of(texts, SPACED)
        newline = np.cumsum(texts.data == _NEWLINE) if len(texts.data) else np.zeros(0, np.int64)
        of = newline[words.starts] if len(words.starts) else np.zeros(0, np.int64)
        text_of = words.text_of
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (text_of[1:] != text_of[:-1])
        begin = np.flatnonzero(new)
        self.words = np.diff(np.append(begin, len(of)))
        self.first = np.searchsorted(begin, words.first)
        self.text_of = text_of[begin]
        self.starts = words.starts[begin]
        self.begin = begin
        self.of_words = words

    @cached_property
    def sums(self) -> Sums:
        return Sums(self.of_words)

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.sums.hashes(self.begin, self.begin + self.words)

    def fingerprints(self, gram_words: int, window_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Lines at which a selected gram begins, and the hashes of these grams."""
        n = len(self.words)
        before = np.concatenate([[0], np.cumsum(self.words)])
        limit = self.first[1:][self.text_of]

        def reach(wanted: int) -> np.ndarray:
            """Line after the run from each line on that first has that many words; beyond the text: none."""
            end = np.searchsorted(before, before[:-1] + wanted)
            return np.where(end <= limit, end, n + 1)

        gram, window = reach(gram_words), reach(window_words)
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hashes * up[:n], out=sums[1:])
        whole = np.flatnonzero(gram <= n)
        hashes = np.zeros(n, dtype=np.uint64)
        hashes[whole] = mix((sums[gram[whole]] - sums[whole]) * down[whole])
        line = np.flatnonzero(window <= n)
        best = line.copy()
        step, active = 1, np.arange(len(line))
        while True:
            at = line[active] + step
            inside = at < n
            inside[inside] = gram[at[inside]] <= window[line[active[inside]]]
            active, at = active[inside], at[inside]
            if not len(active):
                break
            better = hashes[at] < hashes[best[active]]
            best[active[better]] = at[better]
            step += 1
        chosen = np.unique(best)
        return chosen, hashes[chosen]


def line_counts(texts: Texts) -> np.ndarray:
    """Number of lines with words of each text."""
    data = texts.data
    begin = np.union1d(texts.bounds[:-1], np.flatnonzero(data == _NEWLINE) + 1)
    begin = begin[begin < len(data)]
    if not len(begin):
        return np.zeros(len(texts), dtype=np.int64)
    begin = begin[np.logical_or.reduceat(SPACED[data], begin)]
    return np.diff(np.searchsorted(begin, texts.bounds))


_LINES = StructType(
    [
        StructField("lines", ArrayType(LongType())),
        StructField("places", ArrayType(IntegerType())),
        StructField("prints", ArrayType(LongType())),
    ]
)
_SPANS = StructType([StructField(c, ArrayType(t)) for c, t in (("gram", LongType()), ("hash", LongType()), ("from", IntegerType()), ("to", IntegerType()))])


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _line_marks(lines: Lines, gram_words: int, window_words: int) -> dict[str, pa.Array]:
    chosen, hashes = lines.fingerprints(gram_words, window_words)
    bounds = np.searchsorted(chosen, lines.first)
    places = chosen - lines.first[lines.text_of[chosen]] if len(chosen) else chosen
    return {
        "lines": _lists(lines.hashes.view(np.int64), lines.first, pa.int64()),
        "places": _lists(places, bounds, pa.int32()),
        "prints": _lists(hashes.view(np.int64), bounds, pa.int64()),
    }


def _span_marks(runs: Runs) -> dict[str, pa.Array]:
    low, last, place = runs.spans()
    words, size = runs.words, runs.size
    bounds = np.searchsorted(low, words.first)
    base = words.first[words.text_of[low]] if len(low) else low
    return {
        "gram": _lists(runs.grams(place).view(np.int64), bounds, pa.int64()),
        "hash": _lists(runs.sums.hashes(low, last + size).view(np.int64), bounds, pa.int64()),
        "from": _lists(low - base, bounds, pa.int32()),
        "to": _lists(last + size - base, bounds, pa.int32()),
    }


def marks(docs: DataFrame, text: str, doc_id: str, gram_words: int, window_words: int, passage_words: int | None) -> DataFrame:
    """Each ``doc`` (id and text hash) with its lines and their fingerprints, and, with ``passage_words``, its spans.

    Both come from one pass over the texts, which share the hashes of their words.
    """

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        lines = Lines(Texts.of(batch["text"]))
        found = _line_marks(lines, gram_words, window_words)
        if passage_words is not None:
            found |= _span_marks(Runs(lines.of_words, lines.sums, passage_words, GRAM_WORDS))
        return found

    added = _LINES if passage_words is None else StructType([*_LINES, *_SPANS])
    return write_once(with_text_columns(_texts(docs, text, doc_id), "text", added, make, ["doc"]), "marks")


_RUNS = StructType([StructField(c, ArrayType(IntegerType())) for c in ("run_from", "run_to")])


def _extend(lines: np.ndarray, source: np.ndarray, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of ``lines`` that equal runs of ``source``, each as long as it can be, through the given pairs of places."""
    runs: dict[int, list[tuple[int, int]]] = {}
    for at, there in sorted(pairs):
        shift = at - there
        known = runs.setdefault(shift, [])
        if known and known[-1][1] > at:
            continue
        # On the diagonal both sequences are laid over one another; the run ends where they first differ.
        low, high = max(0, shift), min(len(lines), len(source) + shift)
        different = np.flatnonzero(lines[low:high] != source[low - shift : high - shift]) + low
        split = int(np.searchsorted(different, at))
        known.append((int(different[split - 1]) + 1 if split else low, int(different[split]) if split < len(different) else high))
    return [run for found in runs.values() for run in found]


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _matched(pairs: DataFrame) -> DataFrame:
    """Rows with the lines of a document and of a source, and pairs of places: the runs of the document to delete."""
    kept = ["doc"]
    schema = StructType([pairs.schema["doc"], *_RUNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                lines, source = (batch[c][i].values.to_numpy() for c in ("lines", "source_lines"))
                pairs = batch["pairs"][i].values
                found.append(_merge(_extend(lines, source, list(zip(*(pairs.field(c).to_pylist() for c in ("at", "there")), strict=True)))))
            runs = [pa.array([[r[side] for r in rows] for rows in found], pa.list_(pa.int32())) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["doc"], *runs], names=[*kept, *_RUNS.fieldNames()])

    return pairs.select("doc", "lines", "source_lines", "pairs").mapInArrow(tidy(run), schema)


class Runs:
    """All runs of ``size`` words inside the texts of a slice, by the number of the word they begin with."""

    def __init__(self, words: Words, sums: Sums, size: int, gram_words: int):
        self.words, self.sums, self.size = words, sums, size
        begin = np.arange(len(words.starts))
        self.begin = begin[begin + size <= words.first[1:][words.text_of]]
        self.gram_words = min(gram_words, size)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last run of each row of neighbours that select the same gram, and the place of that gram."""
        if not len(self.begin):
            return self.begin, self.begin, self.begin
        place = np.arange(len(self.words.starts) + 1 - self.gram_words)
        grams = self.grams(place)
        # The smallest of the next 1, 2, 4, ... grams, the first of equal ones; then two such stretches cover a run.
        wanted, best, length = self.size - self.gram_words + 1, place, 1
        while 2 * length <= wanted:
            best = self._smaller(grams, best[: len(best) - length], best[length:])
            length *= 2
        chosen = self._smaller(grams, best[self.begin], best[self.begin + wanted - length])
        new = np.ones(len(chosen), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (np.diff(self.begin) > 1)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(chosen)) - 1
        return self.begin[at], self.begin[last], chosen[at]

    def grams(self, place: np.ndarray) -> np.ndarray:
        return self.sums.hashes(place, place + self.gram_words)

    def zones(self, low: np.ndarray, last: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All runs of these spans, at which of them a zone begins, and the hash of the words that all runs of a zone hold.

        A zone are the runs of a span in which the gram begins some multiple of ``ZONE_WORDS`` words after the first, or
        less than one such step later. So equal runs lie in zones that hold the same words.
        """
        ends = np.concatenate([[0], np.cumsum(last - low + 1)])
        span = np.repeat(np.arange(len(low)), last - low + 1)
        begin = np.arange(ends[-1]) - (ends[:-1] - low)[span]
        zone = (place[span] - begin) // ZONE_WORDS
        new = np.ones(len(begin), dtype=bool)
        new[1:] = (span[1:] != span[:-1]) | (zone[1:] != zone[:-1])
        at = np.flatnonzero(new)
        place, before = place[span[at]], zone[at] * ZONE_WORDS
        after = np.minimum(before + ZONE_WORDS - 1, self.size - self.gram_words)
        return begin, at, self.sums.hashes(place - before, place - after + self.size)

    @staticmethod
    def _smaller(grams: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(grams[right] < grams[left], right, left)


_ZONES = StructType(
    [
        StructField("core", ArrayType(LongType())),
        StructField("hash", ArrayType(LongType())),
        StructField("from", ArrayType(IntegerType())),
        StructField("to", ArrayType(IntegerType())),
        StructField("runs", ArrayType(ArrayType(LongType()))),
    ]
)


def _zones(texts: DataFrame, size: int) -> DataFrame:
    """The zones of the spans that begin at the words ``spans`` of each text, and the hashes of all their runs."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = Words.of(Texts.of(batch["text"]), SPACED)
        runs = Runs(words, Sums(words), size, GRAM_WORDS)
        wanted = np.repeat(words.first[:-1], pc.list_value_length(batch["spans"]).to_numpy(zero_copy_only=False)) + batch["spans"].flatten().to_numpy()
        found = runs.spans()
        asked = np.isin(found[0], wanted)
        begin, at, cores = runs.zones(*(x[asked] for x in found))
        low, ends = begin[at], np.append(at[1:], len(begin))[: len(at)]
        high = begin[ends - 1] + size
        bounds = np.searchsorted(low, words.first)
        base = words.first[words.text_of[low]] if len(low) else low
        each = _lists(runs.sums.hashes(begin, begin + size).view(np.int64), np.append(at, len(begin)), pa.int64())
        return {
            "core": _lists(cores.view(np.int64), bounds, pa.int64()),
            "hash": _lists(runs.sums.hashes(low, high).view(np.int64), bounds, pa.int64()),
            "from": _lists(low - base, bounds, pa.int32()),
            "to": _lists(high - base, bounds, pa.int32()),
            "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), each),
        }

    return with_text_columns(texts, "text", _ZONES, make, ["doc"], also=["spans"])


_WORD_RUNS = ArrayType(StructType([StructField("from", IntegerType()), StructField("to", IntegerType())]))
_LOST = StructType([StructField("words", _WORD_RUNS)])


def _with_first(spans: DataFrame, by: list[str], label: str) -> DataFrame:
    """``by``, where the first of like spans stands (``first``), and how many there are (``n``)."""
    return write_once(spans.groupBy(*by).agg(F.min(F.struct("doc", "from")).alias("first"), F.count("*").alias("n")), label)


def repeated_words(marked: DataFrame, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``doc`` of each document that has a run of words with an earlier copy, and ``words``: such runs, from and to."""
    here = F.struct("doc", "from")
    run = F.shiftleft(F.col("from").cast("long"), 32).bitwiseOR(F.col("to").cast("long")).alias("run")
    # Most grams stand in one span only, whose runs stand nowhere else.
    shared = marked.select(F.explode("gram").alias("gram")).groupBy("gram").count().filter("count > 1").select("gram")
    # Written, so that a join with it can split the rows of a frequent gram.
    shared = write_once(shared, "shared-grams")
    spans = marked.select("doc", F.explode(F.arrays_zip("gram", "hash", "from", "to")).alias("s")).select("doc", "s.*")
    spans = write_once(spans.join(shared, "gram", "left_semi"), "shared-spans")
    firsts = _with_first(spans, ["gram", "hash"], "first-spans")
    copies = spans.join(firsts.filter("n > 1").drop("n"), ["gram", "hash"]).filter(here != F.col("first")).select("doc", run)

    several = write_once(firsts.groupBy("gram").count().filter("count > 1").select("gram"), "doubtful-grams")
    doubtful = firsts.join(several, "gram").select("first.*").groupBy("doc").agg(F.collect_list("from").alias("spans"))
    doubtful = write_once(doubtful, "doubtful-spans")
    texts = likely(_texts(docs, text, doc_id), doubtful, "doc").join(doubtful, "doc")
    zones = write_once(_zones(texts, passage_words), "zones")
    # Of these spans likewise most zones hold words of their own, or are equal; the runs of the others are compared.
    cores = zones.select(F.explode(F.arrays_zip("core", "hash")).alias("z")).select("z.*")
    cores = cores.groupBy("core").agg((F.min("hash") != F.max("hash")).alias("several"), F.count("*").alias("n")).filter("n > 1").drop("n")
    cores = write_once(cores, "shared-cores")
    zones = zones.select("doc", F.explode(F.arrays_zip("core", "hash", "from", "to", "runs")).alias("z")).select("doc", "z.*").join(cores, "core")
    zones = write_once(zones.withColumn("runs", F.when(F.col("several"), F.col("runs"))), "shared-zones")
    firsts = _with_first(zones, ["core", "hash"], "first-zones")
    placed = write_once(zones.join(firsts.select("core", "hash", "first"), ["core", "hash"]).drop("core", "hash"), "placed-zones")
    parts = placed.filter(here != F.col("first")).select("doc", run)
    single = placed.filter(F.col("several") & (here == F.col("first"))).select("doc", "from", F.posexplode("runs").alias("k", "hash"))
    single = single.select("doc", (F.col("from") + F.col("k")).alias("from"), "hash")
    earliest = single.groupBy("hash").agg(F.min(here).alias("first"), F.count("*").alias("n")).filter("n > 1").select("hash", "first")
    earliest = write_once(earliest, "first-runs")
    later = single.join(earliest, "hash").filter(here != F.col("first"))
    later = later.withColumn("to", F.col("from") + passage_words).select("doc", run)
    return _joined_up(copies.unionByName(parts).unionByName(later).groupBy("doc").agg(F.collect_set("run").alias("words")))


def _joined_up(found: DataFrame) -> DataFrame:
    """Each ``doc`` with its ``words``, in which ranges that overlap or touch are one; each comes as one number."""
    schema = StructType([found.schema["doc"], *_LOST])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["words"]
            sizes, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
            base = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << 32
            low, high = (flat >> 32) + base, (flat & 0xFFFFFFFF) + base
            order = np.argsort(low)
            low, high = low[order], np.maximum.accumulate(high[order])
            new = np.ones(len(low), dtype=bool)
            new[1:] = low[1:] > high[:-1]
            at = np.flatnonzero(new)
            ends = high[np.append(at[1:], len(high)) - 1] if len(at) else high
            bounds = np.searchsorted(low[at], np.arange(len(sizes) + 1, dtype=np.int64) << 32)
            parts = [pa.array((x & 0xFFFFFFFF).astype(np.int32)) for x in (low[at], ends)]
            ranges = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(parts, names=["from", "to"]))
            yield pa.RecordBatch.from_arrays([batch["doc"], ranges], names=["doc", "words"])

    return found.select("doc", "words").mapInArrow(tidy(run), schema)


def _order(doc_id: str, text: str) -> Column:
    """What a document is known by, and sorted by."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"))


def likely(rows: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among those of ``few``: all that are and, unless these are very many, few others.

    Keys set bits of a map of ``2**KEY_BITS`` at most, whatever their number, so it can be broadcast where ``few`` cannot.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(1 << KEY_BITS))
    part, at = F.shiftright(bit, 15), bit.bitwiseAND(F.lit((1 << 15) - 1))
    maps = few.groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1
    return rows.join(F.broadcast(maps), (part == F.col("_part")) & there, "left_semi")


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(_order(doc_id, text).alias("doc"), F.col(text).alias("text"))


def repeated_runs(marked: DataFrame) -> DataFrame:
    """``doc`` (id and text hash) of each document that loses lines, and ``runs`` of its lines with words, from and to."""
    places = marked.select("doc", F.explode(F.arrays_zip("prints", "places")).alias("p"))
    places = places.select("doc", F.col("p.prints").alias("print"), F.col("p.places").alias("place"))
    here = F.struct("doc", "place")
    first = places.groupBy("print").agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("first <> last")
    repeated = places.join(first.select("print", "first"), "print").filter(here != F.col("first"))
    pair = F.struct(F.col("place").alias("at"), F.col("first.place").alias("there"))
    pairs = repeated.groupBy("doc", F.col("first.doc").alias("source")).agg(F.collect_set(pair).alias("pairs"))

    once = marked.select("doc", "lines").groupBy("doc").agg(F.first("lines").alias("lines"))
    both = pairs.join(once.select(F.col("doc").alias("source"), F.col("lines").alias("source_lines")), "source").join(once, "doc")
    runs = _matched(both).select("doc", F.explode(F.arrays_zip("run_from", "run_to")).alias("run"))
    return runs.groupBy("doc").agg(F.collect_set("run").alias("runs"))


def _covered(lists: pa.Array, low: str, high: str, first: np.ndarray) -> np.ndarray:
    """Which places lie in the ranges of a list of each text; those of text ``i`` begin at ``first[i]``."""
    flat = lists.flatten()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    base = np.repeat(first[:-1], sizes)
    return _inside(flat.field(low).to_numpy() + base, flat.field(high).to_numpy() + base, int(first[-1]))


def _inside(low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
    steps = np.bincount(low, minlength=size + 1) - np.bincount(high, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def _left(lines: Lines, dead_lines: np.ndarray, dead_words: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """What is left of each text without these lines and words, and how many lines of it went whole."""
    words, texts = lines.of_words, lines.of_words.texts
    size = len(texts.data)
    whole = dead_lines | (np.add.reduceat(dead_words, lines.begin, dtype=np.int64) == lines.words)
    # A line ends behind its line break, or with its text.
    ends = np.union1d(texts.bounds, np.flatnonzero(texts.data == _NEWLINE) + 1)
    after = np.searchsorted(ends, lines.starts, "right")
    low, high = ends[after[whole] - 1], ends[after[whole]]
    # Cut out the dead words of lines that keep others, with the space after them, or before them at the end of a line.
    line_of = np.repeat(np.arange(len(whole)), lines.words)
    part = dead_words & ~whole[line_of]
    same = line_of[1:] == line_of[:-1]
    new = part.copy()
    new[1:] &= ~(part[:-1] & same)
    last = part.copy()
    last[:-1] &= ~(part[1:] & same)
    x, y = np.flatnonzero(new), np.flatnonzero(last)
    inner = np.append(same, False)[y]
    cut_low = np.where(inner, words.starts[x], words.ends[x - 1])
    cut_high = np.where(inner, words.starts[(y + 1) % len(line_of)], words.ends[y])
    keep = ~_inside(np.append(low, cut_low), np.append(high, cut_high), size)
    # Nor does a text end with the line break before a last line that went.
    gone_to = np.zeros(size + 1, dtype=bool)
    gone_to[high] = True
    cut_off = gone_to[texts.bounds[1:]] & (np.diff(texts.bounds) > 0)
    cut_off[cut_off] = texts.data[texts.bounds[1:][cut_off] - 1] != _NEWLINE
    before = np.concatenate([[0], np.cumsum(keep)])
    kept = np.flatnonzero(keep)
    cut_off &= before[texts.bounds[1:]] > before[texts.bounds[:-1]]
    keep[kept[before[texts.bounds[1:][cut_off]] - 1]] = False
    bounds = np.concatenate([[0], np.cumsum(keep)])[texts.bounds]
    left = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(texts.data[keep]))
    return left, np.diff(np.concatenate([[0], np.cumsum(whole)])[lines.first])


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    gram_words: int = GRAM_WORDS,
    window_words: int = WINDOW_WORDS,
    counts: bool = False,
    passage_words: int | None = None,
) -> DataFrame:
    """``docs`` without the later places of repeated runs, and without documents that have lost all their words.

    Without ``passage_words`` only whole lines go, those that the fingerprints find; ``PASSAGE_WORDS`` does the whole job.

    With ``counts`` every document stays, a text without words left becomes null, and ``n_lines`` (lines with words) and
    ``n_deleted`` are added.
    """
    marked = marks(docs, text, doc_id, gram_words, window_words, passage_words)
    runs = write_once(repeated_runs(marked), "line-runs")
    if passage_words is None:
        runs = runs.withColumn("words", F.lit(None).cast(_WORD_RUNS))
    else:
        words = repeated_words(marked, docs, text, doc_id, passage_words)
        runs = write_once(runs.join(words, "doc", "full"), "all-runs")
    lost = runs.select(F.col("doc").alias("_doc"), F.col("runs").alias("_runs"), F.col("words").alias("_words"))
    ranges = sum(F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) for c in ("_runs", "_words"))
    rows, total = lost.agg(F.count("*"), F.coalesce(F.sum(ranges), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and total <= BROADCAST_RANGES:
        lost = F.broadcast(lost)
    joined = docs.join(lost, _order(doc_id, text).eqNullSafe(F.col("_doc")), "left")
    added = StructType([StructField(text, StringType()), StructField("_n", LongType()), StructField("_gone", LongType()), StructField("_stays", BooleanType())])

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        n = line_counts(Texts.of(batch[text]))
        gone = np.zeros(len(n), dtype=np.int64)
        hit = pc.or_(pc.is_valid(batch["_runs"]), pc.is_valid(batch["_words"])).to_numpy(zero_copy_only=False)
        new = batch[text]
        if hit.any():
            # Words are told apart in the texts that lose some only.
            some = batch.filter(pa.array(hit))
            lines = Lines(Texts.of(some[text]))
            dead = _covered(some["_runs"], "run_from", "run_to", lines.first), _covered(some["_words"], "from", "to", lines.of_words.first)
            left, gone[hit] = _left(lines, *dead)
            if counts:
                left = pc.if_else(pa.array((gone == n)[hit]), pa.scalar(None, left.type), left)
            new = pc.replace_with_mask(new, pa.array(hit), left.cast(new.type))
        empty = (n > 0) & (gone == n)
        return {text: new, "_n": pa.array(n, pa.int64()), "_gone": pa.array(gone), "_stays": pa.array(~empty)}

    out = with_text_columns(joined, text, added, make, keep=docs.columns, also=["_runs", "_words"])
    if counts:
        kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_deleted")]
        return out.select(*kept, F.col("_n").alias("n_lines"), F.col("_gone").alias("n_deleted"))
    return out.filter("_stays").select(*docs.columns)
