"""Language identification by interpolated Kneser-Ney character models.

Text is lower-cased, and everything but letters only separates words. Each word, with one space before and after it, is
a sequence of its own: a character is predicted from up to four before it, back to the space. All characters of all
training documents are counted, per language. The longest n-grams carry counts, shorter ones the number of different
characters seen before them, each order is discounted by its own ``n1 / (n1 + 2 n2)`` and filled up from the next shorter
one. The models of all languages share one sorted array of hashes per order, with a row of log probabilities, one for
each language, beside it; contexts have an array of the same kind with their back-off weights. Characters are code points,
n-grams are told apart by 64-bit hashes.

No count is cut off, so the models grow with the text. N-grams of three and more characters are dealt to shards by the two
characters before the last: all that a character's probability takes then lies in one shard, and a task fits it alone once
the counts of counts are known. Shorter ones, at most the square of the alphabet, go with every shard. One shard is used in
one pass over the documents. If there are more, each is a pass that writes the bits of its characters, and the bits of all
shards are added up by document.

The language with the lowest cross-entropy per character wins. Two things are calibrated on all labelled documents set
aside for it, which the models have not counted, by sums and counts over them: a logistic curve that turns the lead over the second language into the probability of being right, and
for each language the cross-entropy beyond which a document is rejected as none of the languages.

Defined cases: a null text, or one without letters, is ``und`` with score 0 and rejected; so is everything if there are
no labelled rows. Rows without a language or text do not train. Ties go to the language first in order. A letter that a
language has not seen has one in ``ALPHABET`` of the weight that is left for it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from math import fsum

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from ..session import write_once
from .batches import Texts, mix, slices, tidy, with_text_columns

ORDER = 5
#: N-grams of the longest order times languages in one shard, on average; a shard's arrays have about 8 bytes for each.
SHARD_CELLS = 2_000_000
#: Share of the labelled documents that the cross-entropy limit of a language lets pass, and the slack it gets, in bits.
PASS_SHARE, SLACK = 0.999, 1.0
#: Letters that share the probability left for unseen ones.
ALPHABET = 4096

UNDETERMINED = "und"
_BITS = 21  # of a code point
_SPACE = 0x20
_HELD = 300_000  # n-grams that a task adds up before it hands them on


@cache
def _letters() -> np.ndarray:
    """For each code point the one of its lower-case letter, or 0."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and (char := chr(point)).isalpha():
            out[point] = ord(char.lower()[0])
    return out


@cache
def _factors() -> np.ndarray:
    """An odd number for each place of an n-gram, the last character's first."""
    return mix(np.arange(77, 77 + ORDER, dtype=np.uint64)) | np.uint64(1)


@dataclass
class Characters:
    """Words laid end to end, each with a space before and after it. ``back[k][i]`` is the character ``k`` places before
    place ``i`` in the same word, or 0. ``at`` are the places that are predicted, ``first`` where each text begins in it."""

    back: list[np.ndarray]
    at: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: Texts) -> Characters:
        points = np.frombuffer(texts.data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        bounds = texts.characters_before()[texts.bounds]
        letters = _letters()[points]
        inside = letters > 0
        before = np.zeros(len(inside), dtype=bool)
        before[1:] = inside[:-1]
        cuts = bounds[1:-1]
        before[cuts[cuts < len(inside)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), dtype=bool)
        after[:-1] = ~inside[1:] | (inside[1:] & ~before[1:])
        after[-1:] = True
        ends = np.flatnonzero(inside & after) + 1
        lengths = ends - starts
        sizes = lengths + 2
        first = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        codes = np.full(total, _SPACE, dtype=np.uint64)
        place = np.arange(total) - np.repeat(first, sizes)
        codes[(place > 0) & (place <= np.repeat(lengths, sizes))] = letters[inside]
        back = [codes]
        for k in range(1, ORDER):
            shifted = np.zeros(total, dtype=np.uint64)
            shifted[k:] = codes[:-k] if k < total else 0
            shifted[place < k] = 0
            back.append(shifted)
        per_word = np.concatenate([[0], np.cumsum(sizes - 1)])
        return cls(back, np.flatnonzero(place > 0), per_word[np.searchsorted(starts, bounds)])

    def keys(self) -> list[np.ndarray]:
        """For each order the key of the n-gram that ends at each place."""
        return ngram_keys(self.back)


def ngram_keys(back: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of the n-grams of each order, of the last characters and those ``k`` places before them."""
    keys = [back[0] * _factors()[0]]
    for k in range(1, len(back)):
        keys.append(keys[-1] + back[k] * _factors()[k])
    return keys


def _shard(pair: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a place, by the key of the two characters before it."""
    return mix(pair) % np.uint64(shards)


@dataclass
class Hashes:
    """A sorted hash array with a row of values beside each hash."""

    hashes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Hashes:
        hashes = mix(keys)
        order = np.argsort(hashes)
        return cls(hashes[order], np.ascontiguousarray(values[order], dtype=np.float32))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each key, and whether there is one."""
        wanted = mix(keys)
        row = np.minimum(np.searchsorted(self.hashes, wanted), max(0, len(self.hashes) - 1))
        return row, self.hashes[row] == wanted if len(self.hashes) else np.zeros(len(keys), dtype=bool)


#: By order: n-grams with their log probabilities, and contexts with their log weights.
Tables = dict[int, tuple[Hashes, Hashes]]


@dataclass
class Level:
    """N-grams of one order in any language: their keys, those of their contexts and of what is left without their first
    character, the last two characters, and a column of counts for each language."""

    keys: np.ndarray
    contexts: np.ndarray
    shorter: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    def counts_of_counts(self) -> np.ndarray:
        """N-grams that occur once and twice, by language."""
        return np.stack([(self.counts == 1).sum(axis=0), (self.counts == 2).sum(axis=0)])

    def fit(self, discount: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, tuple[Hashes, Hashes]]:
        """Probabilities of the n-grams, whose ``shorter`` ones have the probabilities ``below``, and the tables."""
        held, of = np.unique(self.contexts, return_inverse=True)
        total, kinds = np.zeros((len(held), self.counts.shape[1])), np.zeros((len(held), self.counts.shape[1]))
        np.add.at(total, of, self.counts)
        np.add.at(kinds, of, self.counts > 0)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        out = np.maximum(self.counts - discount, 0) / np.maximum(total[of], 1) + weight[of] * below
        return out, (Hashes.of(self.keys, np.log2(out)), Hashes.of(held, np.log2(weight)))


def _levels(back: list[np.ndarray], language: np.ndarray, counts: np.ndarray, width: int, down_to: int) -> Iterator[tuple[int, Level]]:
    """From n-grams of the longest order (characters, language and count) down: shorter ones count what stands before them."""
    while len(back) >= down_to:
        n = len(back)
        keys = ngram_keys(back)
        contexts = ngram_keys(back[1:])[-1] if n > 1 else np.zeros(len(language), dtype=np.uint64)
        union, at, row = np.unique(keys[-1], return_index=True, return_inverse=True)
        grid = np.zeros((len(union), width))
        np.add.at(grid, (row, language), counts)
        ends = back[0] | (back[1] << np.uint64(_BITS) if n > 1 else np.uint64(0))
        yield n, Level(union, contexts[at], keys[n - 2][at] if n > 1 else np.zeros(len(union), np.uint64), ends[at], grid)
        row, language = np.nonzero(grid)
        back, counts = [b[at[row]] for b in back[: n - 1]], np.ones(len(row))


def _discount(once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    return np.clip(np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.1, 0.95)


@dataclass
class Models:
    """Kneser-Ney models of several languages, and what the calibration has found.

    ``low`` are the tables of one and two characters, ``high`` those of a shard, of which there are ``shards``; if there are
    several, ``stored`` holds them.
    """

    languages: list[str]
    low: Tables
    high: Tables
    limits: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    shards: int = 1
    stored: DataFrame | None = None

    def each_shard(self) -> Iterator[tuple[int, Tables]]:
        if self.stored is None:
            yield 0, self.high
            return
        for i in range(self.shards):
            for row in self.stored.filter(F.col("shard") == i).select("packed").collect():
                yield i, pickle.loads(row.packed)



def add_bits(texts: Texts, tables: Tables, width: int, shard: int = 0, shards: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each text in each language, over the characters of one shard; and the number of characters of all."""
    characters = Characters.of(texts)
    keys, at, first = characters.keys(), characters.at, characters.first
    letters = np.diff(first)
    bits, text = np.zeros((len(letters), width)), np.repeat(np.arange(len(letters)), letters)
    if shards > 1:
        mine = _shard(keys[1][at - 1], shards) == shard
        at, text = at[mine], text[mine]
    for n in range(ORDER, 0, -1):
        if n not in tables or not len(at):
            continue
        ngrams, contexts = tables[n]
        row, known = ngrams.find(keys[n - 1][at])
        _add(bits, text[known], ngrams.values[row[known]])
        at, text = at[~known], text[~known]
        row, known = contexts.find(keys[n - 2][at - 1] if n > 1 else np.zeros(len(at), dtype=np.uint64))
        _add(bits, text[known], contexts.values[row[known]])
    _add(bits, text, np.full((len(text), width), -np.log2(ALPHABET), dtype=np.float32))
    return -bits, letters


def _add(bits: np.ndarray, text: np.ndarray, values: np.ndarray) -> None:
    """Add rows of values to the rows of their texts, which ascend."""
    if len(text):
        begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        bits[text[begin]] += np.add.reduceat(values, begin, axis=0, dtype=np.float64)


class Judge:
    """What follows from the bits of a text in each language."""

    def __init__(self, models: Models):
        self.languages, self.limits, self.slope, self.offset = models.languages, models.limits, models.slope, models.offset

    def judge(self, bits: np.ndarray, letters: np.ndarray) -> dict[str, np.ndarray]:
        """Number of the best language (-1: no letters), its cross-entropy, the lead and the number of characters."""
        bits = bits / np.maximum(letters, 1)[:, None]
        best = bits.argmin(axis=1) if len(self.languages) else np.zeros(len(bits), dtype=np.int64)
        ordered = np.sort(bits, axis=1)
        lead = ordered[:, 1] - ordered[:, 0] if len(self.languages) > 1 else np.full(len(bits), 1.0)
        least = ordered[:, 0] if len(self.languages) else np.zeros(len(bits))
        return {"best": np.where(letters > 0, best, -1), "bits": least, "lead": lead, "letters": letters}

    def probability(self, lead: np.ndarray, letters: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * _evidence(lead, letters) + self.offset, -30, 30)))

    def limit(self, best: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Cross-entropy up to which a document is accepted; short ones, which scatter more, get more slack."""
        return self.limits[np.maximum(best, 0)] + 4 / np.sqrt(np.maximum(letters, 1))


def _evidence(lead: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """The lead in bits over the document, growing with the square root of its length only: characters depend on another."""
    return lead * np.sqrt(np.maximum(letters, 1))


_COUNTS = StructType([StructField("lang", StringType()), *[StructField(c, LongType()) for c in ("high", "low", "n")]])


def _packed(back: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of an n-gram in two numbers: the first three, the last two."""
    bits = np.uint64(_BITS)
    return back[4] << bits + bits | back[3] << bits | back[2], back[1] << bits | back[0]


def _unpacked(high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    one, mask = np.uint64(_BITS), np.uint64((1 << _BITS) - 1)
    return [low & mask, low >> one, high & mask, high >> one & mask, high >> one + one]


def _counted(rows: DataFrame) -> DataFrame:
    """N-gram counts per language; each task adds up what it has read before it hands it on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}  # by language: key, the two numbers, count
        waiting = 0

        def settle(language: str) -> None:
            key, high, low, n = held[language]
            key, at, row = np.unique(key, return_index=True, return_inverse=True)
            held[language] = [key, high[at], low[at], np.bincount(row, n).astype(np.int64)]

        def sent(language: str) -> pa.RecordBatch:
            _, high, low, n = held.pop(language)
            names = pa.array([language], pa.string()).take(pa.array(np.zeros(len(n), dtype=np.int32)))
            return pa.RecordBatch.from_arrays([names, pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n)], names=_COUNTS.fieldNames())

        for batch in batches:
            for piece in slices(batch, "text"):
                characters = Characters.of(Texts.of(piece["text"]))
                at = characters.at
                back = [b[at] for b in characters.back]
                key, (high, low) = ngram_keys(back)[-1], _packed(back)
                languages = piece["lang"].dictionary_encode()
                text_language = np.repeat(languages.indices.to_numpy(zero_copy_only=False), np.diff(characters.first))
                for number, language in enumerate(languages.dictionary.to_pylist()):
                    mine = np.flatnonzero(text_language == number)
                    found, first, n = np.unique(key[mine], return_index=True, return_counts=True)
                    fresh = [found, high[mine[first]], low[mine[first]], n]
                    held[language] = [np.concatenate(x) for x in zip(held[language], fresh, strict=True)] if language in held else fresh
                    waiting += len(found)
                if waiting > _HELD:
                    for language in list(held):
                        settle(language)
                        if len(held[language][0]) > _HELD:
                            yield sent(language)
                    waiting = 0
        for language in list(held):
            settle(language)
            yield sent(language)

    counted = rows.select("text", "lang").mapInArrow(tidy(run), _COUNTS)
    return counted.groupBy("lang", "high", "low").agg(F.sum("n").alias("n"))


_STATS = StructType([StructField("language", IntegerType()), StructField("kind", IntegerType()), StructField("value", LongType()), StructField("n", LongType())])
_HIGH = 3  # the shortest order that is dealt to shards


def _by_shard(grams: DataFrame, columns: list[str], schema: str, work: Callable[[int, list[np.ndarray]], pa.RecordBatch]) -> DataFrame:
    """What ``work`` makes of the n-grams of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        now = None

        def made() -> pa.RecordBatch:
            return work(now, [np.concatenate(x) for x in zip(*held, strict=True)])

        for batch in batches:
            shard = batch["shard"].to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    if held and shard[a] != now:
                        yield made()
                        held = []
                    now = int(shard[a])
                    held.append([batch[c].to_numpy()[a:b] for c in columns])
        if held:
            yield made()

    dealt = grams.select("shard", *columns).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(tidy(run), schema)


def _with_shard(grams: DataFrame, languages: list[str], shards: int) -> DataFrame:
    schema = "shard int, language int, high long, low long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = _unpacked(*[batch[c].to_numpy().view(np.uint64) for c in ("high", "low")])
            shard = _shard(ngram_keys(back[1:3])[-1], shards).astype(np.int32)
            language = pc.index_in(batch["lang"], pa.array(languages, pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(shard), language, *[batch[c] for c in ("high", "low", "n")]], names=["shard", "language", "high", "low", "n"])

    return grams.mapInArrow(tidy(run), schema)


def fit(rows: DataFrame, shard_cells: int = SHARD_CELLS) -> Models:
    """Models of the languages in ``rows`` (``text``, ``lang``), not yet calibrated."""
    grams = write_once(_counted(rows), "ngrams")
    sizes = grams.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    languages = sorted(r.lang for r in sizes)
    width = len(languages)
    if not width:
        return Models([], {}, {}, np.zeros(0))
    shards = max(1, -(-sum(r.n for r in sizes) * width // shard_cells))
    dealt = write_once(_with_shard(grams, languages, shards), "ngrams-dealt")
    columns = ["language", "high", "low", "n"]

    def levels(found: list[np.ndarray]) -> Iterator[tuple[int, Level]]:
        back = _unpacked(found[1].view(np.uint64), found[2].view(np.uint64))
        return _levels(back, found[0].astype(np.int64), found[3].astype(float), width, _HIGH)

    def counted(shard: int, found: list[np.ndarray]) -> pa.RecordBatch:
        """Counts of counts (kind: ten times the order, and one or two), and the last two characters of the shortest."""
        out: list[list[np.ndarray]] = []
        for n, level in levels(found):
            for i, counts in enumerate(level.counts_of_counts(), 1):
                out.append([np.arange(width), np.full(width, 10 * n + i), np.zeros(width), counts])
        row, language = np.nonzero(level.counts)
        pair, n = np.unique(np.stack([language, level.ends[row].astype(np.int64)]), axis=1, return_counts=True)
        out.append([pair[0], np.zeros(len(n)), pair[1], n])
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)).cast(k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=_STATS.fieldNames())

    stats = _by_shard(dealt, columns, "language int, kind int, value long, n long", counted)
    stats = stats.groupBy("language", "kind", "value").agg(F.sum("n").alias("n")).toArrow()
    language, kind, value, n = (stats[c].to_numpy() for c in ("language", "kind", "value", "n"))
    seen = np.zeros((ORDER + 1, 3, width))
    of_counts = kind > 0
    seen[kind[of_counts] // 10, kind[of_counts] % 10, language[of_counts]] = n[of_counts]

    # The shortest orders, at most the square of the alphabet, are fitted here and go with every shard.
    pairs = value[~of_counts].astype(np.uint64)
    mask = np.uint64((1 << _BITS) - 1)
    low: Tables = {}
    orders = dict(_levels([pairs & mask, pairs >> np.uint64(_BITS)], language[~of_counts].astype(np.int64), n[~of_counts].astype(float), width, 1))
    known, p = np.zeros(1, dtype=np.uint64), np.full((1, width), 1.0 / ALPHABET)
    for order in range(1, _HIGH):
        level = orders[order]
        p, low[order] = level.fit(_discount(*level.counts_of_counts()), p[np.searchsorted(known, level.shorter)])
        known = level.keys
    discounts = {order: _discount(seen[order, 1], seen[order, 2]) for order in range(_HIGH, ORDER + 1)}

    def fitted(shard: int, found: list[np.ndarray]) -> pa.RecordBatch:
        below, probabilities, out = known, p, {}
        for order, level in sorted(levels(found), key=lambda x: x[0]):
            probabilities, out[order] = level.fit(discounts[order], probabilities[np.searchsorted(below, level.shorter)])
            below = level.keys
        packed = pickle.dumps(out, protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([packed], pa.binary())], names=["shard", "packed"])

    stored = write_once(_by_shard(dealt, columns, "shard int, packed binary", fitted), "language-models")
    models = Models(languages, low, {}, np.full(width, np.inf), shards=shards, stored=stored)
    if shards == 1:
        models.high, models.stored = next(models.each_shard())[1], None
    return models


def train(docs: DataFrame, counted: Column, calibrating: Column, text: str = "text", lang: str = "lang", shard_cells: int = SHARD_CELLS) -> Models:
    """Models from the labelled rows for which ``counted`` holds, calibrated on those for which ``calibrating`` does."""
    columns = [F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")]
    labelled = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    models = fit(labelled.filter(counted).select(*columns), shard_cells)
    if not models.languages:
        return models
    judged = _judged(labelled.filter(calibrating).select(*columns), models, "text", ["lang"])
    return _calibrate(models, write_once(judged, "calibration"))


def _calibrate(models: Models, judged: DataFrame) -> Models:
    letters = F.sqrt(F.greatest("_letters", F.lit(1)))  # as in _evidence and Judge.limit
    named = F.array(*map(F.lit, models.languages))[F.col("_best").cast("int")]
    cases = judged.filter("_best >= 0").select(
        "_best", (named == F.col("lang")).alias("right"), (F.col("_lead") * letters).alias("x"), (F.col("_bits") - 4 / letters).alias("excess")
    )
    if cases.isEmpty():
        return models
    models.slope, models.offset = _logistic(cases)
    for row in _quantiles(cases.filter("right"), "_best", "excess", PASS_SHARE).collect():  # a row for each language
        models.limits[row["_best"]] = row.value + SLACK
    return models


def _quantiles(rows: DataFrame, key: str, value: str, share: float) -> DataFrame:
    """``key, value``: the exact quantile of each key, interpolated between two neighbours. Counts of narrow bins say which
    bins hold the two, and only the values of these are put in order."""
    binned = rows.select(key, F.col(value).alias("_v"), F.floor(F.col(value) * 1024).alias("_bin"))
    to_bin = Window.partitionBy(key).orderBy("_bin")
    bins = binned.groupBy(key, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    bins = bins.withColumns({"_upto": F.sum("_n").over(to_bin), "_all": F.sum("_n").over(Window.partitionBy(key))})
    bins = bins.withColumn("_at", (F.col("_all") - 1) * F.lit(share)).withColumn("_low", F.floor("_at"))
    bins = bins.withColumn("_high", F.least(F.col("_low") + 1, F.col("_all") - 1)).withColumn("_before", F.col("_upto") - F.col("_n"))
    hit = bins.filter("_before <= _high AND _upto > _low").select(key, "_bin", "_before", "_at", "_low", "_high")
    found = binned.join(F.broadcast(hit), [key, "_bin"])  # two bins of a key at most
    found = found.groupBy(key, "_bin", "_before", "_at", "_low", "_high", "_v").agg(F.count(F.lit(1)).alias("_n"))
    found = found.withColumn("_upto", F.col("_before") + F.sum("_n").over(Window.partitionBy(key, "_bin").orderBy("_v")))
    low, high = (F.max(F.when((F.col("_upto") - F.col("_n") <= F.col(c)) & (F.col("_upto") > F.col(c)), F.col("_v"))) for c in ("_low", "_high"))
    ends = found.groupBy(key).agg(low.alias("_a"), high.alias("_b"), F.max(F.col("_at") - F.col("_low")).alias("_part"))
    return ends.select(key, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("value"))


def _logistic(cases: DataFrame) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps, each from five sums over ``x`` and ``right``; a right and a wrong
    case at lead 0 keep both finite."""
    slope, offset = 0.0, 0.0
    for _ in range(30):
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.col("x") * slope + offset, F.lit(30.0)), F.lit(-30.0))))
        rest, weight = F.col("right").cast("int") - p, p * (1 - p)
        terms = [F.col("x") * rest, rest, F.col("x") * F.col("x") * weight, F.col("x") * weight, weight]
        # A row for each task; added here, as the order in which tasks end would change the last digits.
        parts = cases.groupBy(F.spark_partition_id()).agg(*[F.sum(t).alias(f"_{i}") for i, t in enumerate(terms)]).collect()
        xr, r, xxw, xw, w = (fsum(part[f"_{i}"] for part in parts) for i in range(len(terms)))
        at_zero = 1 / (1 + np.exp(-np.clip(offset, -30, 30)))
        r, w = r + 1 - 2 * at_zero, w + 2 * at_zero * (1 - at_zero)
        spread = np.array([[xxw + 1e-6, xw], [xw, w + 1e-6]])
        step = np.clip(np.linalg.solve(spread, np.array([xr - 1e-6 * slope, r - 1e-6 * offset])), -5, 5)
        slope, offset = slope + float(step[0]), offset + float(step[1])
        if np.abs(step).max() < 1e-12:
            break
    return max(slope, 0.0), offset


_JUDGED = StructType(
    [StructField("_best", LongType()), StructField("_bits", DoubleType()), StructField("_lead", DoubleType()), StructField("_letters", LongType())]
)


def _bits(docs: DataFrame, models: Models, text: str) -> tuple[DataFrame, list[str], Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]]:
    """``docs``, what else of it to read, and a function that gives the bits and the number of letters of a batch."""
    width = len(models.languages)
    if models.stored is None:
        tables = models.low | models.high
        return docs, [], lambda batch: add_bits(Texts.of(batch[text]), tables, width)
    docs = write_once(docs.withColumn("_bits_row", F.monotonically_increasing_id()), "to-judge")
    parts = None
    for shard, high in models.each_shard():
        part = write_once(_shard_bits(docs, text, models.low | high, width, shard, models.shards), "shard-bits")
        parts = part if parts is None else parts.unionByName(part)
    totals = [F.sum(F.col("_bits")[i]).alias(f"_{i}") for i in range(width)]
    added = parts.groupBy("_bits_row").agg(F.max("_letters").alias("_letters"), *totals)
    added = added.select("_bits_row", "_letters", F.array(*[f"_{i}" for i in range(width)]).alias("_bits"))
    docs = docs.join(added, "_bits_row", "left")

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        none = [0.0] * width
        letters = pc.fill_null(batch["_letters"], 0).to_numpy(zero_copy_only=False)
        return np.array([x or none for x in batch["_bits"].to_pylist()], dtype=float).reshape(-1, width), letters

    return docs, ["_bits", "_letters"], read


def _shard_bits(docs: DataFrame, text: str, tables: Tables, width: int, shard: int, shards: int) -> DataFrame:
    """The bits of one shard's characters, for rows that have some."""
    schema = StructType([StructField("_bits_row", LongType()), StructField("_bits", ArrayType(DoubleType())), StructField("_letters", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                bits, letters = add_bits(Texts.of(piece[text]), tables, width, shard, shards)
                some = np.flatnonzero(bits.any(axis=1))
                values = pa.array(bits[some].ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * width), values)
                yield pa.RecordBatch.from_arrays([piece["_bits_row"].take(pa.array(some)), lists, pa.array(letters[some])], names=schema.fieldNames())

    return docs.select("_bits_row", text).mapInArrow(tidy(run), schema)


def _judged(rows: DataFrame, models: Models, text: str, keep: list[str]) -> DataFrame:
    rows, also, bits = _bits(rows, models, text)
    judge = Judge(models)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {f"_{name}": pa.array(values) for name, values in judge.judge(*bits(batch)).items()}

    return with_text_columns(rows, text, _JUDGED, make, keep, also)


_LANGUAGE = StructType(
    [
        StructField("lang_pred", StringType()),
        StructField("score", DoubleType()),
        StructField("cross_entropy", DoubleType()),
        StructField("accepted", BooleanType()),
    ]
)


def _columns(judge: Judge, bits: np.ndarray, letters: np.ndarray) -> dict[str, pa.Array]:
    found = judge.judge(bits, letters)
    best = found["best"]
    named = (best >= 0) & bool(judge.languages)
    accepted = named.copy()
    if judge.languages:
        accepted &= found["bits"] <= judge.limit(best, letters)
    names = pa.array([*judge.languages, UNDETERMINED], pa.string())
    return {
        "lang_pred": names.take(pa.array(np.where(named, best, len(judge.languages)))),
        "score": pa.array(np.where(named, judge.probability(found["lead"], letters), 0.0), pa.float64()),
        "cross_entropy": pa.array(np.where(named, found["bits"], np.nan), pa.float64(), from_pandas=True),
        "accepted": pa.array(accepted),
    }


def identify(docs: DataFrame, models: Models, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score`` (probability of being right), ``cross_entropy`` (bits per character), ``accepted``."""
    names, judge = docs.columns if keep is None else keep, Judge(models)
    docs, also, bits = _bits(docs, models, text)
    return with_text_columns(docs, text, _LANGUAGE, lambda batch: _columns(judge, *bits(batch)), names, also)


def keep_languages(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """``docs`` without the rejected rows."""

    columns, judge = docs.columns, Judge(models)
    docs, also, bits = _bits(docs, models, text)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"_accepted": _columns(judge, *bits(batch))["accepted"]}

    judged = with_text_columns(docs, text, StructType([StructField("_accepted", BooleanType())]), make, columns, also)
    return judged.filter("_accepted").select(*columns)
