"""Quality classifier: ridge regression on random Fourier features of document statistics, with isotonic calibration.

Each text becomes a vector of statistics (``STATISTICS``), standardised over the training rows and cut off at
``CLIP`` deviations. ``FEATURES`` cosines with random frequencies approximate a Gaussian kernel on these vectors. Each task
adds up its share of the normal equations, blocks of these sums are added in tasks again, and only the final system, whose
size is fixed, is solved on the driver. Both classes weigh the same. Training rows set apart by a hash calibrate: their
scores, counted in ``BINS`` bins, give an isotonic curve from score to probability.

All labelled training rows take part; there is no sample.

Defined cases: a null or empty text has all statistics 0 and is scored like any other; labels that are null or neither 0
nor 1, and labels of unknown documents, do not train; if a class is missing every score is the share of class 1, or 0.5
without any label; repeated rows are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from ..session import write_once
from .batches import SPACED, Texts, Words, tidy, with_text_columns, without
from .text_stats import SYMBOLS, duplicate_lines, repeat_words, sums

FEATURES = 256
#: Width of the kernel in standardised units.
WIDTH = 4.0
RIDGE = 1.0
CLIP = 6.0
BINS = 2_000
CALIBRATION_SHARE = 4
SEED = 31

STATISTICS = (
    "log_words",
    "log_lines",
    "word_length",
    "word_length_deviation",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "exclamation_share",
    "other_mark_share",
    "space_share",
    "wide_share",
    "lone_mark_words",
    "short_words",
    "long_words",
    "distinct_words",
    "repeated_pairs",
    "same_neighbours",
    "duplicate_lines",
    "repeat_words",
    "words_per_line",
    "byte_entropy",
)

_UPPER, _DIGIT = (np.isin(np.arange(256), list(b)) for b in (bytes(range(65, 91)), bytes(range(48, 58))))
_STOP, _EXCLAMATION = (np.isin(np.arange(256), list(b)) for b in (b".", b"!"))
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])
_MARK = SPACED & ~_LETTER & ~_DIGIT & ~SYMBOLS & ~_STOP & ~_EXCLAMATION


def statistics(texts: Texts) -> np.ndarray:
    """One row of ``STATISTICS`` for each text."""
    words = Words.of(texts, SPACED)
    hashes = words.hashes(lower=True)
    n, size = words.counts, np.maximum(np.diff(texts.bounds), 1)
    some = np.maximum(n, 1)
    data, text_of = texts.data, words.text_of
    lengths = (words.ends - words.starts).astype(np.float64)
    mean = sums(lengths, words.first) / some
    deviation = np.sqrt(np.maximum(sums(lengths**2, words.first) / some - mean**2, 0))
    letters = np.concatenate([[0], np.cumsum(_LETTER[data] | _DIGIT[data])])
    no_letter = letters[words.ends] == letters[words.starts]
    share = lambda flags: sums(flags[data], texts.bounds) / size

    def distinct(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        return np.bincount(owner[new], minlength=len(texts))

    inside = text_of[1:] == text_of[:-1]
    pairs = (hashes[1:] * np.uint64(3) + hashes[:-1])[inside]
    same = np.bincount(text_of[1:][inside & (hashes[1:] == hashes[:-1])], minlength=len(texts))
    lines, duplicates = duplicate_lines(texts, words)
    entropy = np.zeros(len(texts))
    for i, (a, b) in enumerate(zip(texts.bounds[:-1].tolist(), texts.bounds[1:].tolist(), strict=True)):
        counts = np.bincount(data[a:b], minlength=1)
        p = counts[counts > 0] / max(1, b - a)
        entropy[i] = -(p * np.log2(p)).sum()
    columns = [
        np.log1p(n),
        np.log1p(lines),
        mean,
        deviation,
        share(_UPPER),
        share(_DIGIT),
        share(SYMBOLS),
        share(_STOP),
        share(_EXCLAMATION),
        share(_MARK),
        share(~SPACED),
        share(np.arange(256) >= 128),
        sums(no_letter, words.first) / some,
        sums(lengths <= 3, words.first) / some,
        sums(lengths >= 12, words.first) / some,
        distinct(hashes, text_of) / some,
        1 - distinct(pairs, text_of[1:][inside]) / np.maximum(n - 1, 1) * (n > 1) - (n <= 1),
        same / np.maximum(n - 1, 1),
        duplicates / np.maximum(lines, 1),
        repeat_words(words, words.hashes()) / some,
        np.log1p(n / np.maximum(lines, 1)),
        entropy,
    ]
    out = np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)
    out[n == 0] = 0.0
    return out


@dataclass
class Fourier:
    """Random features whose inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = SEED) -> Fourier:
        random = np.random.default_rng(seed)
        return cls(mean, scale, random.normal(0, 1 / width, (len(mean), features)), random.uniform(0, 2 * np.pi, features))

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.sqrt(2 / self.frequencies.shape[1]) * np.cos(z @ self.frequencies + self.phases)
        return np.concatenate([waves, np.ones((len(rows), 1))], axis=1)


@dataclass
class Classifier:
    """``steps`` and ``levels`` are the isotonic curve: the score from which on each probability holds."""

    fourier: Fourier
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.fourier(rows) @ self.weights

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), self.steps, self.levels)


_STATISTICS = StructType([StructField("statistics", ArrayType(FloatType()))])


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = statistics(Texts.of(batch[text]))
        bounds = np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)
        return {"statistics": pa.ListArray.from_arrays(pa.array(bounds), pa.array(rows.ravel(), pa.float32()))}

    return with_text_columns(docs, text, _STATISTICS, make, keep)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["statistics"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)).astype(np.float64)


def _normal_equations(rows: DataFrame, fourier: Fourier, weights: tuple[float, float]) -> np.ndarray:
    """Sum of weight * z z' over all rows, where z are the features and the label. Row blocks are added up in tasks."""
    width = fourier.frequencies.shape[1] + 2
    block = 32

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            label = batch["label"].to_numpy().astype(np.float64)
            z = np.concatenate([fourier(_matrix(batch)), label[:, None]], axis=1)
            total += (z * np.where(label == 1, weights[1], weights[0])[:, None]).T @ z
        parts = [total[i : i + block].tobytes() for i in range(0, width, block)]
        yield pa.RecordBatch.from_pydict({"block": pa.array(range(len(parts)), pa.int32()), "sums": pa.array(parts, pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, sums_ in zip(batch["block"].to_pylist(), batch["sums"], strict=True):
                part = np.frombuffer(sums_.as_py())
                held[number] = held[number] + part if number in held else part
        packed = pa.array([v.tobytes() for v in held.values()], pa.binary())
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(held), pa.int32()), "sums": packed})

    kind = StructType([StructField("block", IntegerType())]).add("sums", "binary")
    merged = rows.select("statistics", "label").mapInArrow(tidy(add), kind).repartition("block").mapInArrow(tidy(merge), kind).collect()
    return np.concatenate([np.frombuffer(r.sums).reshape(-1, width) for r in sorted(merged, key=lambda r: r.block)])


def isotonic(score: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nondecreasing share of good rows over ascending scores, by pooling neighbours out of order."""
    pools: list[list[float]] = []
    for s, g, n in zip(score.tolist(), good.tolist(), count.tolist(), strict=True):
        pools.append([s, s, g, n])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            low, high = pools[-2], pools.pop()
            pools[-1] = [low[0], high[1], low[2] + high[2], low[3] + high[3]]
    steps = [edge for p in pools for edge in p[:2]]
    levels = [p[2] / p[3] for p in pools for _ in range(2)]
    return np.array(steps), np.array(levels)


def train(rows: DataFrame, chance: Column) -> Classifier:
    """The classifier from rows with ``statistics`` and ``label``; ``chance`` is a hash that sets calibration rows apart."""
    split = rows.withColumn("calibrates", F.pmod(chance, F.lit(CALIBRATION_SHARE)) == 0).select("statistics", "label", "calibrates")
    split = write_once(split, "quality-rows")
    counts = {r[0]: r[1] for r in split.filter("NOT calibrates").groupBy("label").count().collect()}
    dims = len(STATISTICS)
    if len(counts) < 2:
        share = 1.0 if 1 in counts else 0.0 if counts else 0.5
        plain = Fourier.draw(np.zeros(dims), np.ones(dims))
        return Classifier(plain, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, share))
    moments = [f(F.col("statistics")[i]) for i in range(dims) for f in (F.avg, F.stddev_pop)]
    moments = np.array(split.filter("NOT calibrates").select(*moments).first(), dtype=np.float64).reshape(dims, 2)
    fourier = Fourier.draw(moments[:, 0], np.where(moments[:, 1] > 1e-9, moments[:, 1], 1.0))
    weights = (0.5 / counts[0], 0.5 / counts[1])
    system = _normal_equations(split.filter("NOT calibrates"), fourier, weights) * sum(counts.values())
    square, aim = system[:-1, :-1], system[:-1, -1]
    solved = np.linalg.solve(square + RIDGE * np.eye(len(square)), aim)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(fourier, solved, np.zeros(1), np.zeros(1))
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch)), -0.5, 1.5)
            yield pa.RecordBatch.from_pydict({"raw": pa.array(raw), "label": batch["label"]})

    held = split.filter("calibrates").select("statistics", "label").mapInArrow(tidy(scored), "raw double, label long")
    bins = held.groupBy(F.floor(F.col("raw") * BINS / 2).alias("bin")).agg(
        F.avg("raw").alias("raw"), F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")
    )
    bins = bins.orderBy("bin").toPandas()
    if not len(bins):
        return Classifier(fourier, solved, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    # Half a case of each class on either end keeps probabilities off 0 and 1, and classes even, as in the fit.
    good, n = bins["good"].to_numpy(dtype=float), bins["n"].to_numpy(dtype=float)
    even = good / max(good.sum(), 1), (n - good) / max((n - good).sum(), 1)
    score = np.concatenate([[-0.5], bins["raw"].to_numpy(dtype=float), [1.5]])
    edge = 0.5 / (n.sum() + 1)
    steps, levels = isotonic(score, np.concatenate([[0], even[0], [edge]]), np.concatenate([[edge], even[0] + even[1], [edge]]))
    return Classifier(fourier, solved, steps, levels)


_SCORE = StructType([StructField("score", DoubleType())])


def score(rows: DataFrame, model: Classifier, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of rows with ``statistics``, and ``score``: the probability of class 1, both classes alike often."""
    kept = without(rows.select(*(rows.columns if keep is None else keep)), ["score"])
    read = list(dict.fromkeys([*kept, "statistics"]))
    schema = StructType([StructField(f.name, f.dataType) for f in rows.select(*kept).schema] + list(_SCORE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(model.probability(_matrix(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), made], names=[*kept, "score"])

    return rows.select(*read).mapInArrow(tidy(run), schema)
