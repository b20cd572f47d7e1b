"""Quality rules: a logistic regression on hashed word and character n-grams behind fixed counting rules.

A text is seen through the hashes of its words, word pairs, and runs of 2, 3 and 4 bytes, in ``BUCKETS`` buckets for each
kind. The features of a kind are the shares of its buckets, so a text's score is the mean weight of its n-grams, summed
over the kinds, and no length of text dominates. The model is fitted by adaptive gradient steps on labelled rows, a
logistic curve on labelled rows it has not seen turns scores into probabilities, and documents are scored in Arrow
batches. A document is kept if the counting rules pass it and its probability reaches ``THRESHOLD``.

Fitting reads about ``TRAINING_ROWS`` labelled rows of each class at most, chosen by a hash of their id with the share that
makes so many, in one task; the counts, rules and scores cover every row.

Defined cases: a null text has no words and fails the rules; labels that are null or neither 0 nor 1, and labels of unknown
documents, do not train; without labels of both classes the rules decide alone (probability null); repeated rows are
judged one by one; an empty table gives an empty result; a computed column replaces one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from ..session import write_once
from .batches import SPACED, Texts, Words, mix, slices, tidy, window_hashes, with_text_columns
from .text_stats import base_counts

BUCKETS = 1 << 16
TRAINING_ROWS = 1_500
EPOCHS = 20
RATE = 0.5
#: Every fifth labelled row calibrates and does not train.
CALIBRATION_SHARE = 5
THRESHOLD = 0.3
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

_BYTE_RUNS = (2, 3, 4)
_KINDS = len(_BYTE_RUNS) + 2
_SHIFT = np.uint64(64 - (BUCKETS - 1).bit_length())


def hashed_ngrams(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram the bucket of every n-gram of the slice, and where those of each text begin."""
    words = Words.of(texts, SPACED)
    hashes = words.hashes(lower=True)
    yield (hashes >> _SHIFT).astype(np.int64), words.first
    pairs = window_hashes(hashes, 2)
    inside = words.text_of
    inside = inside[1:] == inside[:-1]
    yield (pairs[inside] >> _SHIFT).astype(np.int64), np.concatenate([[0], np.cumsum(np.maximum(words.counts - 1, 0))])
    sizes = np.diff(texts.bounds)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    packed = texts.data.astype(np.uint64)
    for run in range(2, max(_BYTE_RUNS) + 1):
        n = max(0, len(texts.data) - run + 1)
        packed = (packed[:n] << np.uint64(8)) | texts.data[run - 1 : run - 1 + n]
        if run in _BYTE_RUNS:
            inside = text_of[:n] == text_of[run - 1 : run - 1 + n]
            found = mix(packed[inside] + np.uint64(run << 56)) >> _SHIFT
            yield found.astype(np.int64), np.concatenate([[0], np.cumsum(np.maximum(sizes - run + 1, 0))])


@dataclass
class Model:
    """Weights per kind and bucket, and the logistic curve from score to probability."""

    weights: np.ndarray
    slope: float
    offset: float

    def score(self, texts: Texts) -> np.ndarray:
        total = np.zeros(len(texts))
        for kind, (bucket, first) in enumerate(hashed_ngrams(texts)):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[kind][bucket], dtype=np.float64)])
            total += (sums[first[1:]] - sums[first[:-1]]) / np.maximum(np.diff(first), 1)
        return total

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.offset, -30, 30)))


def _features(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets over all kinds and their shares, of each text."""
    parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(len(texts))]
    for kind, (bucket, first) in enumerate(hashed_ngrams(texts)):
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            if b > a:
                found, counts = np.unique(bucket[a:b], return_counts=True)
                parts[i].append(((found + kind * BUCKETS).astype(np.int32), (counts / (b - a)).astype(np.float32)))
    empty = (np.zeros(0, np.int32), np.zeros(0, np.float32))
    return [(np.concatenate([x for x, _ in p]), np.concatenate([y for _, y in p])) if p else empty for p in parts]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """Weights and bias; each class weighs as much as the other one."""
    weights, squares = np.zeros(_KINDS * BUCKETS), np.full(_KINDS * BUCKETS, 1e-6)
    bias, bias_square = 0.0, 1e-6
    importance = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    random = np.random.default_rng(11)
    for _ in range(epochs):
        for i in random.permutation(len(rows)).tolist():
            bucket, share = rows[i]
            z = bias + float(weights[bucket] @ share)
            error = importance[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i])
            step = error * share
            squares[bucket] += step * step
            weights[bucket] -= rate * step / np.sqrt(squares[bucket])
            bias_square += error * error
            bias -= 0.1 * error / np.sqrt(bias_square)
    return weights.reshape(_KINDS, BUCKETS), bias


def logistic_curve(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset fitted by Newton's method, with smoothed labels so that they stay finite."""
    n1, n0 = max(1, int((labels == 1).sum())), max(1, int((labels == 0).sum()))
    wanted = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design, fitted = np.stack([scores, np.ones(len(scores))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ fitted, -30, 30)))
        curvature = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2) * 1e-6
        fitted = fitted + np.clip(np.linalg.solve(curvature, design.T @ (wanted - p)), -3, 3)
    return float(fitted[0]), float(fitted[1])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> Model | None:
    """The model for ``label`` (1: good), or nothing if one of the classes has no row."""
    marked = labels.filter(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(label).cast("long").alias("label"))
    counts = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    chance, steps = F.xxhash64("_id", F.lit(5)), 1_000_000
    share = [min(steps, TRAINING_ROWS * steps // max(1, counts.get(label, 0))) for label in (0, 1)]
    marked = marked.filter(F.pmod(chance, F.lit(steps)) < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    marked = marked.withColumn("calibrates", F.pmod(F.xxhash64("_id", F.lit(6)), F.lit(CALIBRATION_SHARE)) == 0)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(marked), "_id")
    rows = write_once(rows, "quality-sample")  # many tasks read the documents, one the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        marks, apart = [], []
        for batch in batches:
            for piece in slices(batch, "text"):
                seen += _features(Texts.of(piece["text"]))
                marks.append(piece["label"].to_numpy())
                apart.append(piece["calibrates"].to_numpy(zero_copy_only=False))
        if not seen or not 0 < np.concatenate(marks).mean() < 1:
            return
        marks, apart = np.concatenate(marks), np.concatenate(apart)
        weights, bias = fit([f for f, a in zip(seen, apart, strict=True) if not a], marks[~apart])
        score = np.array([float(weights.ravel()[b] @ s) for b, s in seen])
        held = apart if apart.any() and 0 < marks[apart].mean() < 1 else np.ones(len(marks), dtype=bool)
        slope, offset = logistic_curve(score[held] + bias, marks[held])
        packed = weights.astype(np.float32).tobytes()
        yield pa.RecordBatch.from_pydict({"weights": [packed], "slope": [slope], "offset": [offset + slope * bias]})

    fitted = rows.repartition(1).sortWithinPartitions("_id", "text").select("text", "label", "calibrates")
    found = fitted.mapInArrow(tidy(run), "weights binary, slope double, offset double").collect()
    if not found:
        return None
    return Model(np.frombuffer(found[0].weights, dtype=np.float32).reshape(_KINDS, BUCKETS), found[0].slope, found[0].offset)


_RULES = StructType(
    [StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [StructField("base_failed", BooleanType()), StructField("probability", DoubleType()), StructField("kept", BooleanType())]
)


def judge(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Add the counts, ``base_failed``, the ``probability`` of good quality, and whether the document is ``kept``."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = Texts.of(batch[text])
        counts = base_counts(texts)
        n = counts["n_words"]
        failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
        chance = model.probability(model.score(texts)) if model else np.full(len(n), np.nan)
        kept = ~failed & ((chance >= threshold) | (model is None))
        out = {name: pa.array(values, pa.int64()) for name, values in counts.items()}
        return out | {"base_failed": pa.array(failed), "probability": pa.array(chance, pa.float64(), from_pandas=True), "kept": pa.array(kept)}

    return with_text_columns(docs, text, _RULES, make, keep)
