"""Token counts, quality rules and the quality classifier."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality_classifier, quality_rules, text_stats, token_counts
from millrace.llm.batches import Texts
from millrace.llm.queries import piece_model
from tests.llm.texts import SPACED, awkward, clashing, table

LABELS = "doc_id long, quality int, toxic int"
ODD = ["", " ", "  ", "a", "\n", " \n ", "▁", "▁▁a▁ ", "<s></s><unk><0x0A>", "ﬁ Ａ½ 漢字", "\t\tx", "  a  b ", "é́ ñ", "a\x00b", "🙂🙂 ok", "x" * 90]


@pytest.fixture(scope="module")
def counter():
    pytest.importorskip("public_tokenizers")
    return token_counts.counter(piece_model())


def test_every_prefix_counts_as_the_library_counts_it(counter):
    texts = ODD + [(r[1] or "")[:120] for r in awkward()[:25]]
    for text in texts:
        counts = [len(counter.library.encode(text[:n])) for n in range(len(text) + 1)]
        assert list(counter.prefix_counts(text)) == counts, text
        for limit in (0, 1, 4, 30):
            assert counter.longest_within(text, limit) == max(n for n, c in enumerate(counts) if c <= limit)


def test_token_columns(spark, counter, monkeypatch):
    rows = awkward()
    docs = clashing(table(spark, rows))
    got = token_counts.count_tokens(docs, piece_model, limit=100)
    assert set(got.columns) >= set(docs.columns)
    wanted = Counter()
    for r in rows:
        text = r[1] or ""
        n = len(counter.library.encode(text))
        wanted[r[0], len(text.encode()), n, n > 100] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == wanted
    monkeypatch.setattr(token_counts, "CACHE_SEGMENTS", 5)
    small = token_counts.PrefixCounter(piece_model())
    assert [small.count(r[1] or "") for r in rows] == [counter.count(r[1] or "") for r in rows]
    assert token_counts.count_tokens(table(spark, []), piece_model).count() == 0


def test_segments_side_by_side(counter, monkeypatch):
    """As one by one, in chunks of any size and with a table of pairs in which most pairs share a place."""
    rnd = random.Random(5)
    segments = [" " * rnd.randint(1, 4) + "".join(rnd.choices("aeinrstö的語😀\n\t01-", k=rnd.randint(0, 70))) for _ in range(400)]
    wanted = [counter._inside(s).tobytes() for s in segments]
    monkeypatch.setattr(token_counts, "PAIR_BITS", 6)
    for characters in (1, 100, 1 << 16):
        monkeypatch.setattr(token_counts, "CHUNK_CHARACTERS", characters)
        other = token_counts.PrefixCounter(piece_model())
        long = other.learn(set(segments))
        assert [other.known[s] for s in segments] == wanted
        assert set(long) == {s for s in segments if len(s) > token_counts.CACHED_LENGTH}


def test_stored_prefix_counts_answer_budget_questions(spark, counter):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate([*ODD, None, *[(r[1] or "")[:150] for r in awkward()[:12]]])]
    stored = token_counts.with_prefix_counts(clashing(table(spark, rows)), piece_model, keep=["doc_id"])
    got = {r.doc_id: r for r in stored.select("*", token_counts.fitting_prefix(6).alias("cut"), token_counts.tokens_from(0).alias("whole")).collect()}
    for i, text, *_ in rows:
        text = text or ""
        counts = [len(counter.library.encode(text[:n])) for n in range(len(text) + 1)]
        assert got[i].prefix_tokens == counts
        assert (got[i].cut, got[i].whole) == (max(n for n, c in enumerate(counts) if c <= 6), counts[-1])
    cuts = token_counts.count_tokens(table(spark, rows), piece_model, limit=6, keep=["doc_id"]).collect()
    assert {r.doc_id: r.cut_at for r in cuts} == {i: r.cut for i, r in got.items()}


def plain_counts(text):
    words, seen, duplicates = SPACED.findall(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(covered)


def test_base_counts():
    texts = [r[1] for r in awkward()] + ["a\na \na\n\n \na", "x y " * 30, "\n", "a b c d e f g h\na b c d e f g h", "#|é\r\n#|é\r\n#|é"]
    got = text_stats.base_counts(Texts.of(pa.array(texts, pa.string())))
    assert list(zip(*(got[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True)) == [plain_counts(t) for t in texts]


def library(n=160, seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("th", "in", "wo", "re") for b in ("er", "ou", "al") for c in ("ing", "ly", "s", "")]
    rows, marks = [], []
    for i in range(n):
        good = r.random() < 0.7
        tail = ["", "", ", ", ".\n"] if good else [" | ", "%%%", "!!", " # "]
        rows.append((i, " ".join(r.choice(words) + r.choice(tail) for _ in range(r.randrange(25, 90))), "en", "a", 0))
        marks.append((i, int(good), 0))
    return rows, marks


def test_rules_and_model(spark):
    rows, marks = library()
    train, test = marks[:120], dict((m[0], m[1]) for m in marks[120:])
    train += [(5_000, 1, 0), (3, None, 0), (None, 1, 1)]
    extra = awkward()
    docs = clashing(table(spark, rows + [(r[0] and r[0] + 1_000, *r[1:]) for r in extra]))
    model = quality_rules.train(docs, table(spark, train, LABELS))
    got = quality_rules.judge(docs, model).collect()
    assert np.mean([r.kept == bool(test[r.doc_id]) for r in got if r.doc_id in test]) > 0.95
    for r in got:
        n, _, _, _, repeated = plain_counts(r.text)
        assert (r.n_words, r.n_repeat_words) == (n, repeated) and r.base_failed == (n < 20 or 100 * repeated > 30 * n)
        assert 0 <= r.probability <= 1 and not (r.kept and r.base_failed)
    assert len(got) == len(rows) + len(extra)
    assert quality_rules.judge(table(spark, []), model).count() == 0


def test_rules_alone_without_both_classes(spark):
    docs = table(spark, awkward())
    for marks in ([], [(1, 1, 0), (2, 1, 0)]):
        model = quality_rules.train(docs, table(spark, marks, LABELS))
        assert model is None
        assert all(r.probability is None and r.kept == (not r.base_failed) for r in quality_rules.judge(docs, model).collect())


def test_classifier(spark):
    rows, marks = library(400)
    statistics = quality_classifier.with_statistics(clashing(table(spark, rows + awkward())), keep=["doc_id"])
    marked = statistics.join(table(spark, [m for m in marks if m[0] % 3], LABELS).select("doc_id", F.col("quality").cast("long").alias("label")), "doc_id")
    model = quality_classifier.train(marked, F.xxhash64("doc_id"))
    got = [(r.doc_id, r.score) for r in quality_classifier.score(statistics, model).collect()]
    assert len(got) == 400 + len(awkward()) and all(0 <= s <= 1 for _, s in got)
    quality = {m[0]: m[1] for m in marks if m[0] % 3 == 0 and m[0] > 100}
    assert np.mean([(s >= 0.5) == quality[i] for i, s in got if i in quality]) > 0.95


def test_classifier_without_a_class(spark):
    statistics = quality_classifier.with_statistics(table(spark, awkward()), keep=["doc_id"])
    for label, share in ((1, 1.0), (0, 0.0), (None, 0.5)):
        marked = statistics.withColumn("label", F.lit(label).cast("long")).filter("label IS NOT NULL")
        model = quality_classifier.train(marked, F.xxhash64("doc_id"))
        assert {r.score for r in quality_classifier.score(statistics, model).collect()} == {share}


def test_normal_equations_equal_one_matrix_product(spark):
    statistics = quality_classifier.with_statistics(table(spark, awkward()), keep=["doc_id"]).repartition(5)
    rows = statistics.withColumn("label", (F.col("doc_id") % 2).cast("long")).filter("label IS NOT NULL")
    fourier = quality_classifier.Fourier.draw(np.zeros(len(quality_classifier.STATISTICS)), np.ones(len(quality_classifier.STATISTICS)), 70)
    found = quality_classifier._normal_equations(rows, fourier, (1.0, 3.0))
    data = rows.collect()
    z = np.concatenate([fourier(np.array([r.statistics for r in data])), np.array([[r.label] for r in data])], axis=1)
    weight = np.array([3.0 if r.label else 1.0 for r in data])
    np.testing.assert_allclose(found, (z * weight[:, None]).T @ z, atol=1e-6)


def test_isotonic_curve_is_the_closest_nondecreasing_one():
    random_ = np.random.default_rng(1)
    for _ in range(30):
        n = random_.integers(1, 9, 12).astype(float)
        good = np.array([random_.binomial(int(k), 0.5) for k in n], dtype=float)
        steps, levels = quality_classifier.isotonic(np.arange(12.0), good, n)
        fitted = np.interp(np.arange(12.0), steps, levels)
        share = good / n
        # max over starts of min over ends of the pooled share
        exact = [max(min(np.average(share[a : b + 1], weights=n[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        np.testing.assert_allclose(fitted, exact)
