from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import divergence
from tests.llm.texts import awkward, clashing, lower, table

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        words = Counter(TERMS.findall(lower(r[1] or "")))
        groups[r[2] or "", r[3] or ""] += words
        docs[r[2] or ""].update(set(words))
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        mine = {s: counts for (own, s), counts in groups.items() if own == lang}

        def p(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        q = p(sum(mine.values(), Counter()))
        for s, counts in mine.items():
            own = p(counts)
            pairs = [(sum(f(own[t], other[t]) for t in kept), o) for o, other in ((o, p(c)) for o, c in mine.items() if o != s)]
            terms = [(f(own[t], q[t]), t) for t in kept if counts[t] and own[t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(ranked, 1)]
    return Counter(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shape", [{}, {"first_length": 1, "bits": 1 << 15, "block_terms": 3, "tile": 1}])
def test_equals_brute_force(spark, shape):
    rows = awkward(seed=4)
    docs = clashing(table(spark, rows))
    assert found(divergence.source_divergence(docs, min_docs=3, top=4, **shape)) == brute(rows, 3, 4)


def test_long_terms_ties_and_languages_spelled_like_terms(spark):
    long = "x" * 3_000
    rows = [(i, f"{long}{'y' * (i % 2)} en es {long[:2999]}", "en" if i % 3 else "es", f"s{i % 4}", 0) for i in range(24)]
    rows += [(30, None, None, "s1", 0), (31, "12 --", None, None, 0), (32, "en " * 9, "en", "s2", 0)]
    assert found(divergence.source_divergence(table(spark, rows), min_docs=4, top=3)) == brute(rows, 4, 3)


def test_terms_split_between_prefixes(spark, monkeypatch):
    """A prefix of frequent documents whose complete terms are all rare leaves nothing; tasks hand on in pieces."""
    monkeypatch.setattr(divergence, "HELD", 2)
    rows = [(i, f"common{chr(97 + i)} common rare{chr(97 + i // 2)}", "en", "a" if i % 2 else "b", 0) for i in range(20)]
    kept = divergence.kept_terms(table(spark, rows).select("lang", "source", "text"), 5)
    assert [(r.lang, bytes(r.term)) for r in kept.collect()] == [("en", b"common")]


def test_empty_tables(spark):
    assert divergence.source_divergence(table(spark, [])).count() == 0
    assert divergence.source_divergence(table(spark, [(1, None, None, None, None)])).count() == 0
    two = divergence.source_divergence(table(spark, [(1, "a", "en", "a", 1), (2, None, "en", None, 1)]))
    assert found(two) == Counter([("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)])


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**12), st.integers(0, 10**12))
def test_probabilities_are_exact(uses, others):
    total = uses + others + 2
    assert divergence.probability(np.array([uses]), np.array([total])).tolist() == [1 + 10**9 * (uses + 2) // total]
