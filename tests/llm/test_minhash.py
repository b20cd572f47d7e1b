from __future__ import annotations

import random
from collections import Counter

import numpy as np

from millrace.llm import minhash
from tests.llm.test_jaccard_join import brute
from tests.llm.texts import awkward, clashing, table


def classes(rows):
    """Plain classes over two-word shingles."""
    return Counter((i, n, label, i == label) for i, n, label in brute(rows, size=2))


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return Counter(tuple(r) for r in df.collect())


def test_equals_brute_force(spark):
    for seed in (1, 3):
        rows = awkward(seed)
        assert found(minhash.near_duplicates(clashing(table(spark, rows)))) == classes(rows)


def test_chains_and_large_groups(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[i : i + 40]), "en", "a", 0) for i in range(20)]  # each like the next one only
    for i in range(100, 260):
        words = [f"v{j}" for j in range(50)]
        for _ in range(i % 4):
            words[r.randrange(50)] = f"edit{i}"
        rows.append((i, " ".join(words), "en", "b", 0))
    rows += [(i, "the very same text of some words", "en", "a", 0) for i in range(300, 340)]
    for cell in (minhash.FAMILY_SHINGLES, 500):
        got = found(minhash.near_duplicates(table(spark, rows), family_shingles=cell))
        assert got == classes(rows)


def test_two_permutations_estimate_the_similarity():
    r = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        rows = []
        for _ in range(40):
            pool = r.integers(0, 1 << 63, 400, dtype=np.uint64)
            same = int(400 * share)
            rest = (400 - same) // 2
            a, b = pool[: same + rest], np.concatenate([pool[:same], pool[same + rest :]])
            sa, sb = minhash.signatures([a, b], 256)
            rows.append(np.mean(sa == sb))
        assert abs(np.mean(rows) - share) < 0.02
    # A coordinate is the least rank of the places, each moved on; chunks of a set do not change it.
    big = np.arange(1, 40_000, dtype=np.uint64) << np.uint64(32)
    one = minhash.signatures([big[:7], big, big[9:12]], 5)
    for i, s in enumerate((big[:7], big, big[9:12])):
        assert one[i].tolist() == [int(minhash._rank(minhash._scatter(s) + np.uint32(k)).min()) for k in range(5)]
    everything = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash._rank(everything))) == len(np.unique(minhash._scatter(everything.astype(np.uint64) << np.uint64(32)))) == 1 << 16


def test_empty_tables(spark):
    assert minhash.near_duplicates(table(spark, [])).count() == 0
    only = minhash.near_duplicates(table(spark, [(4, None, None, None, None), (None, " ", "en", "a", 1)]))
    assert found(only) == Counter([(4, 0, 4, True), (None, 0, None, True)])
