from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import top_k
from millrace.operators.rows import frequency


def skewed(spark, n=4_000, keys=900, seed=1):
    r = random.Random(seed)
    return spark.createDataFrame([(f"k{int(r.paretovariate(0.9)) % keys}" if i % 50 else None,) for i in range(n)], "key string").repartition(5)


@pytest.mark.parametrize("capacity", [5, 40, 10_000])
def test_equals_a_full_count(spark, capacity):
    df = skewed(spark)
    for k in (1, 7):
        assert top_k.exact_top_k(df, "key", "n", k, capacity).collect() == frequency(df, "key", "n", k).collect()


def test_flat_counts_fall_back(spark):
    df = spark.range(3_000).select((F.col("id") % 1_000).alias("key"))
    assert top_k.exact_top_k(df, "key", "n", 3, capacity=20).collect() == frequency(df, "key", "n", 3).collect()
    assert top_k.exact_top_k(df, "key", "n", 3, capacity=5_000, candidates=10).collect() == frequency(df, "key", "n", 3).collect()
    assert top_k.exact_top_k(df.limit(0), "key", "n", 3).count() == 0


def test_summaries_are_small_and_keep_their_bound(spark):
    df = skewed(spark)
    counts = Counter(r.key for r in df.collect())
    found = top_k.summaries(df, "key", 30).collect()
    error = sum(r.error or 0 for r in found)
    summed = Counter()
    for r in found:
        if r.error is None:
            summed[r["item"]] += r.n
    assert len(found) <= 5 * 31 and all(counts[k] - error <= summed[k] <= counts[k] for k in counts)


def test_only_candidates_are_counted(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(top_k, "frequency", lambda df, *a: counted.append(df) or frequency(df, *a))
    df = skewed(spark)
    top_k.exact_top_k(df, "key", "n", 2, 100)
    assert len(counted) == 1 and counted[0].select("key").distinct().count() < 400
