from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing
from tests.llm.texts import SPACED, awkward, clashing, table


def plain_targets(totals):
    """Deal by weight, cap, and deal the excess again until none is above."""
    names = sorted((s for s in totals if s is not None), key=str.encode) + [None] * (None in totals)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, aims, open_ = 1.5 * sum(totals.values()), {}, set(names)
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > 2 * totals[s]}
        for s in over or open_:
            aims[s] = 2.0 * totals[s] if over else left * weight[s] / whole
        left -= sum(aims[s] for s in over)
        open_ = open_ - over if over else set()
    return aims


def crowd(seed, n=3_000):
    r = random.Random(seed)
    return [(i, "w " * max(1, int(r.paretovariate(1.1) * 5) % 4_000), "en", r.choice(["a", "a", "b", "c", "Z", "é", None]), 0) for i in range(n)]


def deal(spark, rows, **options):
    return mixing.deal_copies(mixing.identify(clashing(table(spark, rows))), **options).collect()


@pytest.mark.parametrize("rows", [awkward(), crowd(1)], ids=["awkward", "crowd"])
def test_sizes_targets_and_totals(spark, rows):
    dealt = deal(spark, rows, bucket_rows=100, fan_in=4)
    size = lambda text: len(SPACED.findall(text or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in dealt for _ in range(r.rows)) == Counter((r[0], r[3], size(r[1])) for r in rows)
    totals, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in rows:
        totals[r[3]] += size(r[1])
        largest[r[3]] = max(largest[r[3]], size(r[1]))
    aims = plain_targets(totals)
    for r in dealt:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(aims[r.source]) and 0 <= r.copies <= 2
        taken[r.source] += r.rows * r.copies * r.size
    for source, aim in aims.items():
        assert abs(taken[source] - aim) <= (0.002 * totals[source] + 60 if len(rows) > 1_000 else largest[source])


def test_reruns_and_other_partitions_agree(spark):
    rows = crowd(2, 600)
    shuffled = random.Random(1).sample(rows, len(rows))
    docs = table(spark, shuffled).repartition(9)
    again = mixing.deal_copies(mixing.identify(docs), bucket_rows=50).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, deal(spark, rows, bucket_rows=50)))


def test_a_shift_keeps_words_and_settles_one():
    r = random.Random(4)
    kept = [0.0, 0.0]
    for _ in range(4_000):
        p, q, a, b = 0.3, 0.6, r.choice([1, 5, 70]), r.choice([1, 8, 90])
        x, y = mixing._shift(p, a, q, b, r.random())
        assert x * a + y * b == pytest.approx(p * a + q * b) and (x in (0, 1) or y in (0, 1)) and 0 <= min(x, y) <= max(x, y) <= 1
        kept[0] += x / 4_000
        kept[1] += y / 4_000
    assert kept == pytest.approx([0.3, 0.6], abs=0.03)


def test_the_mixture_repeats_rows(spark):
    rows = crowd(3, 200) + awkward()
    docs = clashing(table(spark, rows))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    copies = Counter()
    for r in deal(spark, rows):
        copies[r.doc_id, r.size] += r.copies * r.rows
    got = Counter((r.doc_id, len(SPACED.findall(r.text or ""))) for r in mixed.collect())
    assert got == +copies


def test_empty_table_and_no_words(spark):
    assert deal(spark, []) == []
    assert mixing.mix(table(spark, [])).count() == 0
    assert [(r.size, r.copies, r.target) for r in deal(spark, [(1, None, "en", "a", 0)])] == [(0, 0, 0.0)]


def test_targets_of_many_sources(spark):
    r = random.Random(8)
    totals = {f"s{i:03}": r.choice([1, 5, 100, 1_000]) for i in range(50)}
    rows = spark.createDataFrame([(s, n) for s, n in totals.items()], "source string, size long")
    got = {x.source: x.target for x in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(plain_targets(totals))
    assert rows.agg(F.sum("size")).first()[0] * 1.5 == pytest.approx(sum(got.values()))
