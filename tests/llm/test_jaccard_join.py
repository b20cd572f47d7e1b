from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import jaccard_join
from millrace.llm.components import components
from tests.llm.texts import SPACED, awkward, clashing, lower, table


def shingles(text, size=5):
    words = SPACED.findall(lower(text or ""))
    if len(words) >= size:
        return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)] if words else [])


def brute(rows, size=5):
    """(id, set size, smallest id of the class) by comparing all pairs."""
    sets = [shingles(r[1], size) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for r, x in zip(rows, label, strict=True):
        ids[x] += [] if r[0] is None else [r[0]]
    smallest = {x: min(found, default=None) for x, found in ids.items()}
    return sorted(((r[0], len(s), smallest[x] if s else r[0]) for r, s, x in zip(rows, sets, label, strict=True)), key=repr)


def found(df, **options):
    classes = jaccard_join.jaccard_classes(df, **options)
    return sorted((tuple(r) for r in classes.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"list_limit": 2, "slots": 1 << 14, "family_shingles": 300}], ids=["plain", "heavy lists, cells"])
def test_classes_equal_comparing_all_pairs(spark, options):
    rows = awkward()
    assert found(clashing(table(spark, rows)), **options) == brute(rows)


def test_a_chain_is_one_class(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([f"n{i}_{j}" if j // 3 < i and j % 3 == 0 else w for j, w in enumerate(words)]), "en", "a", 0) for i in range(9)]
    assert found(table(spark, rows)) == brute(rows)


def test_one_large_group_of_near_copies(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*words[: i % 50], f"own{i}", *words[i % 50 :]]), "en", "a", 0) for i in range(150)]
    assert found(table(spark, rows), list_limit=10, family_shingles=2_000) == brute(rows)


def test_empty_table(spark):
    assert found(table(spark, [])) == []


def test_one_row_of_each_class_stays(spark):
    rows = awkward(seed=4)
    docs = clashing(table(spark, rows))
    left = jaccard_join.keep_one_of_each_class(docs)
    assert left.columns == docs.columns
    stay = {(i, x) for i, n, x in brute(rows) if n and i == x}
    worded = Counter(r.doc_id for r in left.select("doc_id", "text").collect() if shingles(r.text))
    assert {i for i, _ in stay} == set(worded) and max(worded.values()) == 1
    assert Counter(r.doc_id for r in left.collect() if not shingles(r.text)) == Counter(r[0] for r in rows if not shingles(r[1]))


def test_family_links_connect_what_all_pairs_do():
    random = np.random.default_rng(3)
    for _ in range(60):
        base = random.choice(2000, 60, replace=False)
        sets = []
        for _ in range(random.integers(2, 25)):
            change = random.integers(0, 14)
            sets.append(np.unique(np.concatenate([random.permutation(base)[change:], random.integers(2000, 2040, change)])).astype(np.uint64))
        sets.sort(key=len)
        ours, theirs = jaccard_join.Classes(len(sets)), jaccard_join.Classes(len(sets))
        links = jaccard_join.family_links(sets)
        for i, j in links:
            assert 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
            ours.join(i, j)
        for i in range(len(sets)):
            for j in range(i):
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])):
                    theirs.join(i, j)
        assert [ours.root(i) for i in range(len(sets))] == [theirs.root(i) for i in range(len(sets))]
        assert len(links) == len(sets) - ours.count


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (20, 21), (21, 20), (5, 5), *((100 + i, 101 + i) for i in range(40)), *((500, 501 + i) for i in range(30))]
    labels = components(spark.createDataFrame(edges, "a long, b long"))
    assert labels.count() == labels.select("node").distinct().count()
    got = {r.node: r.label for r in labels.collect()}
    assert got == {**{i: 1 for i in (1, 2, 3, 9)}, 20: 20, 21: 20, **{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 531)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hashes_do_not_depend_on_the_batch(spark):
    docs = table(spark, awkward(seed=9))
    one = {tuple(r) for r in jaccard_join._sets(docs.select("doc_id", F.lit(1).cast("long").alias("text_key"), "text").coalesce(1), 5, 1 << 14).filter("block IS NULL").select("doc_id", "n", "k").collect()}
    many = {tuple(r) for r in jaccard_join._sets(docs.select("doc_id", F.lit(1).cast("long").alias("text_key"), "text").repartition(7), 5, 1 << 14).filter("block IS NULL").select("doc_id", "n", "k").collect()}
    assert one == many
