from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import manifest
from tests.llm.texts import awkward, clashing, lower, table


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n = row[:5]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def climb(levels, place, value):
    """Siblings on the way up, and what the value leads to."""
    proof = []
    for level in levels[:-1]:
        run = level[place // 16 * 16 : place // 16 * 16 + 16]
        proof += run[: place % 16] + run[place % 16 + 1 :]
        run[place % 16] = value
        place, value = place // 16, H("".join(run))
    return proof, value


def brute(rows, altered):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, altered(r)), r[0]))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = Counter()
    for i, s in enumerate(sources):
        for place, (_, _, own, claimed, doc_id) in enumerate(sorted(by_source[s])):
            proof, value = climb(trees[s], place, claimed)
            more, value = climb(top, i, value)
            out[doc_id, own, trees[s][-1][0], top[-1][0], H("".join(proof + more)), value, value == top[-1][0]] += 1
    return out


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert df.columns == names
    return Counter(tuple(r) for r in df.collect())


def lowered(r):
    return lower(r[1]) if r[1] is not None and (r[0] or 0) % 3 == 0 else r[1]


def lowering():
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.coalesce("doc_id", F.lit(0)) % 3 == 0, text).otherwise(F.col("text"))


def test_equals_brute_force(spark):
    rows = awkward(seed=6)
    assert found(manifest.audit(clashing(table(spark, rows)), lowering())) == brute(rows, lowered)


def test_trees_of_many_levels_cut_into_parts(spark, monkeypatch):
    monkeypatch.setattr(manifest, "PART_ROWS", 37)
    r = random.Random(1)
    rows = [(i, f"Text {r.randrange(50)}", "en", "hot" if i % 2 else f"s{i % 40}", i) for i in range(700)]
    wanted = brute(rows, lowered)
    assert found(manifest.audit(table(spark, rows), lowering())) == wanted
    assert {x[-1] for x in wanted} == {True, False}


def test_lone_leaves_and_empty_tables(spark):
    rows = [(3, None, None, None, None)]
    assert found(manifest.audit(table(spark, rows), lowering())) == brute(rows, lowered)
    assert manifest.audit(table(spark, []), lowering()).count() == 0


def test_saved_tables_hold_every_node(spark, tmp_path):
    rows = [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(60)]
    docs = table(spark, rows).withColumn("leaf", manifest.leaf_digest(F.col("text")))
    made = manifest.build_manifest(docs, "source", "doc_id", "leaf", ["doc_id"])
    made.save(str(tmp_path / "m"))
    trees = [tree([H(f"{len(r[1])}:{r[1]}") for r in rows if r[3] == f"s{s}"]) for s in range(3)]
    trees = [tree([t[-1][0] for t in trees]), *trees]
    wanted = {(t, level, place, node) for t, levels in enumerate(trees) for level, nodes in enumerate(levels) for place, node in enumerate(nodes)}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "m" / "nodes")).collect()} == wanted
    assert spark.read.parquet(str(tmp_path / "m" / "root")).first().root == trees[0][-1][0] == made.root


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 600), st.data())
def test_fetched_nodes_are_the_least_that_prove_the_leaves(size, data):
    places = data.draw(st.lists(st.integers(0, size - 1), min_size=1, max_size=8, unique=True))
    levels = tree([H(str(i)) for i in range(size)])
    known = [{} for _ in levels]
    for place in places:
        known[0][place] = levels[0][place]
    wanted = set()  # siblings on the ways of all leaves, less what lies on one of these ways
    for place in places:
        for level, nodes in enumerate(levels[:-1]):
            at = place >> 4 * level
            wanted |= {(level, i) for i in range(at // 16 * 16, min(at // 16 * 16 + 16, len(nodes)))}
    wanted -= {(level, place >> 4 * level) for place in places for level in range(len(levels))}
    fetched = {(level, int(i)) for level, nodes in manifest.missing_nodes(np.array(places), size) for i in nodes}
    assert fetched == wanted
    for level, i in fetched:
        known[level][i] = levels[level][i]
    ways = manifest.Ways(known, places, size)
    for place in places:
        proof, root = climb(levels, place, "other")
        assert ways.siblings(0, place) == "".join(proof) and ways.fold(0, place, "other") == root
        assert ways.fold(0, place, levels[0][place]) == ways.root == levels[-1][0]
