from __future__ import annotations

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from millrace.llm import decontaminate
from millrace.llm.batches import ALPHANUMERIC as WORD_BYTES
from millrace.llm.batches import Texts, Words
from tests.llm.texts import ALPHANUMERIC, awkward, clashing, lower, table

ITEMS = "item_id long, text string"


def brute(items, text, size):
    """Number of words, places hit, items found."""
    words = ALPHANUMERIC.findall(lower(text or ""))
    hit, names = set(), set()
    for item, sample in items:
        own = ALPHANUMERIC.findall(lower(sample or ""))
        n = min(size, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(item)
    return len(words), hit, names


texts = st.lists(st.sampled_from(["a", "b", "C", "é", "c3"]), max_size=25).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=5), st.lists(texts, min_size=1, max_size=3), st.sampled_from([1, 2, 3, 10]))
def test_automaton_finds_what_brute_force_finds(samples, docs, size):
    items = [(str(i), t) for i, t in enumerate(samples)]
    words = Words.of(Texts.of(pa.array(docs, pa.string())), WORD_BYTES)
    spans, names = decontaminate.Automaton(items, size).pack().scan(words.hashes(lower=True), words.first)
    for doc, mine, found in zip(docs, spans, names, strict=True):
        _, hit, wanted = brute(items, doc, size)
        assert {i for a, b in mine for i in range(a, b)} == hit and found == wanted


def samples(rows):
    words = ALPHANUMERIC.findall(rows[5][1])
    return [(1, rows[3][1]), (2, " ".join(words[:14])), (3, "The x of"), (4, None), (5, " . "), (3, "The x of"), (None, "w1 w2")]


def test_spans(spark):
    rows = awkward(seed=2)
    items = samples(rows)
    known = [(str(i), t) for i, t in items if i is not None]
    for shard_bytes in (1 << 20, 40):
        found = decontaminate.find_spans(clashing(table(spark, rows)), table(spark, items, ITEMS), shard_bytes=shard_bytes)
        got = Counter((r.doc_id, r.n_words, sum(b - a for a, b in zip(r.hit_from, r.hit_to, strict=True)), tuple(x for x in r["items"] if x)) for r in found.collect())
        wanted = Counter()
        for r in rows:
            n, _, names = brute(known, r[1], 10)
            wanted[r[0], n, len(brute([*known, ("", "w1 w2")], r[1], 10)[1]), tuple(sorted(names))] += 1
        assert got == wanted


def test_removal(spark):
    rows = [
        (1, "keep this\nThe quick, brown fox jumps over the lazy dog and runs!\nAnd keep that, " + "clean words here " * 6, "en", "a", 1),
        (2, "the quick brown fox jumps over the lazy dog and runs", "en", "a", 1),
        (3, "clean é\n text ", "en", "a", 1),
        (4, None, "en", "a", None),
    ]
    items = [(7, "The quick brown fox jumps over the lazy dog and runs")]
    docs = clashing(table(spark, rows))
    left = decontaminate.decontaminate(docs, table(spark, items, ITEMS))
    assert left.columns == docs.columns
    got = {r.doc_id: r.text for r in left.collect()}
    assert got == {1: "keep this\nAnd keep that, " + "clean words here " * 6, 3: "clean é\n text ", 4: None}
    again = decontaminate.find_spans(left, table(spark, items, ITEMS))
    assert not any(r.hit_from for r in again.collect())


def test_empty_tables(spark):
    rows = awkward(seed=2)
    untouched = decontaminate.decontaminate(table(spark, rows), table(spark, [], ITEMS))
    assert Counter(tuple(r) for r in untouched.collect()) == Counter(rows)
    assert decontaminate.find_spans(table(spark, []), table(spark, [(1, "a b")], ITEMS)).count() == 0


def test_many_shards_and_removal_equal_one(spark):
    rows = awkward(seed=3)
    items = [(i, " ".join(ALPHANUMERIC.findall(r[1])[: 6 + i % 20])) for i, r in enumerate(rows[:30])]
    for run in (decontaminate.find_spans, decontaminate.decontaminate):
        one, many = (run(clashing(table(spark, rows)), table(spark, items, ITEMS), shard_bytes=b) for b in (1 << 20, 100))
        assert one.columns == many.columns
        assert Counter(map(str, one.collect())) == Counter(map(str, many.collect()))
