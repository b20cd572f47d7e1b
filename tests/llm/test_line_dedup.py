from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import line_dedup
from millrace.llm.batches import Texts
from tests.llm.texts import SPACED, awkward, clashing, table


@cache
def gram_hash(gram):
    lines = line_dedup.Lines(Texts.of(pa.array(["\n".join(gram)])))
    words = int(lines.words.sum())
    return int(lines.fingerprints(words, words)[1][0])


def brute(rows, gram_words, window_words):
    """Lines with words of each row, and those of them that go, window by window."""
    ordered = sorted(set((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
    docs = [[" ".join(w) for line in (t or "").split("\n") if (w := SPACED.findall(line))] for _, t in ordered]
    first, places = {}, []
    for d, lines in enumerate(docs):
        sizes = [len(line.split(" ")) for line in lines]

        def reach(at, wanted, sizes=sizes):
            return next((e for e in range(at + 1, len(sizes) + 1) if sum(sizes[at:e]) >= wanted), None)

        grams = [reach(i, gram_words) for i in range(len(lines))]
        chosen = set()
        for i in range(len(lines)):
            if (end := reach(i, window_words)) is not None:
                inside = [(gram_hash(tuple(lines[x : grams[x]])), x) for x in range(i, end) if grams[x] and grams[x] <= end]
                chosen.add(min(inside)[1])
        for x in sorted(chosen):
            gram = tuple(lines[x : grams[x]])
            places.append((d, x, gram))
            first.setdefault(gram, (d, x))
    gone = [set() for _ in docs]
    for d, x, gram in places:
        source, at = first[gram]
        if (source, at) != (d, x):
            a, b, low, high = docs[d], docs[source], 0, 0
            while low < min(x, at) and a[x - low - 1] == b[at - low - 1]:
                low += 1
            while x + high < len(a) and at + high < len(b) and a[x + high] == b[at + high]:
                high += 1
            gone[d] |= set(range(x - low, x + high))
    found = {o: (len(lines), dead) for o, lines, dead in zip(ordered, docs, gone, strict=True)}
    return [(r, *found[r[0], r[1]]) for r in rows]


def poems(seed):
    """Documents cut and joined from the same lines."""
    import random

    r = random.Random(seed)
    lines = [" ".join(f"l{i}w{j}" for j in range(r.choice([1, 2, 5, 9]))) for i in range(60)] + ["", "  "]
    rows = []
    for i in range(40):
        pieces = [lines[a : a + r.randrange(1, 15)] for a in (r.randrange(60) for _ in range(r.randrange(1, 6)))]
        rows.append((i, "\n".join(x for p in pieces for x in p), "en", "a", 0))
    return [*rows, rows[3], (None, rows[4][1], "en", "a", 0), *awkward(seed)[60:64]]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_that_go_equal_brute_force(spark, seed):
    rows = poems(seed)
    left = line_dedup.dedup_lines(clashing(table(spark, rows)), gram_words=6, window_words=12, counts=True)
    wanted = Counter()
    for r, n, dead in brute(rows, 6, 12):
        wanted[r[0], n, len(dead)] += 1
    assert Counter((r.doc_id, r.n_lines, r.n_deleted) for r in left.collect()) == wanted
    assert sum(dead > 0 for _, _, dead in wanted) > 10


def test_text_that_is_left(spark):
    rows = poems(5)
    docs = clashing(table(spark, rows))
    left = line_dedup.dedup_lines(docs, gram_words=6, window_words=12)
    assert left.columns == docs.columns
    wanted = Counter()
    for r, n, dead in brute(rows, 6, 12):
        if not n or len(dead) < n:
            kept, seen = [], -1
            for line in (r[1] or "").split("\n"):
                seen += bool(SPACED.search(line))
                if not SPACED.search(line) or seen not in dead:
                    kept.append(line)
            wanted[r[0], None if r[1] is None else "\n".join(kept)] += 1
    assert Counter((r.doc_id, r.text) for r in left.collect()) == wanted


def test_every_shared_run_of_a_window_is_found_and_stands_once(spark):
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(17)) for i in range(3))
    one_line = " ".join(f"o{j}" for j in range(51))
    rows = [(i, f"start {i}\n{passage}\nmiddle {i}\n{one_line}\nend {i}", "en", "a", 0) for i in range(300)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows)).collect()}
    assert got.pop(0) == rows[0][1]
    assert got == {i: f"start {i}\nmiddle {i}\nend {i}" for i in range(1, 300)}


def test_copies_go_and_short_repeats_stay(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "en", "a", 0), (2, text, "en", "a", 0), (3, "a short line\nof it\n" + text[:40], "en", "a", 0), (4, "a short line\nof it", "en", "a", 0)]
    assert sorted(r.doc_id for r in line_dedup.dedup_lines(table(spark, rows)).collect()) == [2, 3, 4]
    assert line_dedup.dedup_lines(table(spark, [])).count() == 0


def words_left(rows, size):
    """Words of each row that lie in no run of ``size`` words with an earlier place; run by run."""
    seen, left = set(), {}
    for o in sorted(set((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0)):
        words = SPACED.findall(o[1] or "")
        dead = set()
        for i in range(len(words) - size + 1):
            if (run := tuple(words[i : i + size])) in seen:
                dead |= set(range(i, i + size))
            seen.add(run)
        left[o] = [w for i, w in enumerate(words) if i not in dead]
    return left


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_inside_lines_equal_brute_force_over_runs(spark, seed):
    import random

    r = random.Random(seed)
    source = [f"s{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(r.randrange(1, 5)):
            a = r.randrange(400)
            words += source[a : a + r.choice([5, 19, 20, 21, 40, 120])] + [f"d{i}x{r.randrange(9)}" for _ in range(r.randrange(6))]
        rows.append((i, "".join(w + r.choice([" ", " ", "  ", "\t", "\n"] if i % 2 else [" "]) for w in words), "en", "a", 0))
    rows += [(70, "same " * 90, "en", "a", 0), rows[3], (None, rows[4][1], "en", "a", 0), (71, None, "en", "a", 0)]
    # Grams and windows of lines beyond any text: what goes, goes as a passage.
    docs = clashing(table(spark, rows))
    got = line_dedup.dedup_lines(docs, gram_words=10**6, window_words=10**6, passage_words=20, counts=True).collect()
    wanted = words_left(rows, 20)
    assert Counter((r.doc_id, tuple(SPACED.findall(r.text or ""))) for r in got) == Counter((r[0], tuple(wanted[r[0], r[1]])) for r in rows)
    assert sum(0 < len(wanted[r[0], r[1]]) < len(SPACED.findall(r[1] or "")) for r in rows) > 10


def test_a_passage_inside_a_line_goes_word_by_word(spark):
    passage = " ".join(f"p{j}" for j in range(50))
    rows = [(i, f"start a{i} {passage}  b{i} tail\n\nlast line c{i}\n{passage}", "en", "a", 0) for i in (1, 2)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows), passage_words=line_dedup.PASSAGE_WORDS).collect()}
    assert got == {1: f"start a1 {passage}  b1 tail\n\nlast line c1", 2: "start a2 b2 tail\n\nlast line c2"}


def near_copies(seed):
    """Texts of the same words, in which some are changed, so that runs of 50 words are shared in all lengths."""
    import random

    r = random.Random(seed)
    source = [f"s{i}" for i in range(600)]
    rows = []
    for i in range(40):
        a = r.randrange(300)
        words = [w if r.random() > 0.02 else f"{w}x{r.randrange(3)}" for w in source[a : a + r.randrange(40, 300)]]
        rows.append((i, "".join(w + r.choice([" ", " ", " ", "\n"] if i % 2 else [" "]) for w in words), "en", "a", 0))
    return [*rows, (60, "same " * 90, "en", "a", 0), rows[3], (None, rows[4][1], "en", "a", 0), (61, None, "en", "a", 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_in_near_copies_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = table(spark, rows)
    got = line_dedup.dedup_lines(docs, gram_words=10**6, window_words=10**6, passage_words=50, counts=True).collect()
    wanted = words_left(rows, 50)
    assert Counter((r.doc_id, tuple(SPACED.findall(r.text or ""))) for r in got) == Counter((r[0], tuple(wanted[r[0], r[1]])) for r in rows)
    assert sum(0 < len(wanted[r[0], r[1]]) < len(SPACED.findall(r[1] or "")) for r in rows) > 10


def test_python_sees_whole_texts_for_the_marks_and_the_cuts_only(spark, monkeypatch):
    seen, inner = [], line_dedup.with_text_columns

    def noted(df, *args, **kwargs):
        seen.append(df)
        return inner(df, *args, **kwargs)

    monkeypatch.setattr(line_dedup, "with_text_columns", noted)
    rows = near_copies(3) + [(i, " ".join(f"d{i}w{j}" for j in range(60)), "en", "a", 0) for i in range(100, 140)]
    line_dedup.dedup_lines(table(spark, rows), passage_words=50).collect()
    assert [df.count() for df in seen if df.filter("text LIKE 'd1%'").count()] == [len(rows)] * 2


def test_few_runs_of_near_copies_are_compared_one_by_one():
    words = [f"w{i}" for i in range(20000)]
    edited = [w + "x" if i % 40 == 39 and i % 120 != 39 else w for i, w in enumerate(words)]
    found, of = [], {}
    for text in (words, edited):
        lines = line_dedup.Lines(Texts.of(pa.array([" ".join(text)])))
        runs = line_dedup.Runs(lines.of_words, lines.sums, 50, 25)
        low, last, place = runs.spans()
        begin, at, cores = runs.zones(low, last, place)
        ends = np.append(at[1:], len(begin))
        assert begin.tolist() == runs.begin.tolist()
        found.append((runs, low, last, place, begin[at], begin[ends - 1], cores))
    for k, sides in ((0, [(f[0], f[1], f[2], f[0].grams(f[3])) for f in found]), (1, [(f[0], f[4], f[5], f[6]) for f in found])):
        by_key = {}
        for runs, low, last, keys in sides:
            for key, h, n in zip(keys.tolist(), runs.sums.hashes(low, last + 50).tolist(), (last - low + 1).tolist(), strict=True):
                by_key.setdefault(key, {})[h] = n
        of[k] = sum(sum(spans.values()) for spans in by_key.values() if len(spans) > 1)
    assert 0 < of[1] < of[0] / 2


def test_slices_of_which_nothing_goes(spark):
    rows = [(i, " ".join(f"{i}w{j}" for j in range(60000)), "en", "a", 0) for i in range(4)]
    got = line_dedup.dedup_lines(table(spark, rows).coalesce(1), counts=True, passage_words=50).collect()
    assert sorted((r.doc_id, r.text, r.n_deleted) for r in got) == [(i, text, 0) for i, text, *_ in rows]


def test_lines_with_words_are_counted_like_those_that_are_cut():
    texts = Texts.of(pa.array([r[1] for r in awkward(4)] + [None, "", "\n", " \n\n", "a", "a\n", "\na\n \nb"]))
    assert line_dedup.line_counts(texts).tolist() == np.diff(line_dedup.Lines(texts).first).tolist()
    assert line_dedup.line_counts(Texts.of(pa.array([], pa.string()))).tolist() == []


def test_the_map_of_keys_keeps_all_that_match_and_few_others(spark):
    rows = spark.range(20000).select(F.struct(F.col("id"), F.lit("x").alias("t")).alias("doc"))
    few = rows.filter("doc.id % 40 = 0")
    kept = {r.doc.id for r in line_dedup.likely(rows, few, "doc").collect()}
    assert {i for i in range(0, 20000, 40)} <= kept and len(kept) < 520


def test_a_run_goes_though_its_lines_stand_alone_in_earlier_documents(spark):
    lines = [" ".join(f"{x}{j}" for j in range(25)) for x in "ab"]
    rows = [(i, f"{line}\nq{i}", "en", "a", 0) for i, line in enumerate(lines)]
    rows += [(i, f"x{i}\n{lines[0]}\n{lines[1]}", "en", "a", 0) for i in (2, 3)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(table(spark, rows), passage_words=line_dedup.PASSAGE_WORDS).collect()}
    assert got[3] == "x3"
