"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import line_dedup, quality_classifier, quality_rules, queries, stages, url_filter
from millrace.llm.batches import Texts, mix
from tests.compare import compare, connect
from tests.llm.test_decontaminate import brute as brute_spans
from tests.llm.test_jaccard_join import brute as brute_classes
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import plain_targets
from tests.llm.test_secrets_and_urls import judged
from tests.llm.test_text_rules import plain_counts
from tests.llm.texts import SPACED, awkward, lower, table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def docs(spark):
    return queries.table(spark, SF_DIR, "documents").collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_languages_of_held_out_documents(spark, docs):
    lang = {r.doc_id: r.lang for r in docs}
    got = queries.op1_language_id(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in got if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and np.mean([r.accepted for r in got]) > 0.98


def dead_words(rows):
    """Of each distinct document the words that go, with the lines that fingerprints find and with runs of 50 words."""
    seen, out = set(), {}
    lines_of = {(r[0], r[1]): dead for r, _, dead in brute_lines(rows, 25, 50)}
    for own in sorted(lines_of, key=lambda r: (r[0] is None, r[0] or 0)):
        lines = [w for line in (own[1] or "").split("\n") if (w := SPACED.findall(line))]
        words = [(w, i) for i, line in enumerate(lines) for w in line]
        dead = {k for k, (_, i) in enumerate(words) if i in lines_of[own]}
        for k in range(len(words) - 49):
            if (run := tuple(w for w, _ in words[k : k + 50])) in seen:
                dead |= set(range(k, k + 50))
            seen.add(run)
        left = {i for k, (_, i) in enumerate(words) if k not in dead}
        out[own] = len(lines), len(lines) - len(left), [w for k, (w, _) in enumerate(words) if k not in dead]
    return out


def test_line_counts_and_texts(spark, docs):
    wanted = dead_words([(r.doc_id, r.text) for r in docs])
    left = line_dedup.dedup_lines(queries.table(spark, SF_DIR, "documents"), counts=True, passage_words=line_dedup.PASSAGE_WORDS)
    texts = {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in left.collect()}
    for (doc_id, _), (n, gone, words) in wanted.items():
        assert texts[doc_id][1:] == (n, gone) and SPACED.findall(texts[doc_id][0] or "") == words
    digest = lambda t: None if t is None else hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: (r.text_sha256, r.n_lines, r.n_deleted) for r in queries.op2_line_dedup(spark, SF_DIR).collect()}
    assert got == {i: (digest(t), n, gone) for i, (t, n, gone) in texts.items()}


def test_source_targets_and_words_taken(spark, docs):
    size = {r.doc_id: len(SPACED.findall(r.text or "")) for r in docs}
    totals, taken, largest = Counter(), Counter(), Counter()
    for r in docs:
        totals[r.source] += size[r.doc_id]
        largest[r.source] = max(largest[r.source], size[r.doc_id])
    aims, source = plain_targets(totals), {r.doc_id: r.source for r in docs}
    got = queries.op3_source_mix(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    for r in got:
        own = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], totals[own]) and r.target == pytest.approx(aims[own])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[own] += r.taken
    assert all(abs(taken[s] - aim) <= largest[s] for s, aim in aims.items())


def plain_features(text):
    """Words, word pairs and byte runs, each as often as it occurs, and the bucket of one of them."""
    words = [w.encode() for w in SPACED.findall(lower(text))]
    data = text.encode()
    kinds = [[(w,) for w in words], list(zip(words, words[1:], strict=False))]
    kinds += [[data[i : i + n] for i in range(len(data) - n + 1)] for n in (2, 3, 4)]
    return kinds


def bucket(kind, feature):
    one = lambda text: next(iter(quality_rules.hashed_ngrams(Texts.of(pa.array([text])))))[0]
    if kind == 0:
        return one(feature[0].decode())[0]
    if kind == 1:
        return list(quality_rules.hashed_ngrams(Texts.of(pa.array([b" ".join(feature).decode()]))))[1][0][0]
    value = (int.from_bytes(feature, "big") + (len(feature) << 56)) % (1 << 64)
    return int(mix(np.array([value], dtype=np.uint64))[0] >> quality_rules._SHIFT)


def test_quality_columns_and_verdicts(spark, docs):
    text = {r.doc_id: r.text for r in docs}
    table_of = queries.table(spark, SF_DIR, "documents")
    model = quality_rules.train(table_of, queries.table(spark, SF_DIR, "labels"))
    got = queries.op6_quality_rules(spark, SF_DIR).collect()
    assert sorted(text) == sorted(r.doc_id for r in got)
    for r in got:
        counts = plain_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert r.kept == (not r.base_failed and r.probability >= quality_rules.THRESHOLD)
    for r in [r for r in got if len(text[r.doc_id]) < 900][:25]:
        score = 0.0
        for kind, features in enumerate(plain_features(text[r.doc_id])):
            score += sum(model.weights[kind][bucket(kind, f)] * n for f, n in Counter(features).items()) / max(1, len(features))
        assert r.probability == pytest.approx(1 / (1 + math.exp(-(model.slope * score + model.offset))), abs=1e-6)


def plain_tokens(url):
    host, path, _ = judged(url)
    labels = [x for x in host.split(".") if x]
    scheme = re.match("([a-zA-Z]+)://", url or "")
    out = {f"scheme:{scheme[1]}"} if scheme else set()
    out |= {f"host:{w}" for x in labels for w in x.split("-")} | {"under:" + ".".join(labels[i:]) for i in range(len(labels))}
    return out | {f"path:{x}" for x in path.split("/") if x} | {f"query:{x}" for x in re.findall("[?&]([^=&#]+)", url or "")}


def test_urls(spark):
    got = queries.op7_url_filter(spark, SF_DIR).collect()
    pages = {r.page_id: r.url for r in queries.table(spark, SF_DIR, "pages").collect()}
    assert sorted(pages) == sorted(r.page_id for r in got)
    tokens = {i: sorted(plain_tokens(url)) for i, url in pages.items()}
    seen, blocked = Counter(), Counter()
    for i, url in pages.items():
        combinations = [c for n in range(1, len(tokens[i]) + 1) for c in itertools.combinations(tokens[i], n)]
        seen.update(combinations)
        if judged(url)[2][1] == "block":
            blocked.update(combinations)
    least = url_filter.MIN_SUPPORT * len(pages)
    sure = {c for c, n in blocked.items() if n >= least and n >= url_filter.MIN_CONFIDENCE * seen[c]}
    for r in got:
        host, path, (rule, verdict) = judged(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict is None:
            mine = any(c in sure for n in range(1, len(tokens[r.page_id]) + 1) for c in itertools.combinations(tokens[r.page_id], n))
            verdict = "block" if mine else "allow"
            assert r.mined is None or tuple(r.mined.split(" ")) in sure
        assert r.verdict == verdict


def test_token_counts(spark, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    got = queries.op8_token_counts(spark, SF_DIR).collect()
    wanted = {r.doc_id: (len(r.text.encode()), len(library.encode(r.text))) for r in docs}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == wanted
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_quality_scores(spark, docs):
    got = queries.op10_quality_classifier(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs)
    quality = {r.doc_id: r.quality for r in queries.table(spark, SF_DIR, "labels").collect()}
    held = [r for r in got if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    # The same model by hand: ridge over the cosines of all training rows at once, pooled into a rising curve.
    rows = quality_classifier.with_statistics(queries.table(spark, SF_DIR, "documents"), keep=["doc_id"])
    marked = rows.join(spark.createDataFrame([(i, q) for i, q in quality.items() if zlib.crc32(str(i).encode()) % 3 != 1 and q in (0, 1)], "doc_id long, label long"), "doc_id")
    model = quality_classifier.train(marked, F.xxhash64("doc_id"))
    statistics = {r.doc_id: np.array(r.statistics, dtype=float) for r in rows.collect()}
    for r in got[:80]:
        assert r.score == pytest.approx(float(model.probability(statistics[r.doc_id][None, :])[0]), abs=1e-6)


def test_each_stage_of_the_pipeline_on_what_the_one_before_kept(spark):
    source = queries.table(spark, SF_DIR, "documents")
    items = [(str(r.item_id), r.text) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    kept, docs = [], source
    for name, stage in stages.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, SF_DIR)
        after = docs.collect()
        kept.append((name, before, after, docs.columns))
        docs = spark.createDataFrame([tuple(r)[: len(source.columns)] for r in after], source.schema)
    assert [name for name, *_ in kept] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources"]
    assert all(columns == source.columns for *_, columns in kept[:-1])

    _, before, after, _ = kept[0]
    assert set(map(tuple, after)) <= set(before) and len(after) >= 0.98 * len(before)
    _, before, after, _ = kept[1]
    wanted = {i: words for (i, _), (n, _, words) in dead_words(before).items() if words or not n}
    assert {r.doc_id: SPACED.findall(r.text or "") for r in after} == wanted
    _, before, after, _ = kept[2]
    assert sorted(r.doc_id for r in after) == sorted(i for i, n, label in brute_classes(before) if not n or i == label)
    _, before, after, _ = kept[3]
    share = {r[0]: len(brute_spans(items, r[1], 10)[1]) / max(1, brute_spans(items, r[1], 10)[0]) for r in before}
    assert {r.doc_id for r in after} == {i for i, s in share.items() if s <= 0.5}
    assert not any(brute_spans(items, r.text, 10)[1] for r in after)
    _, before, after, _ = kept[4]
    totals, taken = Counter(), Counter()
    for r in before:
        totals[r[3]] += len(SPACED.findall(r[1]))
    for r in after:
        taken[r.source] += len(SPACED.findall(r.text))
    for s, aim in plain_targets(totals).items():
        assert abs(taken[s] - aim) <= max(len(SPACED.findall(r[1])) for r in before if r[3] == s)


def test_the_pipeline_runs(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.agg(F.max("copy")).first()[0] <= 2 and result.count() > 50


def test_the_stages_take_awkward_and_empty_tables(spark):
    for rows in (awkward(), []):
        docs = table(spark, rows)
        for name, stage in stages.STAGES:
            before, docs = [tuple(r) for r in docs.collect()], stage(spark, docs, SF_DIR)
            after = docs.collect()
            assert len(after) <= 2 * len(before) and {r.doc_id for r in after} <= {r[0] for r in before}
            docs = spark.createDataFrame([tuple(r)[:5] for r in after], table(spark, []).schema)
