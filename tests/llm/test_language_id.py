from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id
from millrace.llm.batches import Texts
from tests.llm.texts import DOCUMENTS, awkward, clashing, table


def speech(seed=0, n=400):
    r = random.Random(seed)
    parts = {"en": ["th", "ing", "er", "wh", "ly", "ou", "tion"], "fr": ["é", "que", "eau", "oi", "ch", "è", "ent"], "de": ["sch", "ung", "ü", "ß", "ei", "ver", "z"]}
    rows = []
    for i in range(n):
        lang = r.choice(list(parts))
        words = ["".join(r.choice(parts[lang]) for _ in range(r.choice([1, 2, 3]))) for _ in range(r.choice([3, 20, 60]))]
        rows.append((i, " ".join(words).capitalize() + ". 12 #", lang, "a", 0))
    return rows


@pytest.fixture(scope="module")
def models(spark):
    docs = spark.createDataFrame(speech(), DOCUMENTS)
    return language_id.train(docs, F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1)


def plain_model(texts, order):
    """Kneser-Ney by dictionaries, over words with their spaces."""
    counts = [None, *({} for _ in range(order))]
    grams = Counter()
    for text in texts:
        for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
            padded = "\0" * (order - 2) + f" {word} "
            grams.update(padded[i - order + 1 : i + 1] for i in range(order - 1, len(padded)))
    counts[order] = dict(grams)
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    stats = [None]
    for n in range(1, order + 1):
        once, twice = (sum(c == k for c in counts[n].values()) for k in (1, 2))
        d = min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.95)
        total, kinds = Counter(), Counter()
        for g, c in counts[n].items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        stats.append((d, total, kinds))

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / 4096
        d, total, kinds = stats[n]
        if gram[:-1] not in total:
            return p(gram[1:])
        t = total[gram[:-1]]
        return max(counts[n].get(gram, 0) - d, 0) / t + d * kinds[gram[:-1]] / t * p(gram[1:])

    def cross_entropy(text):
        bits, n = 0.0, 0
        for word in "".join(c.lower() if c.isalpha() else " " for c in text).split():
            padded = "\0" * (order - 2) + f" {word} "
            for i in range(order - 1, len(padded)):
                bits, n = bits - log2(p(padded[i - order + 1 : i + 1])), n + 1
        return bits / n

    return cross_entropy


def test_cross_entropy_equals_a_plain_kneser_ney_model(models):
    rows = speech()
    texts = [r[1] for r in rows[:40]] + ["Völlig anders, xyz!", "a", "é è"]
    bits, letters = language_id.add_bits(Texts.of(pa.array(texts)), models.low | models.high, len(models.languages))
    bits /= letters[:, None]
    for number, language in enumerate(models.languages):
        plain = plain_model([r[1] for r in rows if r[0] % 2 == 0 and r[2] == language], language_id.ORDER)
        np.testing.assert_allclose(bits[:, number], [plain(t) for t in texts], rtol=1e-4)


ASIAN = {
    "zh": "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年",
    "ja": "のにはをたがでてとしれさあいるからなものこそうよひらカタナ日本語",
    "te": "అఆఇఈఉకఖగఘచఛజటడతదధనపబభమయరలవశసహ",
}


def asian(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice(list(ASIAN))
        rows.append((i, "，".join("".join(r.choice(ASIAN[lang]) for _ in range(r.choice([2, 7, 30]))) for _ in range(8)), lang, "a", 0))
    return rows


def test_many_shards_equal_the_plain_model_in_scripts_of_many_letters(spark):
    rows = asian(1, 60) + [(100 + r[0], *r[1:]) for r in speech(seed=2, n=60)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    models = language_id.train(docs, F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1, shard_cells=5_000)
    assert models.shards > 3 and models.languages == ["de", "en", "fr", "ja", "te", "zh"]
    held = asian(9, 12) + [(100 + r[0], *r[1:]) for r in speech(seed=8, n=12)] + [(300, "中国 అఆ a", "zh", "a", 0), (301, "", "zh", "a", 0)]
    docs, columns, _ = language_id._bits(table(spark, held), models, "text")
    got = {r.doc_id: r for r in docs.select("doc_id", *columns).collect()}
    for number, language in enumerate(models.languages):
        plain = plain_model([r[1] for r in rows if r[0] % 2 == 0 and r[2] == language], language_id.ORDER)
        for r in held[:-1]:
            assert got[r[0]]["_bits"][number] / got[r[0]]["_letters"] == pytest.approx(plain(r[1]), rel=1e-4)
    named = {r.doc_id: r.lang_pred for r in language_id.identify(table(spark, held), models, keep=["doc_id"]).collect()}
    assert all(named[r[0]] == r[2] for r in held[:24]) and named[301] == "und"
    one = language_id.train(spark.createDataFrame(rows, DOCUMENTS), F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1)
    assert one.shards == 1
    assert {r.doc_id: r.lang_pred for r in language_id.identify(table(spark, held), one, keep=["doc_id"]).collect()} == named


def test_held_out_accuracy_and_rejection(spark, models):
    rows = speech(seed=5, n=200)
    rows += [(900, "qjxk vvvk qqqj xkkq wjqx " * 9, None, "a", 0), (901, "12 34 !", "en", "a", 0), (902, None, None, None, None)]
    got = {r.doc_id: r for r in language_id.identify(clashing(table(spark, rows)), models).collect()}
    assert np.mean([got[r[0]].lang_pred == r[2] for r in rows[:200]]) > 0.97
    assert all(got[i].accepted for i in range(200)) and not got[900].accepted
    for i in (901, 902):
        assert (got[i].lang_pred, got[i].score, got[i].accepted, got[i].cross_entropy) == ("und", 0.0, False, None)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[900].lang_pred in models.languages


def test_rejected_rows_go(spark, models):
    rows = [*speech(seed=6, n=30), (900, "qjxk vvvk qqqj xkkq wjqx " * 9, None, "a", 0), (901, "", "en", "a", 0)]
    docs = clashing(table(spark, rows))
    left = language_id.keep_languages(docs, models)
    assert left.columns == docs.columns
    assert sorted(tuple(r)[:5] for r in left.collect()) == sorted(rows[:30])


def test_without_labels_everything_is_undetermined(spark):
    docs = table(spark, [(i, t, None, s, n) for i, t, _, s, n in awkward()])
    models = language_id.train(docs, F.lit(True), F.lit(True))
    assert {(r.lang_pred, r.accepted) for r in language_id.identify(docs, models).collect()} == {("und", False)}
    assert language_id.identify(table(spark, []), models).count() == 0


def test_one_language_only(spark):
    docs = table(spark, [(i, t, "en", s, n) for i, t, _, s, n in awkward()])
    models = language_id.train(docs, F.lit(True), F.lit(True))
    named = defaultdict(int)
    for r in language_id.identify(docs, models).collect():
        named[r.lang_pred] += 1
    assert set(named) == {"en", "und"} and named["und"] == 4


def plain_logistic(x, right):
    x, y = np.concatenate([x, [0.0, 0.0]]), np.concatenate([right, [True, False]]).astype(float)
    weights, design = np.zeros(2), np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        spread = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, 1e-6])
        weights += np.clip(np.linalg.solve(spread, design.T @ (y - p) - 1e-6 * weights), -5, 5)
    return weights


def test_all_labelled_rows_calibrate(spark):
    r, short = random.Random(3), ["th", "ing", "er", "que", "eau", "oi"]
    rows = speech() + [(1001 + 2 * i, " ".join(r.choices(short, k=r.randrange(1, 9))), r.choice(["en", "fr"]), "a", 0) for i in range(24_000)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(6)
    models = language_id.train(docs, F.col("doc_id") % 2 == 0, F.col("doc_id") % 2 == 1)
    judged = language_id._judged(docs.filter("doc_id % 2 = 1"), models, "text", ["lang"]).toPandas()
    assert len(judged) > 24_000
    right = (judged["_best"].map(dict(enumerate(models.languages))) == judged["lang"]).to_numpy()
    root = np.sqrt(judged["_letters"].to_numpy())
    np.testing.assert_allclose([models.slope, models.offset], plain_logistic(judged["_lead"].to_numpy() * root, right), rtol=1e-8)
    for i in range(len(models.languages)):
        excess = (judged["_bits"] - 4 / root)[(judged["_best"] == i) & right]
        assert models.limits[i] == pytest.approx(np.quantile(excess, language_id.PASS_SHARE) + language_id.SLACK, rel=1e-12)


@pytest.mark.parametrize("n", [1, 2, 7, 1001, 3000])
def test_quantiles_are_exact(spark, n):
    r = random.Random(n)
    values = [(k, r.choice([r.gauss(0, 3), 1.25])) for k in (0, 1) for _ in range(n)]
    got = language_id._quantiles(spark.createDataFrame(values, "k long, v double"), "k", "v", 0.999).collect()
    assert {x.k: pytest.approx(x.value, rel=1e-12) for x in got} == {k: np.quantile([v for i, v in values if i == k], 0.999) for k in (0, 1)}
