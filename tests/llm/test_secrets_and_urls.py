from __future__ import annotations

import re
from collections import Counter

import pytest

from millrace.llm import secret_scan, url_filter
from tests.llm.texts import awkward, clashing, table

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
HEX = "0123456789abcdef" * 3
SPOTS = [
    "",
    "token=ab token:abcdef Password = 'x.y_z/1' passwd==6characters",
    "token=token:abcdefgh API_KEY: \"Zq1\" apikey:Zq1234 secret=\u212aabcdefg to\u212aen=abcdefgh",
    f"é🙂 {HEX} {HEX[:23]} {HEX[:24]}g AKIA{'A' * 16} AKIA{'B' * 15} AKIAAKIA{'C' * 12}",
    f"SeCrEt:{HEX}",
    "password:\n123456 password:\t123456 password  :  123456789",
    f"https://user:hunter22@host.net/ and xQ9{'aB3' * 9} {'x' * 30}",
]


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(found)


def written(spans):
    return ",".join(f"{('assign', 'access', 'hex')[kind]}:{start}:{end}" for start, kind, end in spans)


def test_fixed_kinds_equal_a_plain_search(spark):
    rows = [(100 + i, t, "en", "a", 0) for i, t in enumerate(SPOTS)] + awkward() + [(7, SPOTS[3], "en", None, 0), (None, SPOTS[1], "en", "a", 0)]
    got = secret_scan.find_secrets(clashing(table(spark, rows))).collect()
    wanted = Counter()
    for r in rows:
        spans = base(r[1])
        wanted[r[0], *(sum(k == kind for _, k, _ in spans) for kind in range(3)), written(spans)] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base) for r in got) == wanted
    for r in got:
        assert set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))


def test_further_kinds_are_added_where_owned(spark):
    own, shared = "xQ9" + "aB3" * 9, "Zz1" * 9
    rows = [(i, f"see {shared} here", "en", f"s{i}", 0) for i in range(6)]
    rows += [(10, f"mine {own} https://me:hunter22@x/", "en", "s1", 0), (11, f"token={own}", "en", "s1", 0), (12, f"mine {own}", "en", "s1", 0)]
    rows += [rows[6], (None, f"lost {'kK9' * 8}", "en", None, 0)]
    got = {}
    for r in secret_scan.find_secrets(table(spark, rows)).collect():
        assert got.setdefault(r.doc_id, (r.spans, r.n_owned)) == (r.spans, r.n_owned)
    assert [got[i] for i in range(6)] == [("", 0)] * 6
    assert got[10] == ("literal:5:35,login:41:56", 2) and got[11] == (f"assign:0:{6 + len(own)}", 1) and got[12] == ("literal:5:35", 1)
    assert got[None] == ("literal:5:29", 1)


def test_a_value_many_repositories_hold_is_an_example(spark):
    value = "Ab1" * 8
    rows = [(i, f"copy {value}", "en", "one", 0) for i in range(30)]
    assert {r.spans for r in secret_scan.find_secrets(table(spark, rows)).collect()} == {""}
    assert {r.n_owned for r in secret_scan.find_secrets(table(spark, rows), max_repositories=40).collect()} == {1}
    assert secret_scan.find_secrets(table(spark, [])).count() == 0


PAGES = "page_id long, url string, html string"


def judged(text):
    """Host, path and rule of a url, read by hand."""
    rest = (text or "").partition("://")
    rest = rest[2] if rest[1] else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


URLS = [
    "http://a.net/x", "https://NET/", "http://example.net/en/1?q=://x/", "http://m.example.net/en", "http://example.com/de/#a", "http://notexample.com/de/1",
    "http://x.org/fr/", "http://x.org/fr", "http://a.net", "http://a.net?x=/", "no scheme", "", None, "://net/", "http://É.org/fr/é", "ftp://b.net#/", "a://b://net/",
]


def test_hosts_paths_and_fixed_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, URLS[2], "x")]
    got = url_filter.judge_urls(table(spark, rows, PAGES)).collect()
    assert Counter((r.key, r.host, r.path, r.rule) for r in got) == Counter((i, *judged(u)[:2], judged(u)[2][0]) for i, u, _ in rows)
    for r in got:
        assert r.verdict == (judged(r.url)[2][1] or "allow")


def test_mined_rules_block_what_they_are_sure_of(spark):
    rows = [(i, f"https://shop{i}.example.com/de/cheap-{i}?pills=1", None) for i in range(60)]
    rows += [(100 + i, f"https://shop{i}.example.com/en/cheap-{i}?pills=1", None) for i in range(3)]
    rows += [(200 + i, f"https://news{i}.example.com/en/{i}", None) for i in range(80)]
    docs = table(spark, rows, PAGES)
    got = {r.key: r for r in url_filter.judge_urls(docs).collect()}
    assert len(got) == len(rows)
    assert {got[i].verdict for i in range(60)} == {"block"} and {got[200 + i].verdict for i in range(80)} == {"allow"}
    assert {(got[100 + i].verdict, got[100 + i].mined, got[100 + i].rule) for i in range(3)} == {("block", "query:pills", None)}
    assert {r.verdict for r in url_filter.judge_urls(docs, min_confidence=0.99).collect() if r.key >= 100} == {"allow"}


def brute_rules(baskets, support, confidence, most):
    """Combinations of up to ``most`` tokens with their confidence, without those no surer than a part."""
    from itertools import combinations

    seen, blocked = Counter(), Counter()
    for tokens, block in baskets:
        for n in range(1, most + 1):
            for c in combinations(sorted(tokens), n):
                seen[c] += 1
                blocked[c] += block
    sure = {c: blocked[c] / seen[c] for c in seen if blocked[c] >= support * len(baskets) and blocked[c] and blocked[c] / seen[c] >= confidence}
    return {c: p for c, p in sure.items() if not any(set(o) < set(c) and q >= p for o, q in sure.items())}


def test_rules_equal_counting_all_combinations(spark):
    import random

    r = random.Random(6)
    baskets = []
    for _ in range(300):
        tokens = {x for x in "abcdef" if r.random() < 0.4}
        baskets.append((sorted(tokens), bool(tokens >= {"a", "b"} or ("c" in tokens and r.random() < 0.85))))
    rows = spark.createDataFrame([(t, "block" if b else None) for t, b in baskets], "tokens array<string>, verdict string")
    got = {tuple(x.rule): x.confidence for x in url_filter.mine(rows, 0.02, 0.8).collect()}
    assert got == pytest.approx(brute_rules(baskets, 0.02, 0.8, 6))


def test_rules_of_four_tokens_are_kept(spark):
    import random

    r = random.Random(3)
    sets = [sorted(x for x in "abcd" if r.random() < 0.7) for _ in range(400)]
    rows = spark.createDataFrame([(t, "block" if len(t) == 4 else None) for t in sets], "tokens array<string>, verdict string")
    assert [(x.rule, x.confidence) for x in url_filter.mine(rows, 0.02, 0.8).collect()] == [(["a", "b", "c", "d"], 1.0)]


def test_a_third_part_of_the_path_blocks(spark):
    rows = [(i, f"https://shop{i}.example.com/de/a{i}/pills/{i}", None) for i in range(60)]
    rows += [(100 + i, f"https://news{i}.example.com/en/b{i}/pills/{i}", None) for i in range(3)]
    rows += [(200 + i, f"https://news{i}.example.com/en/c{i}/text/{i}", None) for i in range(80)]
    got = {r.key: (r.verdict, r.mined) for r in url_filter.judge_urls(table(spark, rows, PAGES)).collect()}
    assert {got[100 + i] for i in range(3)} == {("block", "path:pills")} and {got[200 + i][0] for i in range(80)} == {"allow"}


def test_tokens_that_stand_together_do_not_multiply_the_rules(spark):
    shared = "/".join(f"p{j}" for j in range(25))
    rows = [(i, f"https://a.b.shop{i}.example.com/{'de' if i < 70 else 'en'}/{shared}/{i}", None) for i in range(75)]
    rows += [(200 + i, f"https://news{i}.example.com/en/{i}", None) for i in range(75)]
    got = {r.key: (r.verdict, r.mined) for r in url_filter.judge_urls(table(spark, rows, PAGES)).collect()}
    assert {got[i] for i in range(70, 75)} == {("block", "host:a")}  # sure at 70 of 75, and the first of its equals
    assert {got[200 + i][0] for i in range(75)} == {"allow"}


def test_many_matches_in_one_text(spark):
    hexes = " ".join(f"{i:024x}" for i in range(100_000))
    text = f"{hexes} token=abcdef0 https://me:hunter22@x/ {'aB3' * 9}"
    got = secret_scan.find_secrets(table(spark, [(1, text, "en", "a", 0), (2, "x", "en", "a", 0)])).collect()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].base == written(base(text)) and (by_id[1].n_hex, by_id[1].n_assign) == (100_000, 1)
    assert by_id[1].n_owned == 100_003 and by_id[2].spans == ""


def test_no_urls(spark):
    assert url_filter.judge_urls(table(spark, [], PAGES)).count() == 0
