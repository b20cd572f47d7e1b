"""SQL counterparts of the operators that SQL can express, over the same tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item AS (
    SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS size, words[k:k + least(10, len(words)) - 1] AS gram
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM item WHERE len(words) > 0)
), grams AS (
    SELECT doc_id, k, s.size, words[k:k + s.size - 1] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS k FROM doc) d, (SELECT DISTINCT size FROM windows) s
    WHERE k + s.size - 1 <= len(words)
), hits AS (
    SELECT doc_id, k, size, item_id FROM grams JOIN windows USING (size, gram)
), places AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_NAME = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
#: kind, pattern, group of the value, its least length, a condition on it
_KINDS = (
    ("assign", rf"""({_NAME})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "true"),
    ("access", "AKIA[A-Z0-9]+", 0, 20, "true"),
    ("hex", "[0-9a-f]{24,}", 0, 24, "true"),
    ("login", r"""://[^\x00-\x20/:@"''<>]+:([^\x00-\x20/:@"''<>]+)@""", 1, 6, "true"),
    (
        "literal",
        "[A-Za-z0-9+/_=-]{20,}",
        0,
        20,
        "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')",
    ),
)


def _found(number: int) -> str:
    kind, pattern, group, least, condition = _KINDS[number]
    return f"""
    SELECT doc_id, source, {number} AS kind, '{kind}' AS name, place, place + len(match) AS till, value FROM (
        SELECT doc_id, source, matches[k] AS match, found[k] AS value,
            list_sum(list_transform(pieces[1:k], lambda x: len(x))) + coalesce(list_sum(list_transform(matches[1:k - 1], lambda x: len(x))), 0) AS place
        FROM (
            SELECT doc_id, source, regexp_extract_all(text, '{pattern}') AS matches, regexp_extract_all(text, '{pattern}', {group}) AS found,
                string_split_regex(text, '{pattern}') AS pieces, unnest(range(1, len(regexp_extract_all(text, '{pattern}')) + 1)) AS k
            FROM documents WHERE regexp_matches(text, '{pattern}')
        )
    ) WHERE len(value) >= {least} AND {condition}
    """


OP5 = f"""
WITH spans AS (
    {" UNION ALL ".join(_found(i) for i in range(len(_KINDS)))}
), counted AS (
    SELECT * FROM spans s WHERE kind < 3 OR NOT EXISTS (
        SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.kind < 3 AND b.place <= s.place AND s.till <= b.till
    )
), owned AS (
    SELECT value FROM counted GROUP BY value HAVING count(DISTINCT source) <= 2 AND count(DISTINCT doc_id) <= 20
), listed AS (
    SELECT *, value IN (SELECT value FROM owned) AS live, name || ':' || CAST(place AS BIGINT) || ':' || CAST(till AS BIGINT) AS written FROM counted
), per_doc AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
        count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg(written, ',' ORDER BY place, kind) FILTER (WHERE kind < 3) AS base,
        string_agg(written, ',' ORDER BY place, kind) FILTER (WHERE kind < 3 OR live) AS spans, count(*) FILTER (WHERE live) AS n_owned
    FROM listed GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(p.spans, '') AS spans, coalesce(n_owned, 0) AS n_owned
FROM documents LEFT JOIN per_doc p USING (doc_id)
"""

def _linked(size: int) -> str:
    """Documents, their set sizes and the classes of those that share 80 % of their shingles of ``size`` words."""
    return rf"""
WITH RECURSIVE doc AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents
), shingle AS MATERIALIZED (
    SELECT DISTINCT doc_id, hash(words[k:least(k + {size - 1}, len(words))]) AS gram
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {size - 1}, 1) + 1)) AS k FROM doc WHERE len(words) > 0)
), sized AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM shingle a JOIN shingle b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * same >= 80 * (x.n + y.n - same)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
), linked AS (
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents d LEFT JOIN sized USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
)
"""


OP9 = _linked(5) + "SELECT doc_id, n_shingles, component_id FROM linked"

OP12 = _linked(2) + "SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM linked"

OP11 = rf"""
WITH doc AS MATERIALIZED (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), used AS MATERIALIZED (
    SELECT id, lang, source, term, count(*) AS uses FROM (SELECT id, lang, source, unnest(words) AS term FROM doc) GROUP BY ALL
), kept AS MATERIALIZED (
    SELECT lang, term, CAST(sum(uses) AS HUGEINT) AS uses FROM used GROUP BY lang, term HAVING count(*) >= 10
), vocabulary AS (
    SELECT lang, count(*) AS v, sum(uses) AS n FROM kept GROUP BY lang
), grp AS MATERIALIZED (
    SELECT DISTINCT lang, source FROM doc
), own AS MATERIALIZED (
    SELECT lang, source, term, CAST(sum(u.uses) AS HUGEINT) AS uses FROM used u JOIN kept k USING (lang, term) GROUP BY ALL
), total AS (
    SELECT lang, source, coalesce(sum(uses), 0) AS n FROM grp LEFT JOIN own USING (lang, source) GROUP BY ALL
), p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(o.uses, 0) AS uses,
        CAST(1 + (1000000000 * (coalesce(o.uses, 0) + 2)) // (t.n + 2 * v.v) AS HUGEINT) AS p,
        CAST(1 + (1000000000 * (k.uses + 2)) // (v.n + 2 * v.v) AS HUGEINT) AS q
    FROM grp g JOIN total t USING (lang, source) JOIN vocabulary v USING (lang) JOIN kept k USING (lang)
    LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), pair AS (
    SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
    FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
    FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE uses > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""

#: crc32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, c: list_reduce(list_prepend(xor(x, c), CAST(range(8) AS BIGINT[])), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))))"""


def _hashed(text: str) -> str:
    """sha256 of a row with this text."""
    pieces = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(pieces)})"


#: Levels of a tree that the SQL has, for up to 16 ** 6 leaves or sources.
_DEPTH = 6


def _merkle() -> str:
    """Trees per source (``s``), and a tree of their roots, level by level; then the way of each document up both."""
    altered = _LOWER.format("text")
    parts = [
        f"""leaf AS MATERIALIZED (
    SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
        count(*) OVER (PARTITION BY source) AS n, leaf, claimed
    FROM (SELECT *, {_hashed("text")} AS leaf, CASE WHEN {_CRC.format("doc_id")} % 5 = 0 THEN {_hashed(altered)} ELSE {_hashed("text")} END AS claimed FROM documents)
), a0 AS (SELECT s, place, n, leaf AS node FROM leaf)"""
    ]
    for tree, start in (("a", None), ("b", "b0")):
        if start:
            roots = " UNION ALL ".join(f"SELECT s AS place, node FROM a{i} WHERE n = 1" for i in range(_DEPTH + 1))
            parts.append(f"b0 AS MATERIALIZED (SELECT 0 AS s, place, count(*) OVER () AS n, node FROM ({roots}))")
        for i in range(_DEPTH):
            parts.append(f"{tree}r{i} AS MATERIALIZED (SELECT s, place // 16 AS run, (n + 15) // 16 AS n, list(node ORDER BY place) AS nodes FROM {tree}{i} WHERE n > 1 GROUP BY ALL)")
            parts.append(f"{tree}{i + 1} AS MATERIALIZED (SELECT s, run AS place, n, sha256(array_to_string(nodes, '')) AS node FROM {tree}r{i})")
    roots = " UNION ALL ".join(f"SELECT node FROM b{i} WHERE n = 1" for i in range(_DEPTH + 1))
    parts.append(f"top AS MATERIALIZED (SELECT node AS root FROM ({roots}))")
    parts.append("wa0 AS (SELECT doc_id, leaf, s, place, claimed AS value, '' AS proof FROM leaf)")
    for tree in "ab":
        if tree == "b":
            roots = " UNION ALL ".join(f"SELECT s, node AS subroot FROM a{i} WHERE n = 1" for i in range(_DEPTH + 1))
            parts.append(f"wb0 AS (SELECT doc_id, leaf, subroot, 0 AS s, w.s AS place, value, proof FROM wa{_DEPTH} w JOIN ({roots}) USING (s))")
        kept = "doc_id, leaf, subroot" if tree == "b" else "doc_id, leaf"
        for i in range(_DEPTH):
            k = "CAST(place % 16 AS BIGINT)"
            parts.append(
                f"""w{tree}{i + 1} AS MATERIALIZED (
    SELECT {kept}, w.s, place // 16 AS place,
        CASE WHEN nodes IS NULL THEN value ELSE sha256(array_to_string(nodes[:{k}], '') || value || array_to_string(nodes[{k} + 2:], '')) END AS value,
        CASE WHEN nodes IS NULL THEN proof ELSE proof || array_to_string(nodes[:{k}], '') || array_to_string(nodes[{k} + 2:], '') END AS proof
    FROM w{tree}{i} w LEFT JOIN {tree}r{i} r ON r.s = w.s AND r.run = w.place // 16)"""
            )
    return "WITH " + ", ".join(parts)


OP13 = f"""{_merkle()}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, value AS folded_root, value = root AS verified FROM wb{_DEPTH}, top
"""
