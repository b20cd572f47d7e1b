"""URL filter: association rules mined by FP-growth behind fixed host rules, in DataFrame functions only.

A url is a set of tokens: its scheme, the words of its host and the host's suffixes, all parts of its path, and the names in
its query. Urls that a fixed rule blocks carry the label ``block``. FP-growth finds the token combinations that are
frequent among all urls, with and without the label. Confidence is the share of blocked urls among all urls that have the
tokens, judged or not: taken among the judged ones alone it would spread a rule for one path over its whole host.
Combinations with enough support and confidence become rules, unless a part of them is as sure. Tokens that stand in exactly
the same urls, as those of one host do, are one token to the rules, the first of them in order: else each of them would double
the number of frequent combinations. Each rule is filed in an inverted index under its least frequent token only. A url no fixed rule judges
meets the rules filed under one of its tokens, a match is a rule whose tokens it all has, and the most confident match
blocks it; without a match it is allowed.

Frequent tokens, as those of a host with a third of all urls, are never the least frequent of a rule that has another
token; the rules are few (``MIN_SUPPORT`` bounds them) and are joined by their token.

Defined cases: a null url, or one without ``://``, has an empty host and path, and is judged by its other tokens (none: it
is allowed); without labelled urls nothing is mined; repeated urls are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_once

#: (host, path, verdict); the longest fitting one decides.
HOST_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9

_LABEL = "=block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?`` or ``#``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def fixed_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """The fitting rule, as host and path, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for of, start, says in sorted(HOST_RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule, verdict = F.when(fits, of + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url, each marked with where it stands."""
    scheme = F.regexp_extract(F.coalesce(url, F.lit("")), "^([a-zA-Z]+)://", 1)
    labels = F.filter(F.split(host, "[.]"), lambda x: x != "")
    words = F.flatten(F.transform(labels, lambda x: F.split(x, "-")))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
        lambda k: F.array_join(F.slice(labels, k, F.greatest(F.size(labels), F.lit(1))), "."),
    )
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit("[?&]([^=&#]+)"), F.lit(1))
    marked = [
        F.when(scheme != "", F.array(F.concat(F.lit("scheme:"), scheme))).otherwise(F.array().cast("array<string>")),
        F.transform(words, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.filter(suffixes, lambda x: x != ""), lambda x: F.concat(F.lit("under:"), x)),
        F.transform(parts, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(names, lambda x: F.concat(F.lit("query:"), x)),
    ]
    return F.array_distinct(F.concat(*marked))


def _first_of_equals(each: DataFrame, least: float) -> DataFrame:
    """Of the tokens that stand in exactly the same rows, ``least`` or more, the first one. Rows are told by two hashes."""
    cover = each.filter("token IS NOT NULL").groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")
    )
    return cover.filter(F.col("n") >= least).groupBy("n", "x", "y").agg(F.min("token").alias("token")).select("token")


def mine(rows: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from all rows, with ``tokens`` and ``verdict``: ``rule`` (sorted tokens), ``confidence``, ``support``, ``filed``."""
    rows = write_once(rows.select(F.monotonically_increasing_id().alias("row"), "tokens", "verdict"), "url-tokens")
    each = rows.select("row", "verdict", F.explode_outer("tokens").alias("token"))
    first = write_once(_first_of_equals(each, min_support * rows.count()), "url-first-tokens")
    # Each of them has a share of the urls, so their number is bounded by a url's tokens over the support.
    kept = each.join(F.broadcast(first.withColumn("_first", F.lit(True))), "token", "left")
    baskets = kept.groupBy("row", "verdict").agg(F.collect_set(F.when(F.col("_first"), F.col("token"))).alias("tokens"))
    items = F.when(F.col("verdict") == "block", F.concat("tokens", F.array(F.lit(_LABEL)))).otherwise(F.col("tokens"))
    baskets = write_once(baskets.select(items.alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    sets = write_once(model.freqItemsets, "frequent-items")
    found = sets.filter(F.array_contains("items", _LABEL) & (F.size("items") > 1))
    found = found.select(F.sort_array(F.array_remove("items", _LABEL)).alias("rule"), F.col("freq").alias("support"))
    whole = sets.select(F.sort_array("items").alias("rule"), F.col("freq").alias("whole"))
    rules = found.join(whole, "rule").withColumn("confidence", F.col("support") / F.col("whole"))
    rules = write_once(rules.filter(F.col("confidence") >= min_confidence), "mined-rules")
    single = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), F.col("freq").alias("uses"))
    rarest = rules.select("rule", F.explode("rule").alias("token")).join(single, "token")
    rarest = rarest.groupBy("rule").agg(F.min(F.struct("uses", "token"))["token"].alias("filed"))
    rules = write_once(rules.select("rule", "confidence", "support").join(rarest, "rule"), "filed-rules")
    # A longer rule that is no surer than one of its parts says nothing new; it has the token its part is filed under.
    shorter = rules.select(F.col("filed").alias("token"), F.col("rule").alias("part"), F.col("confidence").alias("sure"))
    longer = rules.select("rule", "confidence", F.explode("rule").alias("token")).join(shorter, "token")
    longer = longer.filter((F.size("rule") > F.size("part")) & (F.size(F.array_except("part", "rule")) == 0) & (F.col("sure") >= F.col("confidence")))
    return rules.join(longer.select("rule").distinct(), "rule", "left_anti")


def judge_urls(pages: DataFrame, url: str = "url", key: str = "page_id", **options) -> DataFrame:
    """``key``, ``url``, ``host``, ``path``, ``rule``, ``verdict`` and ``mined`` (the tokens of the rule that blocks)."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    rows = write_once(rows, "urls")
    if rows.filter("verdict = 'block'").isEmpty():
        return rows.select("key", "url", "host", "path", "rule", F.lit("allow").alias("verdict"), F.lit(None).cast("string").alias("mined"))
    rules = write_once(mine(rows.select("tokens", "verdict"), **options), "rules")
    open_urls = rows.filter("verdict IS NULL").select("url", "tokens").distinct()
    met = open_urls.select("url", "tokens", F.explode("tokens").alias("filed")).join(rules, "filed")
    met = met.filter(F.size(F.array_except("rule", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_join("rule", " ").alias("mined")))["mined"]
    blocked = met.groupBy("url").agg(best.alias("mined")).withColumnRenamed("url", "_url")
    joined = rows.join(blocked, F.col("verdict").isNull() & (F.col("url") == F.col("_url")), "left")
    mined_verdict = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return joined.select("key", "url", "host", "path", "rule", F.coalesce("verdict", mined_verdict).alias("verdict"), "mined")
