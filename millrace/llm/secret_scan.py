"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three fixed kinds are always reported: values assigned to a telling name, access keys, and long hexadecimal runs. Further
candidates are only as good as their spread: a value that many owners or repositories hold is an example that people copy,
one that stays with its owner looks live. For the hash of every candidate in the corpus the distinct owners and
repositories are counted (partial sums per task, so a value that a third of the rows hold costs nothing extra), and the
candidates of the further kinds are added where the value is owned: at most ``MAX_OWNERS`` owners and ``MAX_REPOSITORIES``
repositories hold it, counted over all kinds.

Positions are in code points, ends exclusive. Matches of a kind are leftmost and do not overlap; their positions are
running sums of the lengths of the matches and of the pieces between them, taken over rows, so that the work grows with the
number of matches even if one text has very many.

Defined cases: a null text has no spans; a null owner or repository is not counted, so a value held by such rows alone is
owned; repeated rows have equal spans and do not count twice; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_once


@dataclass(frozen=True)
class Kind:
    """``quick`` finds no less than ``pattern``; ``group`` of a match is the value, of at least ``least`` characters."""

    name: str
    pattern: str
    quick: str
    least: int
    group: int = 0
    mixed: bool = False


_NAME = "[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]"
BASE = (
    Kind("assign", rf"""({_NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", rf"""({_NAME})["']?\x20*[:=]""", 6, 2),
    Kind("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16}", 20),
    Kind("hex", "[0-9a-f]{24,}", "[0-9a-f]{24}", 24),
)
#: Spans of these kinds are added where their value is owned and no fixed span holds them.
FURTHER = (
    Kind("login", r"""://[^\x00-\x20/:@"'<>]+:([^\x00-\x20/:@"'<>]+)@""", "://[^\x00-\x20/:@]+:[^\x00-\x20/:@]", 6, 1),
    Kind("literal", "[A-Za-z0-9+/_=-]{20,}", "[A-Za-z0-9+/_=-]{20}", 20, mixed=True),
)
KINDS = BASE + FURTHER
MAX_OWNERS = 2
MAX_REPOSITORIES = 20


def _parts(text: Column, kind: Kind) -> Column:
    """Matches of a kind in order: the length of what is before each, its own length, and its value. No part of it is
    computed more than once for a text."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    before = F.transform(F.split(text, kind.pattern, -1), F.length)
    parts = F.arrays_zip(before.alias("before"), F.transform(matches, F.length).alias("size"), values.alias("value"))
    none = F.array().cast("array<struct<before:int,size:int,value:string>>")
    return F.when(text.rlike(kind.quick), parts).otherwise(none)


def _spans(rows: DataFrame) -> DataFrame:
    """A row for each span: ``row, start, kind, end, value``. Positions are running sums over a text's matches of a kind."""
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k.name).alias("parts")) for i, k in enumerate(KINDS)])
    some = rows.filter(" OR ".join(f"size({k.name}) > 0" for k in KINDS)).select("row", F.explode(kinds).alias("of"))
    each = some.select("row", "of.kind", F.posexplode("of.parts").alias("k", "part")).select("row", "kind", "k", "part.*")
    so_far = Window.partitionBy("row", "kind").orderBy("k")
    end = F.sum(F.col("before") + F.coalesce("size", F.lit(0))).over(so_far)
    placed = each.withColumn("end", end.cast("int")).filter("size IS NOT NULL")  # behind the last match is no other
    fits, mixed = F.lit(False), F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    for i, kind in enumerate(KINDS):
        fits |= (F.col("kind") == i) & (F.length("value") >= kind.least) & (mixed if kind.mixed else F.lit(True))
    return placed.filter(fits).select("row", (F.col("end") - F.col("size")).alias("start"), "kind", "end", "value")


def _named(spans: Column) -> Column:
    """``kind:start:end`` of each span, by start and kind."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def _of_kinds(spans: str | Column, first: int, after: int) -> Column:
    return F.filter(spans, lambda s: (s["kind"] >= first) & (s["kind"] < after))


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    owner: str = "source",
    repository: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, counts of the fixed kinds, ``base`` and ``spans`` as text, ``n_owned``.

    ``n_owned`` counts the spans, of any kind, whose value is owned.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        *[_parts(content, kind).alias(kind.name) for kind in KINDS],
    )
    rows = write_once(rows, "secret-matches")
    # A further span lies in a fixed one if a fixed one that starts no later ends no earlier.
    up_to = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("kind") < len(BASE), F.col("end"))).over(up_to)
    spans = _spans(rows).withColumn("_reach", reach).filter((F.col("kind") < len(BASE)) | F.col("_reach").isNull() | (F.col("_reach") < F.col("end")))
    spans = write_once(spans.select("row", "start", "kind", "end", F.xxhash64("value").alias("hash")), "secret-spans")

    held = spans.join(rows.select("row", "owner", "repository"), "row")
    spread = held.groupBy("hash").agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories"))
    owned = spread.filter((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).select("hash", F.lit(True).alias("live"))
    span = F.struct("start", "kind", "end")
    listed = spans.join(owned, "hash", "left").groupBy("row").agg(
        F.collect_list(F.when(F.col("kind") < len(BASE), span)).alias("fixed"), F.collect_list(F.when(F.col("live"), span)).alias("owned")
    )
    joined = rows.select("row", "doc_id").join(listed, "row", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = joined.select("doc_id", F.coalesce("fixed", none).alias("fixed"), F.coalesce("owned", none).alias("owned"))

    counts = [F.size(_of_kinds("fixed", i, i + 1)).cast("long").alias(f"n_{k.name}") for i, k in enumerate(BASE)]
    spans = F.concat("fixed", _of_kinds("owned", len(BASE), len(KINDS)))
    n_owned = F.size("owned").cast("long")
    return joined.select("doc_id", *counts, _named(F.col("fixed")).alias("base"), _named(spans).alias("spans"), n_owned.alias("n_owned"))
