"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words, and each of its documents the same expected number of copies, target over
source size. Rounding these expectations one by one would miss the target by chance. Instead two documents with a
fractional part are paired and words are shifted from one to the other, at random but so that the expectation of both
is kept, until one of the parts is 0 or 1; the other stays in the game. The words taken do not change by that, so each
group of documents ends with a single fractional document. Documents are dealt by hash to buckets of about
``BUCKET_ROWS``, whatever their source; each bucket leaves one residual per source, and the residuals meet in a
reduction tree with ``FAN_IN`` buckets to a node. Long documents are rounded first, and what their last residual misses
is made up by the shorter ones.

Defined cases: a null text has size 0; a null source is a source of its own, ordered last; documents of size 0 take no
words; repeated rows (same id, source and text) get the same number of copies; an empty table gives an empty result.
Buckets and random numbers depend on ids and texts alone: reruns agree, on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from ..session import write_once
from .batches import SPACED, Texts, Words, tidy, with_text_columns, without

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2.0
BUCKET_ROWS = 20_000
FAN_IN = 64
SEED = 20_240_517
#: Documents are rounded in strata of falling size, cut at these shares of their source's words. What the rounding of one
#: stratum misses is added to the aim of the next, so that the last residual is a small document.
STRATA = (0.01, 0.001)
#: The table of sources is broadcast up to this many rows, and joined by shuffle beyond.
BROADCAST_SOURCES = 50_000

_SIZE = StructType([StructField("size", LongType())])
_CLOSE = 1e-9


def with_size(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``size``, the number of words of the text."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"size": pa.array(Words.of(Texts.of(batch[text]), SPACED).counts, pa.int64())}

    return with_text_columns(docs, text, _SIZE, make, keep)


def source_targets(
    sized: DataFrame,
    source: str = "source",
    size: Column | str = "size",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """``source``, ``source_size`` and ``target``: ``share`` of all words dealt by weight, capped at ``max_repeats`` times
    the source's size; what exceeds a cap is dealt to the others by weight until none is above.

    Ordered by cap over weight, sources are capped up to some point; the level of the others follows from sums over that
    order. Only one row per source takes part.
    """
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("_rank", F.row_number().over(ordered) - 1)
    ranked = ranked.withColumn("_weight", F.element_at(weight, F.col("_rank") % len(weights) + 1))
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeats)))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    none = F.lit(0.0)
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), none)) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), none)
    )
    leveled = ranked.withColumn("_level", level)
    ratio = F.col("_cap") / F.col("_weight")
    fitting = F.when(F.col("_level") <= ratio, F.struct(ratio.alias("ratio"), "_rank", "_level"))
    common = F.coalesce(F.min(fitting).over(everything)["_level"], F.lit(float("inf")))
    target = F.least(F.col("_cap"), F.when(F.col("_cap") > 0, common * F.col("_weight")).otherwise(0.0))
    return leveled.withColumn("target", target).select("source", "source_size", "target")


_ROUNDED = ["_unit", "_bucket", "_source", "size", "_fraction"]


def _shift(p: float, a: float, q: float, b: float, u: float) -> tuple[float, float]:
    """New fractions of two documents with ``a`` and ``b`` words: the words taken stay, and one fraction is integral."""
    up, down = min(1 - p, q * b / a), min(p, (1 - q) * b / a)
    p, q = (p + up, q - up * a / b) if u * (up + down) < down else (p - down, q + down * a / b)
    return (p if _CLOSE < p < 1 - _CLOSE else round(p)), (q if _CLOSE < q < 1 - _CLOSE else round(q))


def _round_sorted(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and source: new fractions, and whether they are integral."""
    group, held = None, None

    def close(row, out):
        if row is not None:
            row[4] = float(row[5] < row[4]) if last else row[4]
            out.append(row)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in [*_ROUNDED, "_u"]]
        out = []
        for row in zip(*columns, strict=True):
            row = list(row)
            if (row[1], row[2]) != group:
                close(held, out)
                group, held = (row[1], row[2]), None
            if row[3] == 0 or not _CLOSE < row[4] < 1 - _CLOSE:
                row[4] = float(round(row[4]))
                out.append(row)
            elif held is None:
                held = row
            else:
                held[4], row[4] = _shift(held[4], held[3], row[4], row[3], row[5])
                pair = (held, row) if held[4] in (0, 1) else (row, held)
                out.append(pair[0])
                held = pair[1] if pair[1][4] not in (0, 1) else None
                if held is None:
                    out.append(pair[1])
        yield _batch(out, batch.schema)
    out = []
    close(held, out)
    if held is not None:
        yield _batch(out, batch.schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))[:5] if rows else [[]] * 5
    arrays = [pa.array(list(c), schema.field(n).type) for n, c in zip(_ROUNDED, columns, strict=True)]
    done = pa.array([f in (0, 1) for f in columns[4]], pa.bool_())
    return pa.RecordBatch.from_arrays([*arrays, done], names=[*_ROUNDED, "_done"])


def _round(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree: pair the documents of each bucket and source."""
    u = F.shiftrightunsigned(F.xxhash64("_unit", F.lit(seed + level)), 11) / F.lit(float(1 << 53))
    ready = (
        rows.select(*_ROUNDED, u.alias("_u"))
        .repartition("_bucket")
        .sortWithinPartitions("_bucket", "_source", F.col("size").desc(), "_unit")
    )
    fields = [rows.schema[c] for c in _ROUNDED]
    schema = StructType([StructField(f.name, f.dataType) for f in fields] + [StructField("_done", BooleanType())])
    rounded = ready.mapInArrow(tidy(lambda batches: _round_sorted(batches, last)), schema)
    return write_once(rounded, f"mix-level-{level}")


def _tree(units: DataFrame, count: int, bucket_rows: int, fan_in: int, seed: int) -> DataFrame:
    """``units`` with ``_expected`` copies rounded to ``copies``."""
    buckets = 1
    while buckets * bucket_rows < count:
        buckets *= 2
    rows = units.select(
        "_unit",
        F.pmod("_unit", F.lit(buckets)).cast("long").alias("_bucket"),
        F.xxhash64("source").alias("_source"),
        (F.col("size") * F.col("rows")).alias("size"),
        (F.col("_expected") - F.floor("_expected")).cast(DoubleType()).alias("_fraction"),
    )
    settled, level = [], 0
    while True:
        done = _round(rows, level, buckets == 1, seed)
        settled.append(done.filter("_done").select("_unit", "_fraction"))
        if buckets == 1:
            break
        buckets, level = -(-buckets // fan_in), level + 1
        rows = done.filter("NOT _done").withColumn("_bucket", F.floor(F.col("_bucket") / F.lit(fan_in)))
    fractions = settled[0]
    for more in settled[1:]:
        fractions = fractions.unionByName(more)
    copies = (F.floor("_expected") + F.col("_fraction")).cast("long")
    return units.join(fractions, "_unit").withColumn("copies", copies).drop("_fraction", "_expected")


def _by_source(rows: DataFrame, sources: DataFrame, count: int) -> DataFrame:
    """Columns of ``sources`` added to ``rows``; the table of sources is broadcast if it is small."""
    sources = sources.withColumnRenamed("source", "_of")
    small = F.broadcast(sources) if count <= BROADCAST_SOURCES else sources
    return rows.join(small, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def deal_copies(
    sized: DataFrame,
    strata: tuple[float, ...] = STRATA,
    bucket_rows: int = BUCKET_ROWS,
    fan_in: int = FAN_IN,
    seed: int = SEED,
    **aims,
) -> DataFrame:
    """``doc_id``, ``source``, ``text_key``, ``size``, ``rows``, ``source_size``, ``target`` and ``copies`` per distinct document.

    ``sized`` has the first four columns. ``rows`` says how often the document stands in the table; each of these rows
    is taken ``copies`` times.
    """
    identity = ["doc_id", "source", "text_key", "size"]
    units = sized.groupBy(*identity).agg(F.count(F.lit(1)).alias("rows"))
    units = write_once(units.withColumn("_unit", F.xxhash64(*identity)), "mix-units")
    words = F.col("size") * F.col("rows")
    targets = write_once(source_targets(units, "source", words, **aims), "mix-targets")
    sources = targets.count()
    stratum = F.lit(0)
    for share in strata:
        stratum = stratum + F.when(words <= F.col("source_size") * F.lit(share), 1).otherwise(0)
    units = write_once(_by_source(units, targets, sources).withColumn("_stratum", stratum), "mix-strata")
    counts = {r[0]: r[1] for r in units.groupBy("_stratum").count().collect()}

    left = targets.select("source", F.col("source_size").alias("_left_size"), F.col("target").alias("_left"))
    limit = F.lit(float(aims.get("max_repeats", MAX_REPEATS)))
    dealt = []
    for number in sorted(counts):
        expected = F.when(F.col("_left_size") > 0, F.col("_left") / F.col("_left_size")).otherwise(0.0)
        mine = _by_source(units.filter(F.col("_stratum") == number), left, sources)
        mine = mine.withColumn("_expected", F.greatest(F.lit(0.0), F.least(limit, expected))).drop("_left", "_left_size")
        done = write_once(_tree(mine, counts[number], bucket_rows, fan_in, seed + 100 * number), f"mix-stratum-{number}")
        dealt.append(done.drop("_unit", "_stratum"))
        if number != max(counts):
            gone = done.groupBy("source").agg(F.sum(words).alias("_gone"), F.sum(words * F.col("copies")).alias("_taken"))
            gone = gone.withColumnRenamed("source", "_of")
            left = left.join(gone, F.col("source").eqNullSafe(F.col("_of")), "left").select(
                "source",
                (F.col("_left_size") - F.coalesce("_gone", F.lit(0))).alias("_left_size"),
                (F.col("_left") - F.coalesce("_taken", F.lit(0))).alias("_left"),
            )
            left = write_once(left, f"mix-left-{number}")
    out = dealt[0] if dealt else units.withColumn("copies", F.lit(0).cast("long")).drop("_unit", "_stratum")
    for more in dealt[1:]:
        out = out.unionByName(more)
    return out


def identify(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """What ``deal_copies`` needs to know of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("_text"))
    rows = rows.withColumn("text_key", F.xxhash64("_text"))
    return with_size(rows, "_text", ["doc_id", "source", "text_key"])


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as it is taken, numbered by ``copy`` from 1 on."""
    kept = without(docs, ["copy"])
    dealt = deal_copies(identify(docs, text, doc_id, source), **options).filter("copies > 0")
    dealt = dealt.select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "source", "text_key", "copies")])
    own = {"_doc_id": F.col(doc_id), "_source": F.col(source), "_text_key": F.xxhash64(text)}
    same = [mine.eqNullSafe(F.col(theirs)) for theirs, mine in own.items()]
    taken = docs.select(*kept).join(dealt, same[0] & same[1] & same[2])
    return taken.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("copy"))
