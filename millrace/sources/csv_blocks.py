"""CSV files whose fields hold line breaks, read by many tasks.

Whether a line begins a record depends on all quotes before it, so a file seems to have to be read from its start. But a
line only maps one state, outside or inside a quoted field, to another one, and such maps can be put together in any
grouping. A first pass finds the map of every block of a file from its lines with quotes; a running composition over the
blocks says in which state each block begins. The second pass reads the blocks by themselves, each from its state, and
gathers lines to records. What a cut leaves of a record at the end of a block and the start of the next ones is joined at
the end: at most two pieces for each block.

Quotes count as the batch reader counts them: only at the start of a field they open it, doubled ones stand for one, and
behind the closing one everything up to the next comma belongs to the field as it is. So a lone quote inside a field, as in
``5" pipe``, does not turn the rest of a file upside down. Lines end in ``\\n`` or ``\\r\\n``; in a file whose first line ends
in the latter, line breaks in fields become ``\\n`` as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

_QUOTED = rb'(?:[^"]++|"")*+'  # what follows an opening quote, up to the closing one
_FIELDS = rb'(?:(?:"' + _QUOTED + rb'"[^,]*+|(?!")[^,]*+),)*+'
# A line after which a quoted field is open, if none is before it, and if one is.
_OPENS = re.compile(_FIELDS + rb'"' + _QUOTED + rb"$", re.DOTALL)
_STAYS_OPEN = re.compile(_QUOTED + rb'(?:"[^,]*+,' + _FIELDS + rb'"' + _QUOTED + rb")?+$", re.DOTALL)


def next_state(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open behind the line."""
    return bool((_STAYS_OPEN if inside else _OPENS).match(line))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the block of the file they begin in; ``row`` grows along a block."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").cast("binary").alias("line"),
    )


def _runs(*columns: pa.Array) -> Iterator[tuple[int, int]]:
    """From and to of the rows of a batch that agree in all columns."""
    n = len(columns[0])
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for c in columns:
        if n > 1:
            change |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), n]
    return zip(cuts, cuts[1:], strict=False)


def _block_maps(lines: DataFrame) -> DataFrame:
    """``file, block, from_outside, from_inside, crlf``: the states behind a block (1: inside a field) by that before it, and
    how its first line ends."""
    names, kinds = ["file", "block", "crlf", "from_outside", "from_inside"], (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states = None, (False, True)

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip((*now, *map(int, states)), kinds, strict=True)], names=names)

        for batch in batches:
            for a, b in _runs(batch["file"], batch["block"]) if batch.num_rows else ():
                key = batch["file"][a].as_py(), batch["block"][a].as_py()
                if now is None or key != now[:2]:
                    if now is not None:
                        yield sent()
                    now, states = (*key, batch["crlf"][a].as_py()), (False, True)
                for line in batch["quoted"].slice(a, b - a).drop_null().to_pylist():
                    states = tuple(next_state(line, s) for s in states) if states[0] != states[1] else (next_state(line, states[0]),) * 2
        if now is not None:
            yield sent()

    # A line without quotes changes nothing; it is sent only to name its block.
    quoted = F.when(F.contains("line", F.lit(b'"')), F.col("line")).alias("quoted")
    crlf = F.endswith("line", F.lit(b"\r")).alias("crlf")
    return lines.select("file", "block", crlf, quoted).mapInArrow(run, "file string, block long, crlf boolean, from_outside int, from_inside int")


def _block_states(maps: DataFrame) -> DataFrame:
    """``file, block, crlf, inside``: how lines of the file end, and the state in which each block begins. Takes a row per
    block.

    A block whose map is constant sets the state, one that swaps it counts, any other one leaves it.
    """
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.when(F.col("from_outside") > F.col("from_inside"), 1).otherwise(0)).over(before), F.lit(0))
    counted = maps.withColumn("_swaps", swaps)
    constant = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("state"), "_swaps"))
    last = F.last(constant, ignorenulls=True).over(before)
    inside = (F.coalesce(last["state"], F.lit(0)) + F.col("_swaps") - F.coalesce(last["_swaps"], F.lit(0))) % 2 == 1
    crlf = F.max(F.when(F.col("block") == 0, F.col("crlf"))).over(Window.partitionBy("file"))
    return counted.select("file", "block", F.coalesce(crlf, F.lit(False)).alias("crlf"), inside.alias("inside"))


_PIECES = "file string, block long, row long, text binary, whole boolean, head boolean, first boolean, crlf boolean"


def _pieces(lines: DataFrame) -> DataFrame:
    """Records, and pieces of records that a cut has parted: the ``head`` of a block goes on with one from before, any
    other one that is not ``whole`` goes on behind its block. ``row`` is that of the first line. The ``first`` record of a
    file, blank lines aside, is its header."""
    names = ["file", "block", "row", "text", "whole", "head", "first", "crlf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, held, row, head, header, crlf = None, False, [], 0, False, False, False

        def sent(texts: pa.Array, rows: list[int], whole: bool, heads: bool) -> pa.RecordBatch:
            nonlocal header
            n, first = len(texts), np.zeros(len(texts), dtype=bool)
            if header and len(filled := np.flatnonzero(np.array([t not in (b"", b"\r") for t in texts.slice(0, 100).to_pylist()]))):
                first[filled[0]], header = True, False
            fixed = [pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array(rows, pa.int64())]
            flags = [pa.array(np.full(n, whole)), pa.array(np.full(n, heads)), pa.array(first), pa.array(np.full(n, crlf))]
            return pa.RecordBatch.from_arrays([*fixed, texts.cast(pa.binary()), *flags], names=names)

        def closed() -> pa.RecordBatch:
            """What is held when the next record begins, or the block ends."""
            return sent(pa.array([b"\n".join(held)], pa.binary()), [row], not head and not inside, head)

        for batch in batches:
            for a, b in _runs(batch["file"], batch["block"]) if batch.num_rows else ():
                key = batch["file"][a].as_py(), batch["block"][a].as_py()
                if key != now:
                    if held:
                        yield closed()
                    now, inside, held = key, batch["inside"][a].as_py(), []
                    head, header, crlf = inside, key[1] == 0, batch["crlf"][a].as_py()
                part = batch["line"].slice(a, b - a)
                quoted = np.flatnonzero(batch["quoted"].slice(a, b - a).to_numpy(zero_copy_only=False))
                begins, at = np.zeros(b - a, dtype=bool), 0
                for i in quoted.tolist():  # between lines with quotes the state stays
                    begins[at : i + 1] = not inside
                    inside, at = next_state(part[i].as_py(), inside), i + 1
                begins[at:] = not inside
                first = np.flatnonzero(begins)
                rows = batch["row"].slice(a, b - a).to_numpy()
                stop = int(first[0]) if len(first) else b - a
                if stop:
                    if not held:
                        row = int(rows[0])
                    held += part.slice(0, stop).to_pylist()
                if not len(first):
                    continue
                after = inside
                if held:
                    inside = False  # a record begins behind it
                    yield closed()
                    held, inside = [], after
                head = False
                if len(first) > 1:
                    bounds = pa.array(first.astype(np.int32))
                    whole = pa.ListArray.from_arrays(bounds, part.slice(0, int(first[-1])))
                    yield sent(pc.binary_join(whole, b"\n"), rows[first[:-1]].tolist(), True, False)
                held, row = part.slice(int(first[-1])).to_pylist(), int(rows[first[-1]])
        if held:
            yield closed()

    quoted = F.contains("line", F.lit(b'"')).alias("quoted")
    return lines.select("file", "block", "row", "inside", "crlf", quoted, "line").mapInArrow(run, _PIECES)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, row, text, first`` of every record but blank lines; the first three order them as the files do."""
    lines = _lines(spark, path)
    states = _block_states(_block_maps(lines))
    # A row for each block of the files.
    pieces = _pieces(lines.join(F.broadcast(states), ["file", "block"]))
    in_file = Window.partitionBy("file").orderBy("block", "row")
    parted = pieces.filter("NOT whole").withColumn("_record", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(in_file))
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "text", "first", "crlf")))
    joined = parted.groupBy("file", "_record").agg(parts.alias("_parts"))
    text = F.array_join(F.transform("_parts", lambda p: p["text"].cast("string")), "\n")
    joined = joined.select("file", *[F.col("_parts")[0][c].alias(c) for c in ("block", "row")], text.alias("text"), *[F.col("_parts")[0][c].alias(c) for c in ("first", "crlf")])
    whole = pieces.filter("whole").select("file", "block", "row", F.col("text").cast("string").alias("text"), "first", "crlf")
    ended = F.regexp_replace(F.make_valid_utf8("text"), r"\r\z", "")
    ended = F.when(F.col("crlf"), F.replace(ended, F.lit("\r\n"), F.lit("\n"))).otherwise(ended)
    return whole.unionByName(joined).withColumn("text", ended).filter("text <> ''")


def read_csv_blocks(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """Columns ``header`` of CSV files as text, and ``seq``, the ingest order. Each file begins with that header."""
    found = records(spark, path)
    bare = F.when(F.col("first"), F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text"))
    options = {"escape": '"', "multiLine": "true"}
    parsed = F.from_csv(bare, ", ".join(f"`{c}` STRING" for c in header), options)
    parsed = found.select("first", F.struct("file", "block", "row").alias("seq"), F.explode(F.array(parsed)).alias("_r"))
    agrees = F.lit(True)
    for c in header:
        agrees &= F.col("_r")[c].eqNullSafe(F.lit(c))
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("seq.file"))).cast("boolean")
    rows = parsed.filter(F.when(F.col("first"), F.when(agrees, False).otherwise(wrong)).otherwise(True))
    return rows.select(*[F.col("_r")[c].alias(c) for c in header], "seq")
