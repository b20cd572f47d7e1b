"""Readers of landed files. Each one fails on a missing path and never infers a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace import schemas
from millrace.functions import missing_markers_to_null
from millrace.functions.text import WHITESPACE
from millrace.sources.csv_blocks import read_csv_blocks


# What ends a line of text besides line feeds and carriage returns.
LINE_ENDS = "[\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def ingest_order() -> Column:
    """Position of a row in its input: file, block in the file, row in the block.

    Only meaningful at the scan itself, before any shuffle. Ids grow along a block, so the triple orders rows as the
    files do, however Spark packs the blocks into tasks.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


class MissingColumn(ValueError):
    """A file lacks a column that its readers need."""


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = True) -> DataFrame:
    """The named columns of CSV files as text, found by their name in the header, in whatever order it has them.

    Doubled quotes stand for one, a quoted field may hold line breaks, and a row that is too short ends in nulls. Files
    under one path must agree in their header; a missing column is an error. ``multi_line`` reads each file by one task;
    for large files see ``read_csv_parallel``.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    header = reader.csv(path).columns
    absent = [c for c in columns if c not in header]
    if absent:
        raise MissingColumn(f"{path} has no column {', '.join(absent)}")
    schema = StructType([StructField(c, StringType()) for c in header])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_csv_parallel(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The same rows, and ``seq``, their ingest order, with each file read by as many tasks as it has blocks.

    The file is scanned twice. A last column that no field of a short row reaches is null, as above.
    """
    header = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    absent = [c for c in columns if c not in header]
    if absent:
        raise MissingColumn(f"{path} has no column {', '.join(absent)}")
    return read_csv_blocks(spark, path, header).select(*columns, "seq")


def read_sales_csv(spark: SparkSession, path: str, multi_line: bool = True, parallel: bool = False) -> DataFrame:
    """Sales rows with every column as text, missing markers as null, and ``seq``, the ingest order.

    ``parallel`` reads files with line breaks in fields block by block.
    """
    if parallel:
        rows = read_csv_parallel(spark, path, schemas.SALES_COLUMNS)
    else:
        rows = read_csv(spark, path, schemas.SALES_COLUMNS, multi_line).withColumn("seq", ingest_order())
    return rows.select(*[missing_markers_to_null(F.col(c)).alias(c) for c in schemas.SALES_COLUMNS], "seq")


def read_seed_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Typed reference data; text that does not fit the type of its column fails the run."""
    return read_csv(spark, path, schema.names, multi_line).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``(raw_line, source_file)``; undecodable bytes are replaced, blank lines dropped.

    Lines end at ``\\n``, ``\\r\\n`` or ``\\r``, and at the rarer marks of ``LINE_ENDS``.
    """
    return as_log_lines(spark.read.text(path))


def as_log_lines(text: DataFrame) -> DataFrame:
    """The same for an already opened text source, batch or streaming."""
    line = F.make_valid_utf8("value")
    parts = F.when(line.rlike(LINE_ENDS), F.split(line, LINE_ENDS)).otherwise(F.array(line))
    lines = text.select(F.explode(parts).alias("raw_line"), F.col("_metadata.file_name").alias("source_file"))
    return lines.filter(F.col("raw_line").rlike(f"[^{WHITESPACE}]"))


def flatten_price_payload(payloads: DataFrame) -> DataFrame:
    """Landed ``(payload, fetched_at_utc)`` rows to one row per key of the payload; absent fields are null.

    Payloads that are no price map have no rows here, see ``price_payload_rejects``. If the landed rows carry their
    ingest order as ``seq``, each price gets its own: that of the payload, then its place in it.
    """
    prices = F.from_json("payload", schemas.PRICE_PAYLOAD)
    carried = ["seq"] if "seq" in payloads.columns else []
    flat = payloads.select("fetched_at_utc", *carried, F.posexplode(F.map_entries(prices)).alias("_place", "_v"))
    return flat.select(
        F.col("_v.key").alias("coin_id"),
        F.col("_v.value.usd").alias("price_usd"),
        F.col("_v.value.usd_market_cap").alias("market_cap_usd"),
        "fetched_at_utc",
        *[F.struct(F.col(c).alias("landed"), F.col("_place").alias("place")).alias(c) for c in carried],
    )


def price_payload_rejects(payloads: DataFrame) -> DataFrame:
    """Landed rows whose payload yields no price row, as they arrived, with the reason."""
    prices = F.from_json("payload", schemas.PRICE_PAYLOAD)
    reason = (
        F.when(F.col("payload").isNull(), "no payload")
        .when(prices.isNull(), "no price map")
        .when(F.size(prices) == 0, "empty price map")
    )
    marked = payloads.select("payload", "fetched_at_utc", reason.alias("reject_reason"))
    return marked.filter(F.col("reject_reason").isNotNull())


def read_landed_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Landed API responses, one JSON object per line: the payload as text beside what is known about its fetch.

    ``seq`` is the ingest order.
    """
    landed = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return landed.select("*", ingest_order().alias("seq"))


def restrict_to_keys(
    df: DataFrame, key: str, keys: Sequence[str] | DataFrame | None, default: Sequence[str]
) -> DataFrame:
    """Only the wanted keys: a short list, a frame of any size with a column ``key``, or the default when empty."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key), key, "left_semi")
    return df.filter(F.col(key).isin(list(keys or default)))
