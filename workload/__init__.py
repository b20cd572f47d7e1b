"""Maps the given test tables onto the inputs of the pipelines, one module per family.

Each module has ``QUERIES`` (name -> callable of session and table folder) and ``ORACLE`` (name -> the same result as
plain SQL over the original tables). Where a pipeline cleans or parses, the mapping first spoils the whole table by
fixed rules (every eleventh name is blanked and so on) and the SQL computes the expected result from the unspoilt
columns, so both sides get there on different ways.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
