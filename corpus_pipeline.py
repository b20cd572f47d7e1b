"""From raw documents to a training mixture: five stages, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.queries import table
from millrace.llm.stages import STAGES
from millrace.session import write_once

#: No stage of these can be written as SQL as a whole; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
