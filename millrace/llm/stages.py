"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, jaccard_join, language_id, line_dedup, mixing
from .queries import language_models, prepare, table


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.keep_languages(docs, language_models(docs))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.dedup_lines(docs, passage_words=line_dedup.PASSAGE_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.keep_one_of_each_class(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


STAGES = [
    ("language ID", known_languages),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources", source_mix),
]
