"""One registered query per operator, over its whole table, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import write_once
from .batches import bound_batches
from . import (
    decontaminate,
    divergence,
    jaccard_join,
    language_id,
    line_dedup,
    manifest,
    minhash,
    mixing,
    oracles,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_counts,
    url_filter,
)

_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Python workers find this package where the driver did, also in a session begun before, and get bounded batches."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    bound_batches(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _share(rest: int) -> Column:
    """Rows whose crc32 of the id leaves this rest; rows without an id are in no share."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == rest, F.lit(False))


def language_models(docs: DataFrame) -> language_id.Models:
    """Two of the four shares of ``documents`` are counted, one calibrates, and one is held out."""
    return language_id.train(docs, _share(0) | _share(1), _share(3))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_models(docs), keep=["doc_id"])
    return found.select("doc_id", _share(2).alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), counts=True, passage_words=line_dedup.PASSAGE_WORDS)
    return left.select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = mixing.deal_copies(mixing.identify(table(spark, sf_dir, "documents")))
    each = dealt.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return each.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_spans(docs, benchmark, keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("hit_from") > 0).alias("contaminated"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_owned")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge_urls(table(spark, sf_dir, "pages"))
    return found.select(F.col("key").alias("page_id"), "host", "path", "rule", "verdict", "mined")


def piece_model() -> str:
    """Where this machine has the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), piece_model, keep=["doc_id"])


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = write_once(quality_classifier.with_statistics(docs, keep=["doc_id"]), "statistics")
    share = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    marked = labels.filter(F.col("quality").isin(0, 1) & (share != 1))
    marked = rows.join(marked.select("doc_id", F.col("quality").cast("long").alias("label")), "doc_id")
    model = quality_classifier.train(marked, F.xxhash64("doc_id"))
    found = quality_classifier.score(rows, model, ["doc_id"])
    return found.select("doc_id", F.coalesce(share == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return manifest.audit(table(spark, sf_dir, "documents"), F.when(tampered, lower).otherwise(F.col("text")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_source_mix": op3_source_mix,
    "op4_decontaminate": op4_decontaminate,
    "op5_secret_scan": op5_secret_scan,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_source_divergence": op11_source_divergence,
    "op12_minhash": op12_minhash,
    "op13_manifest": op13_manifest,
}

ORACLE = {
    "op4_decontaminate": oracles.OP4,
    "op5_secret_scan": oracles.OP5,
    "op9_jaccard_join": oracles.OP9,
    "op11_source_divergence": oracles.OP11,
    "op12_minhash": oracles.OP12,
    "op13_manifest": oracles.OP13,
}
