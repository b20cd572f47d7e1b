"""Session builder and the shared scratch area used to cut lineage."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Settings the jobs are tuned for. They only steer Spark's own planner; results do not depend on them.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when that costs one more shuffle for the operator above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}
# Partitions a shuffle starts with on a cluster: a ceiling for the largest inputs, as AQE merges those it does not fill.
CLUSTER_PARTITIONS = "8192"


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine settings; keyword settings use ``__`` for ``.`` and win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(initial, None) is None:
        spark.conf.set(initial, CLUSTER_PARTITIONS)
    return spark


@functools.cache
def _own_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"millrace-{application_id}-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a folder of its own, because executors on other machines could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _own_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


_written: list[str] = []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of whatever file system its path names; a missing one is no error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextlib.contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that are written inside once it ends: for jobs that publish what they compute."""
    mark = len(_written)
    try:
        yield
    finally:
        while len(_written) > mark:
            delete(spark, _written.pop())


def write_once(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the scratch area and return the written table.

    Used where several results derive from one expensive frame. Unlike a cache the written table outlives lost
    executors, and unlike ``checkpoint`` it stays columnar, so every reader still prunes columns and pushes filters.
    ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, label)
    _written.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and Catalyst knows it: joins and unions with it fold away."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).limit(0)
