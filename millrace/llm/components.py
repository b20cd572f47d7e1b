"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_once


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node with an edge to another one.

    Alternates two steps until nothing changes: each node hands its larger neighbours to its smallest one, then its
    smaller ones. Every step is an aggregation and a join on the node; no component is gathered anywhere. The edges of
    each round are written to the shared folder, so plans stay short and lost executors cost one round.
    """
    edges = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).filter("u <> v").distinct()
    edges = write_once(edges, "edges")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("least"))
        least = least.select("u", F.least("u", "least").alias("m"))
        handed = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_once(handed.filter("u <> v").distinct(), "large-star")

        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        handed = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        edges = write_once(handed.filter("u <> v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
            return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
        before = now
