"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foyer.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) with ``m``, the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("m", "u"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _least(down)
    return (
        found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(found.select("u", F.col("m").alias("v")))
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Each node of the edges (``u``, ``v``, longs) with ``root``, the least node of its component.

    Rounds halve what is left to merge; each is two aggregates and joins on single nodes, whose hot
    keys Spark splits, and its edges are written, so lineage stays short. Loops and repeated edges
    do no harm; a node without an edge is not listed.
    """
    now = written(edges.where("u <> v").select("u", "v").distinct(), name)
    mark = None
    while True:
        now = written(_small_star(_large_star(now)).where("u <> v").distinct(), name)
        seen = now.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).head()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
