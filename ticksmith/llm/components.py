"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for edges ``u``, ``v``.

    Alternates the large-star and small-star steps of distributed label contraction until the
    edges stay as they are. Each step aggregates a minimum map-side and joins it back, so no
    neighbourhood is ever gathered; the rounds grow with the logarithm of the longest chain,
    and every round is a written table.
    """
    both = edges.where("u <> v")
    now = written(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        large = _star(_mirrored(now), keep="n > u")
        after = written(_small(large), "edges")
        same = _signature(after) == _signature(now)
        now = after
        if same:
            break
    roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.select("u", F.col("v").alias("n")).union(
        edges.select(F.col("v").alias("u"), F.col("u").alias("n"))
    )


def _star(pairs: DataFrame, keep: str) -> DataFrame:
    """Each kept neighbour of a node linked to the least of the node and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("n").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    return (
        pairs.where(keep).join(least, "u").select(F.col("n").alias("u"), F.col("m").alias("v"))
        .where("u <> v").distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())
