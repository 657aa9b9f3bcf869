"""Connected components of an edge table, as rounds of large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node and component (the smallest node it is linked with) for every node with an edge (u, v).

    Every round points each node at smaller neighbours; minima are combined
    before the shuffle, so a node with very many edges is no single task.  Each
    round is a stored table, below ``scratch`` if it is given.  The edges stay in Spark.
    """
    keep = scratch.stored if scratch else stored
    edges = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "components")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
