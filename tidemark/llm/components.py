"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _signature(edges: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), mixed).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``node, root`` for every node of ``edges`` (columns a, b of one ordered type).

    Alternates two steps until nothing changes: each node hands its larger
    neighbours to the smallest node it sees, then its smaller neighbours.  Both
    are a minimum per node and a join back, so no neighbour list is gathered; a
    node with very many neighbours is one skewed join key, which Spark splits.
    The root is the smallest node.  Self links and repeats are harmless.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = staged(pairs.filter("u != v").distinct(), "edges")
    before, seen = None, _signature(now)
    while seen != before:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        others = large.join(least, "u").filter("v != m")
        small = others.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        now = staged(small, "small-star")
        before, seen = seen, _signature(now)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.unionAll(roots)
