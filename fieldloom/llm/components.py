"""Connected components of a graph given by its links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node that has a link.

    Large-star and small-star steps take turns until nothing changes: every node's
    larger, then its smaller, neighbours are linked to the smallest one. Minima are
    combined before they are shuffled, so a node with very many links is no hot spot;
    only a count and a sum per step reach the driver. Links to oneself or to null are
    ignored, repeated links count once.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = materialize(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
        before, state = state, _state(edges)
        if state == before:
            break
    # Now every node is linked to the smallest one of its component and to no other.
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
