"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import keep


def _mark(edges: DataFrame):
    """Number of links and an order-free digest of them: equal when nothing changed."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root): for every node that has a link to another, the smallest node it can reach.

    Each round hangs the larger neighbours of every node under the smallest
    one, then the smaller neighbours likewise, until nothing moves; the number
    of rounds grows with the logarithm of a component's size. The smallest
    neighbour is a map-side combined minimum that is joined back, so a hub is
    never gathered into one task, and every round is written to the shared folder.
    """
    edges = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    edges = keep(edges, "links")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.u", "e.v")
        edges = keep(small.where("u <> v").distinct(), "small-star")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
