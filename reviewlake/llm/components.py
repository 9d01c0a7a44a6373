"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import drop_shuffles
from reviewlake.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that each node with a link to another one reaches.

    A round shuffles the links twice by node and reduces each node's neighbours to their minimum before it joins them
    back by merge joins, so that no group of neighbours is ever collected and no table goes through the driver. Nulls
    and links to oneself are no links. Rounds go through tables in the shared folder and end when one changes nothing;
    their number grows with the logarithm of the links' longest path.
    """
    spark = edges.sparkSession
    links = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where(F.col("u") > F.col("v")).distinct(), "links")
    seen = _fingerprint(links)
    while True:
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour, and the node itself, goes to the smallest one
        large = large.where(F.col("u") > F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        links = materialize(small.where(F.col("u") > F.col("v")).distinct(), "links")
        drop_shuffles(spark)
        before, seen = seen, _fingerprint(links)
        if seen == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct())


def _fingerprint(links: DataFrame) -> tuple:
    """Count and order-free checksum of a set of links."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.shiftright(F.xxhash64("v", "u"), 20))).first())
