"""Connected components by alternating large and small stars, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.sources.tables import materialize


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node that it is linked to by any path; links has a and b.

    Every round hangs each node's neighbours on the smallest of them. A node's
    smallest neighbour is an aggregate that is combined before the shuffle, so a
    node with very many links is never gathered. Rounds end when the links stop
    changing; their number grows with the logarithm of the longest path.
    """
    smaller, larger = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    stars = materialize(links.where("a != b").select(smaller, larger).distinct(), "stars")
    mark = None
    while True:
        # Large star: neighbours above a node move to its smallest neighbour.
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(materialize(least, "stars-least"), "a").select(F.col("m").alias("a"), "b")
        large = materialize(large.where("a != b").distinct(), "stars-large")
        # Small star: a node and its neighbours below it move to the smallest of those.
        least = materialize(large.groupBy("b").agg(F.min("a").alias("m")), "stars-least")
        moved = large.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        stars = materialize(moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = stars.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
    return materialize(stars.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots), "components")
