"""Connected components of a table of links, by joins and sums."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in ``links`` (columns a, b); the component is its smallest id.

    Large-star and small-star steps alternate until nothing changes: each node is tied to the smallest
    of its neighbours, so paths halve and a component of any size ends as a star. A step is an
    aggregation and a join of the links; its result is a table in the shared folder. Of a star of
    any size only one row per link is ever made.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    before = _told(edges)
    while True:
        # Large star: both ways, every larger neighbour of a node goes to the node's smallest.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every smaller neighbour of a node, and the node, go to the smallest.
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small, "a")
        new = stored(
            tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).distinct(), name
        )
        after = _told(new)
        if before == after:
            return new.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                new.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        edges, before = new, after


def _told(edges: DataFrame):
    """Tells one set of links from another."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
