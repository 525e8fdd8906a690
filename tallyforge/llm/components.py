"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import discard, materialize


def stars(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b) but the roots; root is the smallest node of its component.

    Each round is two grouped minima and joins over the links; the number of rounds grows with the logarithm of the
    component's size.  Self-links and repeated links don't matter; no links give no rows.
    """
    links = materialize(links.filter("a <> b").select("a", "b").distinct(), "stars")
    state = None
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Greater neighbours hang on the smallest one; then every smaller neighbour, and the node itself, does.
        large = both.join(low, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        before, links = links, materialize(small.filter("a <> b").distinct(), "stars")
        discard(before)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(now)
