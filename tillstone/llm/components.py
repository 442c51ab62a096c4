"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillstone.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (a, b); the component is its smallest node.

    Each round hangs the neighbours of a node below the smallest of them: first
    the larger neighbours, then the smaller ones and the node itself. It ends
    when all links are a star. A node with very many links is a join key with
    many rows, which Spark splits; no list of neighbours is ever gathered.
    Links from a node to itself, repeated links and no links are fine.
    """
    stars, print_ = marked(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        before = print_
        stars, print_ = marked(small_star(large_star(stars)))
        # The same links as before: then every link points from a node to the centre of its star.
        if print_ == before:
            break
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)


def marked(stars: DataFrame) -> tuple[DataFrame, tuple]:
    """The links settled, and a fingerprint of their set, taken on the way: their number and the sums of two 64-bit hashes."""
    seen, wide = Observation(), "decimal(38,0)"
    hashes = [F.sum(F.xxhash64(*c).cast(wide)).alias(f"h{i}") for i, c in enumerate((("u", "v"), ("v", "u")))]
    found = settle(stars.observe(seen, F.count(F.lit(1)).alias("n"), *hashes), "links")
    return found, tuple(seen.get[c] for c in ("n", "h0", "h1"))


def large_star(stars: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node among the node and its neighbours, one link for each that was."""
    both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).withColumn("m", F.least("c", "m"))
    hung = both.filter("v > u").join(least, F.col("u") == F.col("c"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(stars: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of these."""
    least = stars.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    hung = stars.join(least, F.col("u") == F.col("c"))
    below = hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()
