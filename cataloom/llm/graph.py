"""Connected components of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cataloom.storage import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its least node.

    Large-star and small-star steps alternate until nothing changes. All tables between the
    steps are written, so that a node with very many links is a skewed side of a join of two
    shuffles, which adaptive execution splits. Self-links and repeats are ignored; nodes are
    not null.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = materialize(
        links.select(a.alias("u"), b.alias("v")).where("u != v").distinct(), "links"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(
            both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least"
        )
        large = materialize(
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "large-star",
        )
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        edges = materialize(
            small.where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "small-star",
        )
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        now = tuple(sums.first())
        if now == before:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
            return nodes.union(roots.distinct())
        before = now
