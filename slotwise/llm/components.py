"""Connected components of a graph given by its links, as rounds of joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``links`` (longs ``a``, ``b``, a <> b) that is not its own root.

    The root is the smallest vertex reachable. Large-star and small-star rounds take turns until
    the links are stars; every round is written to the shared folder, so the lineage stays short.
    A hub's links are split by adaptive skew joins, as each vertex has one row on the other side.
    """
    state, links = None, materialise(links.select("a", "b").distinct(), "links")
    while True:
        found = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 999_983)).first()
        if found == state or not found[0]:
            return links.select(F.col("a").alias("v"), F.col("b").alias("root"))
        state = found
        links = materialise(_small_star(_large_star(links)), "links")
