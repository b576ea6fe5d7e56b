"""Connected components of a link table by alternating large and small stars, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met, staged


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def stars(links: DataFrame) -> DataFrame:
    """Links (a long, b long) to a star per component: one row (a, b) for each node but the smallest, b the smallest.

    Self links and repeats don't matter; no links give no rows. A node with a large share of all links is hot, and is met by a
    broadcast, so that its neighbours are never in one task. Each round reads a staged table, so lineage stays
    short; the number of rounds grows with the logarithm of the longest chain."""
    edges = staged(_oriented(links), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a hub's neighbours are counted and reduced before any shuffle, and meet their least one where they lie
        least = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")), "large-least")
        large = _oriented(met(both.where("b > a"), least, "a", "n").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = staged(large, "large-star")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "small-least")
        small = met(large, least, "a", "n").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(_oriented(small.unionByName(least.select("a", F.col("m").alias("b")))), "small-star")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges
