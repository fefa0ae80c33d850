"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of a link, the smallest node that it can reach.

    Each round points the neighbours of a node at the smallest one, first the larger
    neighbours, then the smaller ones; rounds grow with the logarithm of the longest
    path. Rounds are written tables, as a checkpoint. Minima are pre-aggregated, and
    the joins leave a node with very many links to adaptive splitting. Self links and
    repeated links change nothing; links with a null are ignored; no links, no rows.
    """
    high, low = F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    known = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = settled(known.select(high, low).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(nearest, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("high"), F.col("m").alias("low"))
            .distinct()
        )
        large = settled(large)
        nearest = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (
            large.join(nearest, "high")
            .where(F.col("low") != F.col("m"))
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
        )
        edges = settled(
            small.unionByName(nearest.select("high", F.col("m").alias("low"))).distinct()
        )
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Count and checksum; equal for equal sets of edges."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("high", "low")).alias("sum")
    ).first()
    return row["n"], row["sum"]
