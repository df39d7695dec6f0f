"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspan.llm.common import staged


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node is linked to one smaller node at most, and that to none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    by_node = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return by_node.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("in") > 0))).limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node that isn't its own root; links are ``a``, ``b``.

    Each round links the larger neighbours of a node to the least one, then the smaller ones; after few rounds every node
    is linked to its root alone.  Minima are taken before rows move, so that a node with very many links is no hot
    spot, and a round never has more links than the one before.  Rounds are kept in the shared folder.  Any orderable type
    serves as node; repeated links and links of a node to itself change nothing; no links give no rows.
    """
    edges = staged(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(
            joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = staged(small.distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
