"""Connected components of links, by alternating stars, without gathering a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import store_table


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours with the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours with the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component``: the least node that links (columns ``a``, ``b``) reach, for each linked node but the
    least itself. No links give no rows.

    Every round at least halves the longest way to the least node and is stored. The rounds end when each node has
    one link, to a node that has no smaller one, so that the links are stars.
    """
    edges = store_table(links.where("a <> b").select("a", "b").distinct(), "links")
    while True:
        edges = store_table(_smaller_to_least(_larger_to_least(edges)).distinct(), "stars")
        inner = edges.select(F.col("b").alias("a")).distinct()
        several = edges.groupBy("a").count().where("count > 1").select("a")
        if edges.join(inner, "a", "left_semi").select("a").union(several).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
