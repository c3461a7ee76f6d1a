"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteloom.session import materialise


def _toward(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours become neighbours of its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a != b").distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours become neighbours of the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for the nodes of links ``a, b``.

    Edges are turned in two ways, in rounds, until each points at the least node of its
    component (large-star and small-star). Each round is written out; nothing but two
    numbers a round reaches the driver.
    """
    edges = materialise(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        edges = materialise(_down(_toward(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = tuple(state)
