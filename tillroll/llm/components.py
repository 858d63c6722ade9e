"""Connected components by alternating large-star and small-star contraction.

Every round is two aggregations (a minimum per node) and two joins over the
edge list, written to a table in the shared folder; nothing but two totals per
round reaches the driver.  A node with very many edges is a hot join key, which
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import apart, materialize, release


def _with_min(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the smallest neighbour of u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.withColumn("k", apart(F.col("u"))).join(
        least.select(apart(F.col("u")).alias("k"), "m"), "k").drop("k")


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than u move to the smallest of u and its neighbours."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    return _with_min(both).filter("v > u").select(
        F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them (edges have u > v)."""
    return (
        _with_min(edges)
        .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .filter("u != v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (long u, v).

    The component is its smallest node.  Nulls and loops are left out.
    """
    spark = edges.sparkSession
    # The larger end is u from the start; every step keeps it so.
    ordered = edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    held, path = materialize(ordered, "edges")
    before = None
    while True:
        total = held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(total) == before:
            break
        before = tuple(total)
        old = path
        held, path = materialize(_small_star(_large_star(held)), "edges")
        release(spark, old)
    # Now every edge points at its component's smallest node.
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        held.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
