"""Connected components of a graph in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relevo.session import materialize


def _least_neighbour(arcs: DataFrame) -> DataFrame:
    """``u, m``: the least of u and its neighbours in ``u, v``."""
    return arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``u, v``; the root is the
    least node of the component.

    Alternating large-star and small-star steps: every node's larger (then
    smaller) neighbours are linked to its least one, until all links end at the
    roots.  A step is a minimum (combined before the shuffle) and a join; its
    links are written to the shared folder, so the plan stays short and a lost
    executor costs one step."""
    links = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        arcs = _both_ways(links)
        large = arcs.join(_least_neighbour(arcs), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = _least_neighbour(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        links = materialize(small.unionByName(least.select("u", F.col("m").alias("v")).filter("u <> v")).distinct(), "links")
        state = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1)))).first())
        if state == before:
            break
        before = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
