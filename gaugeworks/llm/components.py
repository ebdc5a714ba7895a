"""Connected components of a graph given by its edges, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is its smallest node.

    Rounds of large stars and small stars: every node's larger neighbours, then every
    node itself with its smaller neighbours, are tied to the smallest of them, until
    nothing changes. Minima are grouped with partial sums and joined back, so a node
    with very many neighbours is never gathered. Each round is written to the scratch
    folder. Loops and repeated edges are allowed; null ends are dropped.
    """
    pairs = edges.where("a is not null and b is not null")
    now = settle(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()
        large = settle(large, "components")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct(), "components")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(roots.select("node", F.col("node").alias("component")))
