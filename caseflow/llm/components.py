"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import materialise


def _rank(node: Column) -> Column:
    """A fixed random order of the nodes; the node itself breaks ties."""
    return F.struct(F.xxhash64(node).alias("h"), node.alias("node"))


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``links`` (a, b); one root for each component.

    Each round sends every node to the lowest-ranked of itself and its neighbours, and rewrites the
    links between the nodes that are left; the order is random, so their number falls by a constant
    factor, and a star takes two rounds whatever its size. Lowest ranks combine on the map side, so
    a node with very many links meets its reducer as one row for each map task. Every round is a
    table on shared storage: nothing is computed twice and no lineage grows.
    """
    links = materialise(links.filter("a <> b").distinct(), "links")
    rounds = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_rank(F.col("b"))).alias("best"))
        step = best.select(
            F.col("a").alias("node"), F.least("best", _rank(F.col("a")))["node"].alias("parent")
        )
        step = materialise(step, "hooks")
        rounds.append(step)
        for end in ("a", "b"):
            moved = step.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_parent"))
            links = links.join(moved, end)
        links = links.select(
            F.least("a_parent", "b_parent").alias("a"), F.greatest("a_parent", "b_parent").alias("b")
        )
        links = materialise(links.filter("a <> b").distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1].withColumnRenamed("parent", "root")
    for step in reversed(rounds[:-1]):
        above = roots.select(F.col("node").alias("parent"), "root")
        roots = step.join(above, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    return materialise(roots, "roots")
