"""Connected components of links, by alternating large-star and small-star steps.

Links stay distributed: each step is a grouped minimum and a join, written to the
shared folder. A hub's links are never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def _hooked(links: DataFrame, larger_only: bool) -> DataFrame:
    """Links each neighbour of a node to the least of the node and its neighbours.

    larger_only: neighbours above the node (large star); else the node and those below it (small star).
    """
    both = links.select("a", "b").unionAll(links.selectExpr("b a", "a b")) if larger_only else links.selectExpr("greatest(a, b) a", "least(a, b) b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    joined = both.join(least, both.a == least.n)
    if larger_only:
        out = joined.where("b > a").selectExpr("b a", "m b")
    else:
        out = joined.where("b <> m").selectExpr("b a", "m b").unionAll(least.where("n <> m").selectExpr("n a", "m b"))
    return out.where("a <> b").distinct()


def _is_forest_of_stars(links: DataFrame) -> bool:
    """No node has two links up, and none that has one is linked to from below."""
    ends = links.selectExpr("a node", "1 up", "0 down").unionAll(links.selectExpr("b node", "0 up", "1 down"))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up > 0 and down > 0").isEmpty()


def components(links: DataFrame, space: Workspace, name: str) -> DataFrame:
    """links(a, b) -> (node, component): the smallest node reachable, for every node with a link.

    Self-links and repeated links count for nothing. Node ids must not be null.
    """
    now, step = space.save(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0"), 0
    while not _is_forest_of_stars(now):
        step += 1
        large = space.save(_hooked(now, True), f"{name}-l{step}")
        now = space.save(_hooked(large, False), f"{name}-{step}")
        space.drop(f"{name}-{step - 1}", f"{name}-l{step}")
    # Converged: every link leads from a node to its component's least one.
    return now.selectExpr("a node", "b component").unionAll(now.selectExpr("b node", "b component").distinct())
