"""Groups of nodes that edges connect, without bringing edges or groups to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.session import Workspace


def connected(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node, root``: the smallest node each node of the edges (``a, b``) is connected with.

    In a round each node points to the smallest of its neighbours, if that is
    smaller than itself, and follows the pointers to their end, which takes the
    logarithm of their longest run. Edges then lead between these ends, and those
    inside one fall away: an end that stays has taken in another node or is
    taken in by the next round, so two rounds halve the nodes, and edges only get fewer. All are
    aggregations with map-side combine and joins on nodes, so a node with very many edges is
    spread like any other. Each round's tables lie in ``work``, and so does the result.
    """
    left = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left, steps = work.stage(left.distinct(), "edges"), []
    while not left.isEmpty():
        step = work.stage(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), "near")
        while True:
            further = step.select(F.col("node").alias("to"), F.col("to").alias("on"))
            ahead = work.stage(step.join(further, "to", "left").select("node", F.coalesce("on", "to").alias("to"), F.col("on").isNotNull().alias("went")), "step")
            step = ahead.select("node", "to")
            if ahead.filter("went").isEmpty():
                break
        steps.append(step)
        # Where no neighbour is smaller, a node stays as it is.
        moved = left.join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        moved = moved.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a", "left").withColumn("x", F.coalesce("x", "a"))
        left = work.stage(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # Back from the last round: where a node went, and where that went later.
    roots = steps.pop()
    while steps:
        later = roots.select(F.col("node").alias("to"), F.col("to").alias("on"))
        back = steps.pop().join(later, "to", "left").select("node", F.coalesce("on", "to").alias("to"))
        roots = work.stage(back.unionByName(roots), "back")
    roots = roots.withColumnRenamed("to", "root")
    return work.stage(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
