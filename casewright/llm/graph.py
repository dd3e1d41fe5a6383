"""Connected components of an edge table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.session import Workspace


def _size(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b): the smallest node of its component.

    Star operations: each node sends its larger, then its smaller neighbours to
    the smallest one around it, until all hang on their component's smallest
    node. Each round is an aggregation and a join; rounds grow with the logarithm
    of the longest path. Every round is a table in ``work``, and so is the result.
    """
    edges = work.stage(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _size(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.filter("m < a").select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).filter("a != b")
        edges = work.stage(small.distinct(), "edges")
        after = _size(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
