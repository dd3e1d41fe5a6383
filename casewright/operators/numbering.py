"""Numbers and quantiles from the order of values, without sending all of them to one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import stage

#: Rows numbered or weighed together.
RANGE_ROWS = 20_000


def in_ranges(df: DataFrame, order: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows dealt by ranges of the order columns, about ``range_rows`` each, with the range's number ``_range``.

    ``df`` is computed once. Ranges are drawn by sampling, so they are staged, too.
    """
    held = stage(df, "unordered")
    ranges = 1 + held.count() // range_rows
    if ranges == 1:
        return held.withColumn("_range", F.lit(0))
    return stage(held.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def running(df: DataFrame, order: Sequence[str], amount: Column, name: str, by: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows with the sum of an amount over all rows before them in the order of the columns; per value of ``by``, which leads the order.

    Sums are formed inside ranges; what goes before a range comes from one row per range and value of ``by``.
    """
    groups = [by] if by else []
    rest = [c for c in order if c != by]
    dealt = in_ranges(df.withColumn("_amount", amount), [*groups, *rest], range_rows)
    inside = Window.partitionBy("_range", *groups).orderBy(*rest).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range", *groups).agg(F.sum("_amount").alias("_total"))
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.struct("_range", *groups).alias("_place"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    placed = dealt.withColumn("_sum", F.coalesce(F.sum("_amount").over(inside), F.lit(0))).withColumn("_place", F.struct("_range", *groups))
    return placed.join(offsets, "_place").select(*df.columns, (F.col("_sum") + F.col("_offset")).alias(name))


def numbered(df: DataFrame, order: Sequence[str], name: str, by: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows with their number from 1 in the order of the columns; from 1 for each value of ``by``."""
    return running(df, order, F.lit(1).cast("long"), name, by, range_rows).withColumn(name, F.col(name) + 1)


def quantiles(df: DataFrame, column: str, shares: Sequence[float], range_rows: int = RANGE_ROWS) -> list[float | None]:
    """Exact quantiles, between two values in proportion to their distance.

    Equal values are counted first. Values are dealt by ranges; the counts of all
    ranges, one row each, tell which of them hold the ranks asked for, and only
    inside these values are put in order.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    dealt = in_ranges(counted, ["value"], range_rows)
    sizes = sorted((r["_range"], r["n"]) for r in dealt.groupBy("_range").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return [None] * len(shares)
    spots = [share * (total - 1) for share in shares]
    wanted = sorted({rank for spot in spots for rank in (math.floor(spot), math.ceil(spot))})
    # Rank from 0 inside the range that holds it.
    inside, before = [], 0
    for number, n in sizes:
        inside += [(number, rank, rank - before) for rank in wanted if before <= rank < before + n]
        before += n
    asked = df.sparkSession.createDataFrame(inside, "_range int, rank long, at long")
    running = Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = dealt.join(F.broadcast(asked.select("_range").distinct()), "_range").withColumn("_upto", F.sum("n").over(running))
    found = upto.join(F.broadcast(asked), "_range").filter((F.col("at") < F.col("_upto")) & (F.col("at") >= F.col("_upto") - F.col("n")))
    value = {r["rank"]: r["value"] for r in found.select("rank", "value").collect()}  # two ranks a quantile
    out = []
    for spot in spots:
        low, high = value[math.floor(spot)], value[math.ceil(spot)]
        out.append(low if low == high else low + (high - low) * (spot - math.floor(spot)))
    return out
