"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` points of a 64-bit ring. A row's hash falls into the
arc before one of these points and belongs to its shard, unless that shard is
full: then it goes on clockwise to the next point whose shard has room. Room is
the fair share, rounded up for the first ``rows mod shards`` shards, so counts
differ by one at most, and only rows of overfull shards move.

Which rows of an arc overflow is settled by their order within the arc. So the
number of rows per arc is all the walk around the ring needs: it runs on a table
of ``shards * nodes`` counts, whatever the input's size. Rows then look up their
place by rank. Arcs are cut into ``parts`` ranges of the hash, so ranks come from
many small windows.

Defined results: a null text has no bytes (size 1); rows with the same id and
text share a ring position and are told apart by the remaining columns given,
equal rows take neighbouring slots; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Ring:
    """Points in ring order (signed 64-bit) and the shard of each."""

    points: list[int]
    owners: list[int]

    @staticmethod
    def of(shards: int, nodes: int) -> Ring:
        spots = sorted(
            (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
            for s in range(shards) for v in range(nodes)
        )
        return Ring([p for p, _ in spots], [s for _, s in spots])


@dataclass(frozen=True)
class Run:
    """Rows ``first`` to ``last`` (exclusive) of an arc go to ``shard`` from ``slot`` on."""

    arc: int
    first: int
    last: int
    shard: int
    slot: int


def walk(ring: Ring, counts: list[int], room: list[int]) -> list[Run]:
    """Fill shards clockwise: own rows first, then what flows on, until all rows have a place.

    ``counts`` has the rows of each arc, ``room`` the places of each shard, as
    many as rows in all. Each arc keeps a prefix of its rows with its owner; the
    rest waits in a queue (oldest first) that is carried around the ring.
    """
    left, used = list(room), [0] * len(room)
    runs: list[Run] = []

    def place(arc: int, first: int, last: int, shard: int) -> int:
        took = min(last - first, left[shard])
        if took:
            runs.append(Run(arc, first, first + took, shard, used[shard]))
            left[shard] -= took
            used[shard] += took
        return first + took

    over = {}
    for arc, owner in enumerate(ring.owners):
        over[arc] = place(arc, 0, counts[arc], owner)
    waiting: list[tuple[int, int, int]] = []
    for lap in range(2):  # a second lap carries what passed the ring's start
        for arc, owner in enumerate(ring.owners):
            kept = []
            for source, first, last in waiting:
                first = place(source, first, last, owner)
                if first < last:
                    kept.append((source, first, last))
            waiting = kept
            if lap == 0 and over[arc] < counts[arc]:
                waiting.append((arc, over[arc], counts[arc]))
    return runs


def _arc(position: Column, ring: Ring) -> Column:
    """Number of the first point at or after the position, by a search tree of comparisons over the ring."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low % len(ring.points))
        middle = (low + high) // 2
        return F.when(position <= F.lit(ring.points[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(ring.points))


def arc_of(position: int, ring: Ring) -> int:
    return bisect.bisect_left(ring.points, position) % len(ring.points)


def assign(df: DataFrame, shards: int = 16, nodes: int = 16, parts: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    ring = Ring.of(shards, nodes)
    spark = df.sparkSession
    rows = df.select(
        F.col(key).alias("key"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"),
    ).withColumn("at", F.xxhash64("name"))
    rows = rows.withColumn("arc", _arc(F.col("at"), ring)).withColumn("part", F.pmod(F.xxhash64("name", "text_crc32", "size"), F.lit(parts)))
    # At most shards * nodes * parts counts.
    counts = {(r["arc"], r["part"]): r["count"] for r in rows.groupBy("arc", "part").count().collect()}
    arcs = [sum(counts.get((a, p), 0) for p in range(parts)) for a in range(len(ring.points))]
    total = sum(arcs)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    before = []
    for a in range(len(ring.points)):
        base = 0
        for p in range(parts):
            before.append((a, p, base))
            base += counts.get((a, p), 0)
    starts = spark.createDataFrame(before, "arc int, part long, base long")
    runs = spark.createDataFrame([(r.arc, r.first, r.last, r.shard, r.slot) for r in walk(ring, arcs, room)] or [(-1, 0, 0, 0, 0)], "arc int, first long, last long, shard int, start long")
    order = Window.partitionBy("arc", "part").orderBy("at", "name", "text_crc32", "size")
    ranked = rows.withColumn("rank", F.row_number().over(order)).join(F.broadcast(starts), ["arc", "part"]).withColumn("rank", F.col("base") + F.col("rank") - 1)
    placed = ranked.join(F.broadcast(runs), (ranked["arc"] == runs["arc"]) & (ranked["rank"] >= runs["first"]) & (ranked["rank"] < runs["last"]))
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("start") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
