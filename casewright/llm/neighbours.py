"""Approximate nearest neighbours with an adaptive dimension scan.

Vectors are put into lists around centroids that k-means fits on a bounded
sample. Every query probes its nearest lists. Within a list, vectors are rotated
by a random orthogonal matrix and scanned in blocks of columns: after each block
the partial distance is scaled up to all dimensions, and a hypothesis test
(``EPSILON`` standard deviations) abandons candidates that are almost surely
farther than the nearest ``k`` found so far. What is left is measured exactly, in
double precision, on the original vectors.

Lists are cut into parts of about ``PART_ROWS`` rows by a hash of the row, so a
list that holds many rows (copies of one vector) is many tasks; every part
reports its own nearest, at most ``k`` different ids per query, and the best of all are kept.
Queries are dealt into blocks of about ``QUERY_ROWS`` by a hash likewise, and a part
is sent once to each block, so a task holds a bounded number of rows and queries.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; a repeated query row is one
query; rows that share the query's id are not its neighbours; ties go to the
smaller id; with fewer candidates than ``k`` all are returned; a table without
valid vectors gives an empty result; an id with several different vectors is one
neighbour, as far as its nearest; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import stage

EPSILON = 3.0
BLOCK = 16
PART_ROWS = 4096
QUERY_ROWS = 4096
_KINDS = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Config:
    """``sample`` bounds the rows k-means sees, ``max_lists`` the centroids; ``probes`` is a share of the lists."""

    k: int = 10
    sample: int = 20_000
    max_lists: int = 1024
    rows_per_list: int = 1000
    probes: float = 0.75
    rounds: int = 8
    seed: int = 11


def valid(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` (double) of the vectors that take part; equal rows once."""
    v = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    rows = rows.filter((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().collect()  # one row per length
    if not sizes:
        return rows.limit(0)
    usual = max(sizes, key=lambda r: (r["count"], r["n"]))["n"]
    return rows.filter(F.size("v") == usual)


def centroids(rows: DataFrame, total: int, config: Config) -> np.ndarray:
    """k-means on at most about ``config.sample`` rows, chosen by a hash of id and vector."""
    share = min(1.0, config.sample / max(1, total))
    draw = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) / float(1 << 30)
    sample = sorted((r["vec_id"], r["v"]) for r in rows.filter(draw < share).select("vec_id", "v").collect())
    x = np.unique(np.array([v for _, v in sample] or [rows.first()["v"]]), axis=0)
    lists = int(np.clip(total // config.rows_per_list, 1, min(config.max_lists, len(x))))
    rng = np.random.default_rng(config.seed)
    middle = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(config.rounds):
        near = nearest(x, middle)
        counts = np.bincount(near, minlength=lists)
        sums = np.zeros_like(middle)
        np.add.at(sums, near, x)
        middle = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], middle)
    return middle


def nearest(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    return ((middle**2).sum(1) - 2 * x @ middle.T).argmin(axis=1)


def rotation(size: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def scan(query: np.ndarray, query_id: int, ids: np.ndarray, vectors: np.ndarray, turned: np.ndarray, turn: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``k`` nearest different ids of one part, each by its nearest row, with ties to smaller ids.

    ``ids`` are in order. ``turned`` has the rotated vectors, one row per
    dimension, so a block of columns is contiguous.
    """
    there = np.flatnonzero(ids != query_id)
    heads = there[np.append(True, ids[there][1:] != ids[there][:-1])[: len(there)]]
    if len(heads) > k:
        spun, size = turn @ query, len(query)
        # One row of each of the first ids gives a bound; it only falls from there.
        first = heads[: 4 * k]
        bound = np.partition(((vectors[first] - query) ** 2).sum(axis=1), k - 1)[k - 1]
        part, left = np.zeros(len(there)), there
        for start in range(0, size, BLOCK):
            end = min(size, start + BLOCK)
            part += ((turned[start:end][:, left] - spun[start:end, None]) ** 2).sum(axis=0)
            limit = bound * (end / size) * (1 + EPSILON / np.sqrt(end)) ** 2 if end < size else bound * (1 + 1e-9) + 1e-12
            keep = part <= limit
            part, left = part[keep], left[keep]
        there = left
    distance = np.sqrt(((vectors[there] - query) ** 2).sum(axis=1))
    best = np.lexsort((ids[there], distance))
    # The first place of each id, the nearest first.
    best = best[np.sort(np.unique(ids[there][best], return_index=True)[1])[:k]]
    return ids[there][best], distance[best]


def search(df: DataFrame, is_query: Column, config: Config = Config(), id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest ``config.k`` rows found for each query row."""
    spark = df.sparkSession
    rows = stage(valid(df, id_column, vector).dropDuplicates(["vec_id", "v"]), "vectors")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    held = spark.sparkContext.broadcast(centroids(rows, total, config))

    @F.pandas_udf("int")
    def own_list(v: pd.Series) -> pd.Series:
        return pd.Series(nearest(np.array(v.tolist()), held.value) if len(v) else [], dtype="int32")

    listed = stage(rows.withColumn("list", own_list("v")), "vector_lists")
    # At most max_lists counts; an id with several vectors counts in one of its lists.
    counts = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    homes = {r["list"]: r["count"] for r in listed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect()}
    lists = len(held.value)
    sizes, different = (np.array([n.get(i, 0) for i in range(lists)]) for n in (counts, homes))
    parts = np.maximum(1, -(-sizes // PART_ROWS))
    probes, k = max(1, int(np.ceil(config.probes * lists))), config.k

    @F.pandas_udf("array<int>")
    def probed(v: pd.Series) -> pd.Series:
        middle = held.value
        order = ((middle**2).sum(1) - 2 * np.array(v.tolist()).reshape(-1, middle.shape[1]) @ middle.T).argsort(axis=1, kind="stable")
        # As many lists as planned, and more until they hold enough different ids.
        enough = (np.cumsum(different[order], axis=1) <= 2 * k).sum(axis=1) + 1
        return pd.Series([o[: max(probes, n)] for o, n in zip(order, enough, strict=True)])

    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    number = spark.createDataFrame([(i, int(p)) for i, p in enumerate(parts)], "list int, parts int")
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "q"), F.lit(blocks)).cast("int"))
    asked = queries.withColumn("list", F.explode(probed("q"))).join(F.broadcast(number), "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    held_rows = listed.join(F.broadcast(number), "list").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int")).drop("parts")
    held_rows = held_rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    seed = config.seed

    def one_part(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if own.empty or others.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        order = np.argsort(own["vec_id"].to_numpy(), kind="stable")
        ids, vectors = own["vec_id"].to_numpy()[order], np.array(own["v"].tolist())[order]
        turn = rotation(vectors.shape[1], seed)
        turned = np.ascontiguousarray((vectors @ turn.T).T)
        out = []
        for query_id, q in zip(others["query_id"], others["q"], strict=True):
            found, distance = scan(np.array(q), query_id, ids, vectors, turned, turn, k)
            out.append(pd.DataFrame({"query_id": np.full(len(found), query_id), "vec_id": found, "score": distance}))
        return pd.concat(out)

    keys = ["list", "part", "block"]
    near = held_rows.groupBy(keys).cogroup(asked.groupBy(keys)).applyInPandas(one_part, _KINDS)
    # A repeated id keeps its nearest vector.
    once = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
