"""Documents whose sets of word shingles overlap by a given share, through R-trees of count vectors.

Shingles are hashed into groups; a set's point has the number of its shingles in
each. Larger sets need more groups, as chance evens out counts (``Rule.groups``);
a point is folded to fewer groups where it meets smaller sets. Two sets share at most the sum over the groups of the smaller
count, so an R-tree over points finds the sets that may overlap enough: a box is
entered if the sum of ``min(count, upper edge)`` reaches the overlap needed with
its smallest set. Pairs that survive are verified on their shingles.

One tree over a corpus would prune little, as boxes of unlike texts cover each
other. So points are first brought together by what linked sets must share: with
shingles in one order for all (rare hash buckets first), the first
``n - ceil(t n) + 1`` of both sets have one in common. Sets that share one form a
bucket; equal buckets count once; each gets a tree.

Only connections matter, so neither step lists all pairs of a group: from each
point, only points not yet connected are searched, and the links that connect
form the result. Points connected by possible links form a cluster; its texts
then meet once, in a tree with verification. Buckets and clusters over ``BLOCK``
members are cut into blocks, one task for each two of them.

Equal sets are one member throughout (their links are certain), and members are
named by a 64-bit hash of the set; shingles have 56-bit hashes.

Defined results: null, empty and blank texts have no shingles, link with nothing
and are their own component; with fewer words than ``words`` all of them are one
shingle; repeated rows are linked; a null id never is a component's name unless
all its ids are null; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import BY_SPACE, all_pieces, free_name, mix, possible, text_list, word_hashes
from casewright.llm.graph import components
from casewright.session import Workspace, stage

LEAF, BLOCK = 32, 512
PIECE = 1 << 18  # bytes of text taken together; each takes some ten numbers per byte
FREQUENCY_BITS = 18


@dataclass(frozen=True)
class Rule:
    """``words`` per shingle; sets link when ``100 * shared >= percent * united``."""

    words: int
    percent: int

    @property
    def spread(self) -> float:
        """Groups wanted per shingle: unlike sets then differ by half as much again as linked ones may."""
        return 10 * ((100 - self.percent) / (100 + self.percent)) ** 2

    def groups(self, n: int) -> int:
        """A power of two from 32 to 4096."""
        return min(4096, 1 << max(5, int(np.ceil(self.spread * n) - 1).bit_length()))

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def needed(self, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | int:
        """Smallest overlap of linked sets of these sizes: 100 x >= p (a + b - x)."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    """56-bit hashes of all shingles of each text, with repeats."""
    hashes, sizes = word_hashes(texts, BY_SPACE)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    count = max(0, len(hashes) - words + 1)
    whole = np.zeros(count, dtype=np.uint64)
    for i in range(words):
        whole = mix(whole + hashes[i : i + count] + np.uint64(1))
    whole >>= np.uint64(8)
    out = []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start >= words:
            out.append(whole[start : end - words + 1])
        elif end > start:
            value = np.zeros(1, dtype=np.uint64)
            for h in hashes[start:end]:
                value = mix(value + h + np.uint64(1))
            out.append((value + np.uint64(end - start)) >> np.uint64(8))
        else:
            out.append(whole[:0])
    return out


class Tree:
    """Packed R-tree of points: leaves of ``LEAF`` points in order of size and place, boxes with their edges."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        half = points[:, : points.shape[1] // 2].sum(axis=1)
        # Sort-tile packing: slices by size, each in order of its first half's counts.
        by_size = np.argsort(sizes, kind="stable")
        tile = np.empty(len(sizes), dtype=np.int64)
        tile[by_size] = np.arange(len(sizes)) // (LEAF * max(1, int(np.sqrt(len(sizes) / LEAF))))
        self.order = np.lexsort((half, tile))
        self.points, self.sizes = points[self.order], sizes[self.order]
        first = np.arange(0, len(sizes), LEAF)
        self.leaf = np.arange(len(sizes)) // LEAF
        self.upper = np.maximum.reduceat(self.points, first, axis=0)
        self.smallest = np.minimum.reduceat(self.sizes, first)
        self.alive = np.ones(len(sizes), dtype=bool)
        self.left = np.bincount(self.leaf)

    def drop(self, places: np.ndarray) -> None:
        """Take points out; a box without points is not entered any more."""
        self.alive[places] = False
        np.subtract.at(self.left, self.leaf[places], 1)

    def reach(self, place: int, rule: Rule) -> np.ndarray:
        """Places of the points left whose overlap with this one may be large enough."""
        point, size = self.points[place], self.sizes[place]
        boxes = np.flatnonzero(self.left > 0)
        bound = np.minimum(point, self.upper[boxes]).sum(axis=1)
        boxes = boxes[bound >= rule.needed(size, self.smallest[boxes])]
        if not len(boxes):
            return boxes
        inside = (boxes[:, None] * LEAF + np.arange(LEAF)).ravel()
        inside = inside[inside < len(self.alive)]
        inside = inside[self.alive[inside]]
        bound = np.minimum(point, self.points[inside]).sum(axis=1)
        return inside[bound >= rule.needed(size, self.sizes[inside])]


def connect(points: list[bytes], sizes: np.ndarray, rule: Rule, linked: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever is connected: by the bound alone, or by verified links.

    Sets with equally many groups share a tree, joined by the larger ones that
    could still link with them, folded.
    """
    arrays = [np.frombuffer(p, dtype="<u2").astype(np.int32) for p in points]
    if len(arrays) == 2:  # most buckets
        count = min(map(len, arrays))
        bound = np.minimum(*[a.reshape(-1, count).sum(axis=0) for a in arrays]).sum()
        return [(0, 1)] if bound >= rule.needed(*sizes.tolist()) and (linked is None or linked(0, 1)) else []
    groups = np.array([len(a) for a in arrays])
    edges = []
    for count in np.unique(groups).tolist():
        some = np.flatnonzero((groups == count) | ((groups > count) & (sizes * rule.percent * rule.spread <= 100 * (count + 1))))
        folded = np.stack([arrays[i].reshape(-1, count).sum(axis=0) for i in some.tolist()])
        own = (lambda x, y: linked(int(some[x]), int(some[y]))) if linked is not None else None
        edges.extend((int(some[x]), int(some[y])) for x, y in _connect(folded, sizes[some], rule, own))
    return edges


def _connect(points: np.ndarray, sizes: np.ndarray, rule: Rule, linked: Callable[[int, int], bool] | None) -> list[tuple[int, int]]:
    if len(sizes) < 2:
        return []
    tree = Tree(points, sizes.astype(np.int64))
    order, edges = tree.order, []
    for seed in range(len(order)):
        if not tree.alive[seed]:
            continue
        tree.drop(np.array([seed]))
        queue = [seed]
        while queue:
            place = queue.pop()
            near = tree.reach(place, rule)
            if linked is not None:
                near = np.array([p for p in near.tolist() if linked(int(order[place]), int(order[p]))], dtype=np.int64)
            if len(near):
                tree.drop(near)
                queue.extend(near.tolist())
                edges.extend((int(order[place]), int(order[p])) for p in near.tolist())
    return edges


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of each group of a stream sorted by integer ``keys``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            if last is not None and (values[start] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            last = values[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _frequencies(docs: DataFrame, rule: Rule) -> np.ndarray:
    """How often shingles fall into each hash bucket, as a power of two over the mean (one byte per bucket)."""
    size = 1 << FREQUENCY_BITS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in all_pieces(batches, limit=PIECE):
            for some in shingles(text_list(batch.column("text")), rule.words):
                np.add.at(counts, (some & np.uint64(size - 1)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size)
    counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return np.clip(np.log2(np.maximum(counts / max(1.0, counts.mean()), 1)), 0, 255).astype(np.uint8)


def _sets(docs: DataFrame, rule: Rule, rare: np.ndarray) -> DataFrame:
    """``doc_id, h, nb, cls, n, point, prefix`` of every row; ``cls`` is null without shingles."""
    held = docs.sparkSession.sparkContext.broadcast(rare)  # 2 ** FREQUENCY_BITS bytes
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = held.value
        for batch in all_pieces(batches, limit=PIECE):
            names, sizes, points, prefixes = [], [], [], []
            for some in shingles(text_list(batch.column("text")), rule.words):
                ranked = np.unique((level[(some & np.uint64(len(level) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | some)
                own = ranked & np.uint64((1 << 56) - 1)
                sizes.append(len(own))
                names.append(int(mix(mix(own).sum(keepdims=True) + np.uint64(len(own))).view(np.int64)[0]) if len(own) else None)
                points.append(np.bincount((mix(own) & np.uint64(rule.groups(len(own)) - 1)).astype(np.int64), minlength=rule.groups(len(own))).astype("<u2").tobytes())
                prefixes.append(own[: rule.prefix(len(own))].view(np.int64) if len(own) else [])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("h"), batch.column("nb"), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(points, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
            ], names=["doc_id", "h", "nb", "cls", "n", "point", "prefix"])

    return docs.mapInArrow(run, f"doc_id {kind}, h long, nb int, cls long, n long, point binary, prefix array<bigint>")


def _pairs_of_blocks(df: DataFrame, blocks: str) -> DataFrame:
    """Copies of each member for every two blocks its own is one of; (0, 0) where there is one block."""
    own = F.col("block")
    others = F.transform(
        F.filter(F.sequence(F.lit(0), F.col(blocks) - 1), lambda i: i != own),
        lambda i: F.struct(F.least(i, own).alias("i"), F.greatest(i, own).alias("j")))
    pair = F.when(F.col(blocks) == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(others)
    return df.withColumn("pair", F.explode(pair)).withColumns({"i": F.col("pair.i"), "j": F.col("pair.j")}).drop("pair")


def _blocked(members: DataFrame, key: str, sizes: DataFrame, member: str = "cls") -> DataFrame:
    """Members with a block number, replicated for every two blocks of their group. ``sizes``: key, members."""
    counted = members.join(sizes, key).withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).drop("members")
    dealt = counted.withColumn("block", F.pmod(F.xxhash64(member, key), F.col("blocks")).cast("int"))
    return _pairs_of_blocks(dealt, "blocks").drop("blocks", "block")


def _candidates(sets: DataFrame, rule: Rule, work: Workspace) -> DataFrame:
    """``a, b``: classes connected through overlap bounds, by links that connect them."""
    rows = sets.filter("cls IS NOT NULL").select("cls", F.explode("prefix").alias("token"))
    shared = rows.groupBy("token").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).filter("least != most").select("token")
    members = work.stage(rows.join(shared, "token").distinct(), "bucket_members")
    # Buckets with the same members are one: their number and the sum of their hashes name them.
    buckets = members.groupBy("token").agg(F.count("*").alias("members"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("mark"))
    kept = buckets.groupBy("members", "mark").agg(F.min("token").alias("token")).select("token", "members")
    points = sets.filter("cls IS NOT NULL").groupBy("cls").agg(F.first("n").alias("n"), F.first("point").alias("point"))
    wide = _blocked(members, "token", kept).join(points, "cls")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in grouped(batches, ["token", "i", "j"]):
            names = group["cls"].to_pylist()
            edges = connect(group["point"].to_pylist(), group["n"].to_numpy(), rule)
            found.extend((names[x], names[y]) for x, y in edges)
            if len(found) > 50_000:
                yield _edge_batch(found)
                found = []
        yield _edge_batch(found)

    dealt = wide.select("token", "i", "j", "cls", "n", "point").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])


def _verified(docs: DataFrame, sets: DataFrame, clusters: DataFrame, rule: Rule, work: Workspace) -> DataFrame:
    """``a, b``: links between classes that connect whatever links connect."""
    named = sets.filter("cls IS NOT NULL").groupBy("cls").agg(F.min(F.struct("h", "nb")).alias("t"), F.first("n").alias("n"), F.first("point").alias("point"))
    members = clusters.withColumnsRenamed({"node": "cls", "label": "cluster"}).join(named, "cls").select("cls", "cluster", "n", "point", "t.h", "t.nb")
    members = work.stage(members, "cluster_members")
    texts = possible(docs.select("h", "nb", "text"), members, "h").groupBy("h", "nb").agg(F.first("text").alias("text")).join(members, ["h", "nb"]).drop("h", "nb")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("members"))
    dealt = _blocked(texts, "cluster", sizes).select("cluster", "i", "j", "cls", "n", "point", "text")
    dealt = dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in grouped(batches, ["cluster", "i", "j"]):
            names, sets_of = group["cls"].to_pylist(), {}
            texts_of = group["text"].cast(pa.binary()).to_pylist()
            for first in range(0, len(texts_of), 256):
                for at, some in enumerate(shingles(texts_of[first : first + 256], rule.words)):
                    sets_of[first + at] = np.unique(some)

            def linked(x: int, y: int) -> bool:
                a, b = sets_of[x], sets_of[y]
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                return 100 * shared >= rule.percent * (len(a) + len(b) - shared)

            edges = connect(group["point"].to_pylist(), group["n"].to_numpy(), rule, linked)
            found.extend((names[x], names[y]) for x, y in edges)
        yield _edge_batch(found)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def classes(df: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Sets of every row (``doc_id, cls, n``, as a table), and ``node, label``: the component of every linked class."""
    text = F.coalesce("text", F.lit(""))
    docs = df.select("doc_id", F.xxhash64(text).alias("h"), F.octet_length(text).alias("nb"), text.alias("text"))
    # Tables go as soon as what is made of them is written.
    buckets, work = Workspace(df.sparkSession, "jaccard_buckets"), Workspace(df.sparkSession, "jaccard_work")
    sets = work.stage(_sets(docs, rule, _frequencies(docs, rule)), "shingle_sets")
    clusters = components(_candidates(sets, rule, buckets), work)
    buckets.clear()
    linked = stage(components(_verified(docs, sets, clusters, rule, work), work), "linked_classes")
    named = stage(sets.select("doc_id", "h", "nb", "cls", "n"), "named_sets")
    work.clear()
    return named, linked


def link(df: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    sets, linked = classes(df, rule)
    named = sets.join(linked.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = named.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``df`` with the smallest id of their component; of rows with that id, one.

    Rows without shingles are all kept.
    """
    row = free_name(df, "row")
    numbered = stage(df.withColumn(row, F.monotonically_increasing_id()), "jaccard_rows")
    named = numbered.select(F.struct("doc_id", F.col(row).alias("row")).alias("doc_id"), "text")
    found = link(named, rule)
    chosen = found.filter("doc_id = component_id").select(F.col("doc_id.row").alias(row))
    return numbered.join(chosen, row, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
