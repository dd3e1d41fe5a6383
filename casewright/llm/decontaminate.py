"""Verbatim overlaps of documents with benchmark items, by suffix arrays over the documents' words.

each block of documents (a shard of about a megabyte) gets a suffix array of its
words. Every suffix of every benchmark item is looked up in it by binary search;
windows of ``window`` words (the whole item, if it is shorter) that occur give
the documents' places, and consecutive places are joined into longest matches.
No text is shuffled: the benchmark, a stated query set, goes to every shard.

A benchmark beyond ``PASS_BYTES`` is dealt into passes of about that size, written
as a table. One pass at a time is loaded, searched and its hits written, so neither
the driver nor a task holds more of it; each pass reads all documents. Words are
compared by 64-bit hashes.

Defined results: null and empty texts, and texts of signs only, have no words
and no hits; items without words match nothing, items with a null id match under
the empty id; repeated documents or items are each handled as they are; an empty
benchmark hits nothing; other columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import BY_SIGN, all_pieces, free_name, text_list, word_hashes
from casewright.session import fresh_path, stage

WINDOW = 10
PASS_BYTES = 4 << 20
_PACK, _STEP = 21, 3
_FULL = (1 << _PACK) - 1


@dataclass(frozen=True)
class Items:
    """Benchmark items that have words: ids, word hashes end to end, and bounds."""

    ids: list[str]
    words: np.ndarray
    bounds: np.ndarray


class Shard:
    """Suffix array over the words of some texts, in order of at least ``depth`` words."""

    def __init__(self, texts: list[bytes], depth: int = WINDOW, asked: np.ndarray | None = None):
        hashes, self.sizes = word_hashes(texts, BY_SIGN)
        self.values, rank = np.unique(hashes, return_inverse=True)
        if len(self.values) >= _FULL and asked is not None:
            # One huge text: words that are not asked for need no number of their own.
            self.values = np.unique(asked)
            spot = np.minimum(np.searchsorted(self.values, hashes), len(self.values) - 1)
            rank = np.where(self.values[spot] == hashes, spot, len(self.values))
        # A zero ends each text, so no match goes on into the next one.
        self.first = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.text = np.repeat(np.arange(len(texts)), self.sizes + 1)
        words = np.zeros(self.first[-1] + depth + _STEP, dtype=np.int64)
        place = np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), self.sizes)
        words[place] = rank + 1
        self.words = words
        n = len(words) - _STEP + 1
        self.keys = words[:n] << (2 * _PACK) | words[1 : n + 1] << _PACK | words[2 : n + 2]
        self.order = place[np.argsort(self.keys[place], kind="stable")]
        self.sorted = self.keys[self.order]
        group = np.concatenate([[0], np.cumsum(self.sorted[1:] != self.sorted[:-1])]) if len(self.order) else np.zeros(0, np.int64)
        for done in range(_STEP, depth, _STEP):
            same = np.zeros(len(group) + 1, dtype=bool)
            same[1:-1] = group[1:] == group[:-1]
            tied = np.flatnonzero(same[1:] | same[:-1])  # suffixes alike so far
            if not len(tied):
                break
            at = self.order[tied]
            # A text that has ended is told from none by nothing that follows.
            more = np.where(self.keys[at + done - _STEP] & _FULL == 0, 0, self.keys[np.minimum(at + done, len(self.keys) - 1)])
            again = np.lexsort((more, group[tied]))
            self.order[tied], more = at[again], more[again]
            new = np.zeros(len(tied), dtype=np.int64)
            new[1:] = (more[1:] != more[:-1]) & (group[tied][1:] == group[tied][:-1])
            # Keep group numbers in order while splitting them.
            group = group * 1
            bump = np.zeros(len(group), dtype=np.int64)
            bump[tied] = new
            step = np.concatenate([[0], (group[1:] != group[:-1]).astype(np.int64)])
            group = np.cumsum(np.maximum(step, bump))

    def search(self, items: Items, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places where a window of an item occurs: item, first word in the item, place in ``words``, length."""
        spot = np.minimum(np.searchsorted(self.values, items.words), max(0, len(self.values) - 1))
        known = self.values[spot] == items.words if len(self.values) else np.zeros(len(items.words), bool)
        ranks = np.where(known, spot + 1, -1)
        sizes = np.diff(items.bounds)
        length = np.minimum(sizes, window)
        count = sizes - length + 1
        item = np.repeat(np.arange(len(sizes)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(items.bounds[:-1], count)
        size = length[item]
        padded = np.concatenate([ranks, np.full(_STEP, -1)])
        heads = [np.where(size > j, padded[start + j], 0) for j in range(_STEP)]
        fine = np.all([h >= 0 for h in heads], axis=0)
        item, start, size, heads = item[fine], start[fine], size[fine], [h[fine] for h in heads]
        low = heads[0] << (2 * _PACK) | heads[1] << _PACK | heads[2]
        high = low | np.where(size < 2, _FULL << _PACK, 0) | np.where(size < 3, _FULL, 0)
        begin, end = np.searchsorted(self.sorted, low, "left"), np.searchsorted(self.sorted, high, "right")
        found = []
        for k in np.flatnonzero(begin < end):
            a, b = int(begin[k]), int(end[k])
            for depth in range(_STEP, int(size[k])):
                word = padded[start[k] + depth]
                column = self.words[self.order[a:b] + depth]
                a, b = a + int(np.searchsorted(column, word, "left")), a + int(np.searchsorted(column, word, "right"))
                if a == b or word < 0:
                    b = a
                    break
            if a < b:
                found.append((k, self.order[a:b]))
        if not found:
            return (np.zeros(0, np.int64),) * 4
        which = np.repeat([k for k, _ in found], [len(p) for _, p in found])
        return item[which], start[which] - items.bounds[item[which]], np.concatenate([p for _, p in found]), size[which]

    def spans(self, items: Items, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
        """Longest matches: (text, item, first word in the text, first word in the item, words)."""
        item, start, place, size = self.search(items, window)
        if not len(item):
            return []
        order = np.lexsort((start, place - start, item))
        item, start, place, size = item[order], start[order], place[order], size[order]
        # Consecutive windows of one item on one diagonal are one match.
        head = np.ones(len(item), dtype=bool)
        head[1:] = (item[1:] != item[:-1]) | (place[1:] - place[:-1] != 1) | (start[1:] - start[:-1] != 1)
        first = np.flatnonzero(head)
        last = np.concatenate([first[1:], [len(item)]]) - 1
        words = start[last] - start[first] + size[last]
        text = self.text[place[first]]
        return list(zip(text.tolist(), item[first].tolist(), (place[first] - self.first[text]).tolist(), start[first].tolist(), words.tolist(), strict=True))


def _numbered(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """``item, text, pass`` of the items that have text, and the number of passes of about ``PASS_BYTES`` bytes each."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").filter(F.octet_length("text") > 0)
    passes = max(1, -(-(items.agg(F.sum(F.octet_length("item") + F.octet_length("text"))).first()[0] or 0) // PASS_BYTES))
    if passes == 1:
        return items.withColumn("pass", F.lit(0)), 1
    path = fresh_path(benchmark.sparkSession, "benchmark_passes")
    # By row, so that equal items spread too.
    items.withColumn("pass", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(passes)).cast("int")).repartition("pass").write.partitionBy("pass").parquet(path)
    return benchmark.sparkSession.read.schema("item string, text string, pass int").parquet(path), passes


def _load(items: DataFrame, number: int) -> Items:
    """The items of one pass that have words."""
    rows = [(row["item"], row["text"].encode()) for row in items.filter(F.col("pass") == number).select("item", "text").toLocalIterator()]
    words, sizes = word_hashes([b for _, b in rows], BY_SIGN) if rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    there = sizes > 0
    return Items([i for (i, _), ok in zip(rows, there, strict=True) if ok], words, np.concatenate([[0], np.cumsum(sizes[there])]))


_SPANS = "array<struct<doc_word:int,n_words:int,item:string,item_word:int>>"


def _search_pass(docs: DataFrame, items: Items, window: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(items)
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("doc_word", pa.int32()), ("n_words", pa.int32()), ("item", pa.string()), ("item_word", pa.int32())]))
        for batch in all_pieces(batches):
            shard = Shard(text_list(batch.column("text")), window, held.value.words)
            rows: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for text, item, place, start, n in shard.spans(held.value, window):
                rows[text].append({"doc_word": place, "n_words": n, "item": held.value.ids[item], "item_word": start})
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(shard.sizes.astype(np.int64)), pa.array(rows, kind)], names=[*names, "n_words", "spans"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(run, f"{kinds}, n_words long, spans {_SPANS}")


def search(df: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, spans`` for every document; spans are in order of place."""
    numbered, passes = _numbered(benchmark)
    docs = df.select("doc_id", "text")
    if passes == 1:
        return _search_pass(docs, _load(numbered, 0), window).withColumn("spans", F.array_sort("spans"))
    docs = stage(docs.withColumn("row", F.monotonically_increasing_id()), "contamination_rows")
    found = None
    for number in range(passes):
        # Every document comes out of the first pass, of the others those with hits.
        one = stage(_search_pass(docs, _load(numbered, number), window).filter((F.size("spans") > 0) | F.lit(number == 0)), "contamination_spans")
        found = one if found is None else found.unionByName(one)
    whole = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"))
    return whole.select("doc_id", "n_words", F.array_sort("spans").alias("spans"))


def hit_words(spans: str = "spans") -> Column:
    """Words inside any span; spans are sorted by place."""
    def grow(state: Column, span: Column) -> Column:
        end = span["doc_word"] + span["n_words"]
        new = F.greatest(F.lit(0), end - F.greatest(span["doc_word"], state["end"]))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["end"], end).alias("end"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), grow, lambda s: s["n"].cast("long"))


def clean(df: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` that no benchmark window occurs in, all columns unchanged."""
    numbered, passes = _numbered(benchmark)
    if passes == 1:
        return _clean_pass(df, _load(numbered, 0), window)
    row = free_name(df, "row")
    docs = stage(df.withColumn(row, F.monotonically_increasing_id()), "contamination_rows")
    hit = None
    for number in range(passes):
        texts = docs.select(F.col(row).alias("row"), "text")
        one = stage(_search_pass(texts, _load(numbered, number), window).filter(F.size("spans") > 0).select(F.col("row").alias(row)), "contamination_hits")
        hit = one if hit is None else hit.unionByName(one)
    return docs.join(hit.distinct(), row, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def _clean_pass(df: DataFrame, items: Items, window: int) -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batches):
            hit = {s[0] for s in Shard(text_list(batch.column("text")), window, held.value.words).spans(held.value, window)}
            yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)]))

    return df.mapInArrow(run, df.schema)
