"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes, with the count of
every next byte. A byte is coded in the longest context seen in training; if it
never followed that context, an escape (half a count for each different
successor, taken from that successor) leads to the next shorter one, where the successors already ruled
out are excluded. Below the empty context all bytes left are equally likely. A
byte that no text holds pads the start and ends each text, so scores are
probabilities of whole texts.

Training counts come from all training documents: tasks count the byte strings
of ``ORDER + 1`` bytes and the words of their part, one aggregation sums them.
All successors seen in a context were also seen in its suffix. So exclusion only
needs, per context, the summed counts its successors have in the suffix, and the
trie becomes a few sorted arrays.

The trie is cut into shards by the last two context bytes; each has about
``SHARD_ENTRIES`` strings and scores the bytes whose context belongs to it in a
pass of its own, so no task and no broadcast holds more (one shard is the rule
up to that size). Its numbers have no more bytes than the largest needs, as each
Python worker holds a copy and the executor one more. For the word baseline the
``TOP_WORDS`` most frequent words are sent to all tasks; all other words are
looked up by an equality join.

Defined results: null and empty texts consist of the end only; equal texts have
equal scores; with no training document the model is uniform and the baseline's
counts are 0; an empty table gives an empty result; extra columns are ignored.
Words and strings are identified by 64 bits (words by hash).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import BY_SPACE, all_pieces, documents, fold, text_list, word_hashes
from casewright.session import stage

ORDER = 5
SHARD_ENTRIES = 2 << 20
TOP_WORDS = 1 << 20
#: Strings or words a counting task holds before it joins equal ones, and rows it hands on at once.
HELD, ROWS_OUT = 2 << 20, 1 << 16
SCORE_BYTES = 1 << 19  # bytes of text scored together; each takes some 60 bytes
END = 0xFF  # in no UTF-8 text
END_WORD = np.uint64(1)
_U8, _MIX = np.uint64(8), np.uint64(0x9E3779B97F4A7C15)


def strings(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of each text and its end: context and byte as one number; and how many each text has."""
    pad, end = bytes([END]) * order, bytes([END])
    buffer = b"".join([x for t in texts for x in (pad, t, end)])
    chars = np.frombuffer(buffer, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    code = chars[: len(chars) - order].astype(np.uint64)
    for i in range(1, order + 1):
        code <<= _U8
        code |= chars[i : len(chars) - order + i]
    keep = np.ones(len(code) + order, dtype=bool)
    starts = np.cumsum(sizes + order) - (sizes + order)
    for i in range(order):
        keep[starts + i] = False  # these predict the padding
    return code[keep[order:]], sizes


class Lookup:
    """Place of numbers in a sorted array: a direct table first, binary search for those it misses."""

    def __init__(self, keys: np.ndarray, weight: np.ndarray):
        self.keys = keys
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2))))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=np.int32)
        order = np.argsort(weight, kind="stable")
        self.table[(keys[order] * _MIX) >> self.shift] = order  # of two keys the heavier one stays

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Index of each number, -1 if it is not there."""
        if not len(self.keys):
            return np.full(len(wanted), -1, dtype=np.int64)
        at = self.table[(wanted * _MIX) >> self.shift].astype(np.int64)
        missed = np.flatnonzero(self.keys[at] != wanted)
        spot = np.minimum(np.searchsorted(self.keys, wanted[missed]), len(self.keys) - 1)
        at[missed] = np.where(self.keys[spot] == wanted[missed], spot, -1)
        return at


def _mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    head = np.ones(len(keys), dtype=bool)
    head[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(head)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    del order
    first = _heads(keys)
    return keys[first], np.add.reduceat(counts, first)


def _small(numbers: np.ndarray) -> np.ndarray:
    """The same whole numbers, none negative, in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(numbers.max(initial=0)))


class Tally:
    """Counts of keys, held up to ``limit`` entries; equal ones are joined before any are given up."""

    def __init__(self, limit: int = HELD):
        self.limit, self.size = limit, 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > self.limit:
            found, n = self.joined()
            if len(found) > self.limit // 2:
                yield from self._rows(found, n)
            else:
                self.parts, self.size = [(found, n)], len(found)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.parts:
            yield from self._rows(*self.joined())

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts])
        self.parts, self.size = [], 0
        return _summed(keys, counts)

    @staticmethod
    def _rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for start in range(0, len(keys), ROWS_OUT):
            yield keys[start : start + ROWS_OUT], counts[start : start + ROWS_OUT]


class Trie:
    """All contexts of the given strings, with totals, successors and excluded counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, order: int = ORDER):
        """``codes``: strings of ``order + 1`` bytes; ``pairs``: all strings of two bytes, whatever their shard."""
        self.order = order
        levels = {order: _summed(codes, counts)}
        for k in range(order - 1, -1, -1):
            source = levels[order] if k > 1 else (pairs, pair_counts)
            levels[k] = _summed(source[0] & _mask(k + 1), source[1])
        self.codes = {k: levels[k][0] for k in range(order)}
        self.counts = {k: _small(levels[k][1]) for k in range(order)}
        self.contexts, self.total, self.kinds, self.ruled_out = {}, {}, {}, {}
        for k, (own, times) in levels.items():
            contexts = own >> _U8
            first = _heads(contexts)
            total, kinds = np.add.reduceat(times, first), np.diff(np.append(first, len(own)))
            self.contexts[k], self.total[k], self.kinds[k] = contexts[first], _small(total), _small(kinds)
            if k:
                below = levels[k - 1][1][np.searchsorted(levels[k - 1][0], own & _mask(k))]
                self.ruled_out[k] = _small(np.add.reduceat(below, first))
            if k == order:
                self.logs = np.log10((times - 0.5) / np.repeat(total, kinds))
        self.find = Lookup(*levels[order])

    @staticmethod
    def place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return spot, keys[spot] == wanted

    def score(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each byte after its context."""
        at = self.find.find(codes)
        out = self.logs[at] if len(self.logs) else np.zeros(len(codes))
        out = np.where(at >= 0, out, 0.0)
        left = np.flatnonzero(at < 0)
        gone, ruled = np.zeros(len(left)), np.zeros(len(left))  # different successors excluded, and their count in this context
        for k in range(self.order, -1, -1):
            code = codes[left]
            spot, there = self.place(self.contexts[k], (code >> _U8) & _mask(k))
            if not len(self.contexts[k]):
                continue
            total, kinds = self.total[k][spot] - ruled, self.kinds[k][spot] - gone
            whole = np.where(there & (total > 0), total, 1.0)
            known = np.zeros(len(left), dtype=bool)
            if k < self.order:  # those known in the longest context are not left
                entry, known = self.place(self.codes[k], code & _mask(k + 1))
                known &= there
                out[left[known]] += np.log10((self.counts[k][entry[known]] - 0.5) / whole[known])
            escape = there & ~known & (kinds > 0)
            out[left[escape]] += np.log10(0.5 * kinds[escape] / whole[escape])
            gone = np.where(there, self.kinds[k][spot], gone)
            ruled = np.where(there, self.ruled_out[k][spot], 0.0) if k else ruled
            left, gone, ruled = left[~known], gone[~known], ruled[~known]
        out[left] -= np.log10(256 - gone)
        return out


def count(df: DataFrame, order: int = ORDER) -> DataFrame:
    """``kind, code, n``: counts of byte strings (kind 0) and of words and ends (kind 1) over all rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {0: Tally(), 1: Tally()}

        def rows(kind: int, found: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for keys, n in found:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys.view(np.int64)), pa.array(n)], names=["kind", "code", "n"])

        for batch in all_pieces(batches):
            texts = text_list(batch.column("text"))
            words = word_hashes(texts, BY_SPACE)[0]
            words = np.concatenate([words, np.full(len(texts), END_WORD)])
            for kind, keys in ((0, strings(texts, order)[0]), (1, words)):
                yield from rows(kind, held[kind].add(keys))
        for kind in held:
            yield from rows(kind, held[kind].rest())

    parts = documents(df, "text").mapInArrow(run, "kind byte, code long, n long")
    return parts.groupBy("kind", "code").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Words:
    """The most frequent words with their counts, and the totals of all."""

    keys: np.ndarray
    counts: np.ndarray
    tokens: int
    kinds: int


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.select("code", "n").toArrow()
    codes, counts = table["code"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(codes)
    return codes[order], counts[order]


def frequent_words(counts: DataFrame, limit: int = TOP_WORDS) -> tuple[Words, int]:
    """At most ``limit`` words, those above a count; and that count."""
    words = counts.filter("kind = 1")
    # One row per different count.
    sizes = sorted((r["n"], r["m"]) for r in words.groupBy("n").agg(F.count("*").alias("m")).collect())
    tokens, kinds, bar, room = sum(n * m for n, m in sizes), sum(m for _, m in sizes), 0, limit
    for n, m in reversed(sizes):
        room -= m
        if room < 0:
            bar = n
            break
    keys, numbers = _arrays(words.filter(F.col("n") > bar))
    return Words(keys, _small(numbers), tokens, kinds), bar


def shard_count(counts: DataFrame, entries: int = SHARD_ENTRIES) -> int:
    return max(1, -(-counts.filter("kind = 0").count() // entries))


def trie_of(counts: DataFrame, shard: int, shards: int, order: int = ORDER) -> Trie:
    """One shard of the trie; strings of two bytes, at most 65,536, are in all."""
    grams = counts.filter("kind = 0")
    pairs = _arrays(grams.groupBy(F.col("code").bitwiseAND(F.lit(0xFFFF)).alias("code")).agg(F.sum("n").alias("n")))
    own = grams if shards == 1 else grams.filter(F.pmod(F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF)) * 40503 % 65537, F.lit(shards)) == shard)
    return Trie(*_arrays(own), *pairs, order)


def _shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return ((codes >> _U8) & np.uint64(0xFFFF)) * np.uint64(40503) % np.uint64(65537) % np.uint64(shards)


def _trie_pass(docs: DataFrame, shard: int, shards: int, trie: Trie) -> DataFrame:
    """``row, score``: what the bytes of one shard add, as a table."""
    held = docs.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batches, limit=SCORE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(_scores(text_list(batch.column("text")), held.value, shard, shards))], names=["row", "score"])

    part = stage(docs.select("row", "text").mapInArrow(run, "row long, score double"), "lm_part")
    held.destroy()
    return part


def _scores(texts: list[bytes], trie: Trie, shard: int, shards: int) -> np.ndarray:
    codes, sizes = strings(texts, trie.order)
    logs = trie.score(codes) if shards == 1 else np.zeros(len(codes))
    if shards > 1:
        own = _shard_of(codes, shards) == shard
        logs[own] = trie.score(codes[own])
    return np.add.reduceat(logs, np.cumsum(sizes) - sizes)


def score(df: DataFrame, training: DataFrame, order: int = ORDER, entries: int = SHARD_ENTRIES, top: int = TOP_WORDS) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``df``, learned from ``training``."""
    counts = stage(count(training, order), "lm_counts")
    words, bar = frequent_words(counts, top)
    shards = shard_count(counts, entries)
    docs = documents(df, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    if shards > 1:
        docs = stage(docs, "lm_rows")  # the passes name rows alike
    sc = df.sparkSession.sparkContext
    held_trie, held_words = sc.broadcast(trie_of(counts, 0, shards, order)), sc.broadcast((words, Lookup(words.keys, words.counts)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, finder = held_words.value
        whole = known.tokens + 0.5 * (known.kinds + 1)
        for batch in all_pieces(batches, limit=SCORE_BYTES):
            texts = text_list(batch.column("text"))
            hashes, sizes = word_hashes(texts, BY_SPACE)
            # Each text's words, then its end.
            keys = np.insert(hashes, np.cumsum(sizes), END_WORD)
            sizes = sizes + 1
            at = finder.find(keys)
            logs = np.where(at >= 0, np.log10((known.counts[at] if len(known.counts) else np.zeros(len(at))) + 0.5) - np.log10(whole), 0.0)
            starts = np.cumsum(sizes) - sizes
            rare = at < 0
            bounds = np.concatenate([[0], np.cumsum(np.add.reduceat(rare, starts, dtype=np.int64))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row"), pa.array(sizes), pa.array(np.add.reduceat(at >= 0, starts, dtype=np.int64)),
                pa.array(np.add.reduceat(logs, starts)), pa.array(_scores(texts, held_trie.value, 0, shards)),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[rare].view(np.int64))),
            ], names=["doc_id", "row", "n_tokens", "n_known", "base_score", "score", "rare"])

    kind = df.schema["doc_id"].dataType.simpleString()
    parts = stage(docs.mapInArrow(run, f"doc_id {kind}, row long, n_tokens long, n_known long, base_score double, score double, rare array<bigint>"), "lm_scores")
    held_trie.destroy()
    held_words.destroy()
    passes = [_trie_pass(docs, n, shards, trie_of(counts, n, shards, order)) for n in range(1, shards)]
    scores = parts.select("row", "score")
    for part in passes:
        scores = scores.unionByName(part)
    if passes:
        parts = parts.drop("score").join(scores.groupBy("row").agg(F.sum("score").alias("score")), "row")
    whole = words.tokens + 0.5 * (words.kinds + 1)
    missing = parts.select("row", F.explode("rare").alias("code")).groupBy("row", "code").agg(F.count("*").alias("times"))
    seldom = counts.filter("kind = 1").filter(F.col("n") <= bar).select("code", "n")
    looked_up = missing.join(seldom, "code", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rest = looked_up.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * (F.log10(F.col("n") + 0.5) - float(np.log10(whole)))).alias("more_score"),
    )
    joined = parts.drop("rare").join(rest, "row", "left")
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more_score", F.lit(0.0))).alias("base_score"), "score",
    )


def training_fold(df: DataFrame, held_out: int = 1) -> DataFrame:
    return df.filter(fold() != held_out)
