"""Frequent word sequences of a corpus, scored by how much more often they occur than their parts suggest.

Texts are split into pieces and words; a phrase is two to five words of one
piece. Everything is counted per language, in four scans over the texts:

1. words are counted exactly;
2. pairs of words that are both frequent enough are hashed, the hashes are
   dealt to partitions, and each partition keeps a Misra-Gries summary: at most
   ``capacity`` counters, from all of which the smallest excess is taken off
   when there are more. Map tasks send summaries, partitions merge them. The
   capacity exceeds the partition's mass (its n-grams, sent ahead as one row per
   task) divided by the threshold, so what is taken off a counter stays below
   the threshold and every frequent pair keeps a counter;
3. longer n-grams go the same way, if all their pairs may be frequent;
4. n-grams whose counter plus what was taken off reaches the threshold are
   counted exactly, by their words.

The summaries decide only what is counted: equal hashes or a full bitmap let
more through. The bitmaps that carry the frequent words and the surviving
n-grams to all tasks have a fixed size. A sequence that holds a rare word or
pair is rare, so it is dropped before the shuffle.

Cuts, scores and the removal of phrases inside longer ones are joins of the
counted phrases. A phrase lies in a longer one that is as frequent exactly if
it lies in one with one word more that is, so each phrase is compared with its
neighbours in length only. Scores are computed in 38-digit decimals.

Defined results: a null text is empty and gives nothing; a null language is
``und``; repeated rows count as often as they occur; no words give an empty
result; further columns are left out. Words are compared byte for byte after
A-Z are lower-cased.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm import common
from casewright.session import Workspace

#: A-Z to lower case, a tab to a blank, and the signs that end a piece to a line end.
BY_PIECE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
LONGEST = 5
CHUNK_BYTES = 1 << 20
#: N-grams a map task holds before it sums them up, those one hash partition takes in the mean, and counters sent in a row.
HELD, PART_MASS, ROW_PRINTS = 4_000_000, 1 << 22, 1 << 15
#: Hash partitions at most, and those that a task merges one after another in the mean.
MOST_PARTS, TASK_PARTS = 160_000, 8
#: Bits of the maps sent to all tasks: 16 MB each.
MAP_BITS = 27
PRINT_BYTES = 5


@dataclass(frozen=True)
class Words:
    """All words of a chunk: hash with the language, piece number, and where they lie in the chunk's bytes."""

    data: bytes
    hashes: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lang: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the sequences of ``n`` words within a piece."""
        size = max(len(self.hashes) - n + 1, 0)
        at = np.flatnonzero(self.piece[:size] == self.piece[n - 1 : n - 1 + size])
        total = self.hashes[at]
        for i in range(1, n):
            total = common.mix(total * np.uint64(0x9E3779B97F4A7C15) + self.hashes[at + i])
        return at, total


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``CHUNK_BYTES`` that end with a piece."""
    start = 0
    while len(text) - start > CHUNK_BYTES:
        end = text.rfind(b"\n", start, start + CHUNK_BYTES) + 1
        if not end:
            end = text.find(b"\n", start + CHUNK_BYTES) + 1
        if not end:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def chunks(batches: Iterable[pa.RecordBatch], langs: dict[int, str]) -> Iterator[Words]:
    """Words of some texts at a time; ``langs`` learns the languages by their number."""
    for batch in common.all_pieces(batches, limit=CHUNK_BYTES):
        texts = [t.translate(BY_PIECE) for t in common.text_list(batch.column("text"))]
        numbers = []
        for lang in batch.column("lang").to_pylist():
            numbers.append(_number(lang))
            langs.setdefault(numbers[-1], lang)
        held, owner, size = [], [], 0
        for text, number in zip(texts, numbers):
            for part in _parts(text):
                held.append(part)
                owner.append(number)
                size += len(part)
                if size >= CHUNK_BYTES:
                    yield _words(held, owner)
                    held, owner, size = [], [], 0
        if held:
            yield _words(held, owner)


def _number(lang: str) -> int:
    raw = lang.encode()
    return zlib.crc32(raw) << 32 | zlib.crc32(raw[::-1], 1)


def _words(texts: list[bytes], owner: list[int]) -> Words:
    data = b"\n".join(texts) + b"\n"
    chars = np.frombuffer(data, dtype=np.uint8)
    line = chars == 10
    blank = line | (chars == 32)
    before = np.concatenate([[True], blank[:-1]])
    start, end = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    piece = np.cumsum(line)[start]
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    lang = np.repeat(np.array(owner, dtype=np.uint64), np.diff(np.searchsorted(start, bounds)))
    hashes = common.mix(common.span_hash(common.running_hash(chars), start, end) ^ lang)
    return Words(data, hashes, piece, start, end, lang)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def _same_as(words: Words, other: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether each span of words has the bytes and the language of the span at the index ``other``."""
    chars = np.frombuffer(words.data, dtype=np.uint8)
    start, size = words.start[first], words.end[last] - words.start[first]
    same = (size == size[other]) & (words.lang[first] == words.lang[first][other])
    at = np.flatnonzero(same)
    if len(at):
        size = size[at]
        heads = np.cumsum(size) - size
        offset = np.arange(int(size.sum())) - np.repeat(heads, size)
        equal = chars[np.repeat(start[at], size) + offset] == chars[np.repeat(start[other[at]], size) + offset]
        same[at] = np.logical_and.reduceat(equal, heads)
    return same


class _Texts:
    """Exact counts of (language, words) in a task, flushed when there are many."""

    def __init__(self, langs: dict[int, str], limit: int = 300_000):
        self.langs, self.limit, self.counts = langs, limit, {}

    def add(self, words: Words, first: np.ndarray, last: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count the spans from the words ``first`` to the words ``last``.

        Spans of equal hash are counted together once their bytes are compared.
        """
        if len(hashes):
            _, index, inverse, together = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            apart = np.flatnonzero(~_same_as(words, index[inverse], first, last))
            np.subtract.at(together, inverse[apart], 1)
            self._count(words, first[index], last[index], together)
            self._count(words, first[apart], last[apart], np.ones(len(apart), np.int64))
        if len(self.counts) > self.limit:
            yield self.flush()

    def _count(self, words: Words, first: np.ndarray, last: np.ndarray, times: np.ndarray) -> None:
        counts, data = self.counts, words.data
        for lang, a, b, n in zip(words.lang[first].tolist(), words.start[first].tolist(), words.end[last].tolist(), times.tolist()):
            key = lang, data[a:b]
            counts[key] = counts.get(key, 0) + n

    def flush(self) -> pa.RecordBatch:
        keys, self.counts, old = list(self.counts), {}, self.counts
        # Blanks between words may differ; the words joined by one blank are the phrase.
        phrases = [b" ".join(k[1].split()) for k in keys]
        return pa.RecordBatch.from_arrays(
            [pa.array([self.langs[k[0]] for k in keys], pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array([old[k] for k in keys], pa.int64())],
            ["lang", "phrase", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of all single words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[int, str] = {}
        texts = _Texts(langs)
        for words in chunks(batches, langs):
            everything = np.arange(len(words.hashes))
            yield from texts.add(words, everything, everything, words.hashes)
        yield texts.flush()

    return _rows(docs).mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


class Bits:
    """A set of hashes as a map of fixed size, by their lowest bits."""

    def __init__(self, bits: int = MAP_BITS):
        self.mask = np.uint64((1 << bits) - 1)
        self.words = np.zeros(1 << bits - 6, dtype=np.uint64)

    @staticmethod
    def of(spots: pa.Table, bits: int = MAP_BITS) -> Bits:
        out = Bits(bits)
        out.words[spots["at"].to_numpy()] = spots["bits"].to_numpy().view(np.uint64)
        return out

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bits_of(df: DataFrame, bits: int = MAP_BITS) -> Bits:
    """The map of column ``print``; at most ``2 ** (bits - 6)`` rows reach the driver."""
    spot = F.pmod("print", F.lit(1 << bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))
    return Bits.of(df.select((spot / 64).cast("int").alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow(), bits)


def _prints(words: DataFrame) -> DataFrame:
    """Hashes of single words, as the scans compute them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.text_list(batch.column("phrase"))
            hashes = _words(texts, [_number(x) for x in batch.column("lang").to_pylist()]).hashes if texts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["print"])

    return words.select("lang", "phrase").mapInArrow(run, "print long")


class Summary:
    """Misra-Gries counters over sorted prints; summaries merge by adding counters and taking the excess off."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.prints, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def merge(self, prints: np.ndarray, counts: np.ndarray, taken: int = 0) -> None:
        self.taken += taken
        self.waiting.append((prints, counts))
        self.size += len(prints)
        if self.size > max(self.capacity, 1 << 18):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        prints = np.concatenate([self.prints, *(p for p, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        order = np.argsort(prints, kind="stable")
        prints = prints[order]
        heads = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, np.int64)
        self.prints = prints[heads]
        self.counts = np.add.reduceat(counts[order], heads) if len(heads) else counts
        if len(self.counts) > self.capacity:
            # The largest count that does not keep a counter.
            excess = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.taken += excess
            keep = self.counts > excess
            self.prints, self.counts = self.prints[keep], self.counts[keep] - excess

    def reaching(self, threshold: int) -> np.ndarray:
        """Prints that may have occurred that often."""
        self.settle()
        return self.prints[self.counts + self.taken >= threshold]


def capacity(mass: int, threshold: int) -> int:
    """Counters that exceed the mass divided by the threshold."""
    return mass // threshold + 1


PART_ROWS = "part long, kind int, mass long, prints binary, counts binary"


def _short(prints: np.ndarray) -> bytes:
    return prints.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PRINT_BYTES].tobytes()


def _long(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // PRINT_BYTES, 8), dtype=np.uint8)
    wide[:, :PRINT_BYTES] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, PRINT_BYTES)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


@dataclass(frozen=True)
class Filters:
    """Maps of the frequent words and, once they are known, of the pairs that may be frequent."""

    words: Bits
    pairs: Bits | None = None

    def runs(self, words: Words, sizes: Iterable[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first words, hashes) of the sequences all of whose words, and pairs of neighbours, may be frequent."""
        rare = np.concatenate([[0], np.cumsum(~self.words.has(words.hashes))])
        if self.pairs is not None:
            at, hashes = words.grams(2)
            broken = np.ones(len(words.hashes), dtype=bool)
            broken[at[self.pairs.has(hashes)]] = False
            broken = np.concatenate([[0], np.cumsum(broken)])
        for n in sizes:
            at, hashes = words.grams(n)
            sound = rare[at + n] == rare[at]
            if self.pairs is not None:
                sound &= broken[at + n - 1] == broken[at]
            yield n, at[sound], hashes[sound]


def candidate_prints(docs: DataFrame, filters: Filters, parts: int, threshold: int, sizes: range) -> DataFrame:
    """``print`` of every hash of n-grams of the given sizes that its partition's summary cannot rule out."""
    held = docs.sparkSession.sparkContext.broadcast(filters)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def summed() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(waiting), return_counts=True)
            # The upper half of a hash names the partition, so the sorted hashes lie in order of partitions.
            part = (hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            rows = []
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(part)]):
                rows.append((int(part[a]), 0, int(counts[a:b].sum()), None, None))
                for c in range(a, b, ROW_PRINTS):
                    d = min(c + ROW_PRINTS, b)
                    rows.append((int(part[a]), 1, None, _short(hashes[c:d]), counts[c:d].astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                ["part", "kind", "mass", "prints", "counts"])

        for words in chunks(batches, {}):
            for _, _, hashes in held.value.runs(words, sizes):
                waiting.append(hashes)
                size += len(hashes)
            if size > HELD:
                yield summed()
                waiting, size = [], 0
        if size:
            yield summed()

    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(summary: Summary) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(summary.reaching(threshold).view(np.int64))], ["print"])

        part = summary = None
        mass = 0
        for batch in batches:
            for number, kind, more, prints, counts in zip(*(batch.column(i) for i in range(5))):
                if number.as_py() != part:
                    if summary is not None:
                        yield out(summary)
                    part, summary, mass = number.as_py(), None, 0
                if kind.as_py() == 0:
                    mass += more.as_py()
                    continue
                summary = summary or Summary(capacity(mass, threshold))
                summary.merge(_long(prints.as_buffer().to_pybytes()), np.frombuffer(counts.as_buffer(), "<u4").astype(np.int64))
        if summary is not None:
            yield out(summary)

    sent = _rows(docs).mapInArrow(scan, PART_ROWS)
    dealt = sent.repartition(1 + parts // TASK_PARTS, "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(reduce, "print long")


def count_phrases(docs: DataFrame, filters: Filters, longer: Bits, threshold: int, sizes: range) -> DataFrame:
    """``lang, phrase, n`` of all surviving n-grams, counted by their words."""
    context = docs.sparkSession.sparkContext
    held, long_bits = context.broadcast(filters), context.broadcast(longer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[int, str] = {}
        texts = _Texts(langs)
        for words in chunks(batches, langs):
            for n, at, hashes in held.value.runs(words, sizes):
                if n > 2:
                    kept = long_bits.value.has(hashes)
                    at, hashes = at[kept], hashes[kept]
                yield from texts.add(words, at, at + n - 1, hashes)
        yield texts.flush()

    counted = _rows(docs).mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= threshold)


def frequent_phrases(docs: DataFrame, work: Workspace, threshold: int = 100, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases and frequent words with their counts, and the number of words per language."""
    words = work.stage(count_words(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    mass = words.agg(F.sum("n")).first()[0] or 0
    common_words = words.filter(F.col("n") >= threshold)
    filters, longer = Filters(bits_of(_prints(common_words))), Bits()
    for sizes in (range(2, 3), range(3, longest + 1)):
        parts = min(1 + mass * len(sizes) // PART_MASS, MOST_PARTS)
        longer = bits_of(work.stage(candidate_prints(docs, filters, parts, threshold, sizes), "prints"))
        filters = filters if filters.pairs else Filters(filters.words, longer)
    phrases = work.stage(count_phrases(docs, filters, longer, threshold, range(2, longest + 1)), "phrases")
    return phrases, common_words, totals


def _between(words: Column, first: int | Column, count: int | Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(docs: DataFrame, work: Workspace, threshold: int = 100, longest: int = LONGEST, best: int = 2000) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a``: occurrences; ``l``, ``r``: those of the parts at the cut with the lowest
    score ``1000 * a * n / (l * r)``, rounded down; ``n``: words of the language.
    """
    phrases, words, totals = frequent_phrases(docs, work, threshold, longest)
    known = phrases.unionByName(words)
    sized = phrases.withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " ")).withColumn("size", F.size("words"))

    longer = sized.filter("size > 2").select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.array(_between(F.col("words"), 1, F.col("size") - 1), _between(F.col("words"), 2, F.col("size") - 1))).alias("phrase"))
    inside = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = sized.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR 100 * longer < 100 * a")

    cuts = kept.select("lang", "phrase", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _between(F.col("words"), 1, F.col("k")).alias("first"), _between(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    number = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(F.broadcast(totals) if _few(totals) else totals, "lang")
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (number("a") * number("total")), number("l") * number("r"))
    lowest = (
        scored.withColumn("score", score).groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", F.col("total").alias("n"))).alias("cut")).select("lang", "phrase", "cut.*")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _few(totals: DataFrame, limit: int = 10_000) -> bool:
    """Whether the languages are few enough to be sent to all tasks."""
    return totals.limit(limit + 1).count() <= limit
