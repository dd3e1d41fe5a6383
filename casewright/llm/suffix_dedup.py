"""Removal of long repeated byte strings, by a logarithmic family of sampled suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts at
another place of the corpus. Suffixes are sampled by content: every window of
``length`` bytes has an anchor, the start of its smallest hashed ``GRAM``-byte
string. Equal windows have the same anchor, so only anchors are indexed (about
two per ``length`` bytes). Neighbouring windows with one anchor form a run; its
text is the run's context.

The index holds, in order of key, one entry per anchor and half: the key is the
hash of the ``length / 2`` bytes before or after the anchor, one of which lies
in any window. Equal contexts share an entry with a count, so copies cost
nothing. Every ``BATCH_BYTES`` of text are a batch. Batches and levels are stored in
the same ranges of keys and in order inside them. A new batch is merge-scanned
against all levels, and then joins the family: two levels of a size are merged to
one of twice the size as they lie, and their own tables go.

Contexts that occur more than once are repeats throughout. For the others, which
share a key with a different context, each window is compared by hash. Tasks
settle what repeats among their own rows first, so a passage in very many
documents sends a few rows per task, not one per document.

With ``words``, lengths and places count words instead of bytes: a passage goes if
``length`` words in a row also start at another place, however many bytes they
have. Words lie between ASCII white space, of any kind and amount, and are
compared by 64-bit hashes of their bytes; a word goes with the white space behind
it, a text's first word also with that before it.

Texts are named by their 64-bit hash and size; equal texts are handled once.
Windows are compared by 64-bit hashes.

Defined results: null and empty texts, and texts under ``length`` bytes (or
words), lose nothing; equal texts of that length or more lose all; matches within one text
count, also overlapping ones; an empty table gives an empty result; other
columns are never read by ``repeats``; ``cleaned`` keeps them as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import all_pieces, mix, possible, running_hash, slices, span_hash, text_list, word_hashes
from casewright.session import Workspace, stage

LENGTH, GRAM = 400, 32
WORD_GRAM = 4
#: ASCII white space to a blank, all else as it is.
BY_BLANK = bytes(32 if c in (9, 10, 11, 12, 13) else c for c in range(256))
PIECE = 1 << 18  # bytes of text taken together; each takes some ten numbers per byte
WINDOW_PIECE = 1 << 20  # larger, as windows alike in one piece go as one
#: Bytes of text a batch of the index has, and the batches there are at least and at most.
BATCH_BYTES, BATCHES = 96 << 20, (4, 64)
#: Entries a task holds before it counts equal ones.
ENTRIES_HELD = 1 << 19


def group_ends(first: np.ndarray, count: int) -> np.ndarray:
    """Last places of groups that begin at ``first`` among ``count`` places; none for no group."""
    return np.append(first[1:], count)[: len(first)] - 1


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima from both ends of blocks."""
    count = len(values) - width + 1
    full = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def units(texts: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes, or hashes of the words, of all texts in order, and their number in each text."""
    if words:
        return word_hashes(texts, BY_BLANK)
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.array([len(t) for t in texts], dtype=np.int64)


def word_bounds(text: bytes) -> np.ndarray:
    """Where each word begins, the first at 0, and the text's end."""
    blank = np.frombuffer(text.translate(BY_BLANK), dtype=np.uint8) == 32
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    return np.concatenate([[0], starts[1:], [len(text)]])


@dataclass(frozen=True)
class Runs:
    """Runs of windows with one anchor: text number, then anchor, first and last window from the text's start."""

    text: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    context: np.ndarray
    before: np.ndarray  # key of the half before the anchor, 0 if no window holds it
    after: np.ndarray

    @staticmethod
    def of(texts: list[bytes], length: int = LENGTH, words: bool = False) -> Runs:
        gram = min(WORD_GRAM if words else GRAM, length)
        chars, sizes = units(texts, words)
        none, half = np.zeros(0, dtype=np.int64), length // 2
        if len(chars) < length:
            return Runs(none, none, none, none, *(none.astype(np.uint64),) * 3)
        sums = running_hash(chars)
        place = np.arange(len(chars) - gram + 1)
        ranked = span_hash(sums, place, place + gram) >> np.uint64(32) << np.uint64(32) | place.astype(np.uint64)
        lowest = (smallest(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ends = np.cumsum(sizes)
        starts, fits = ends - sizes, sizes >= length
        steps = np.zeros(len(lowest) + 1, dtype=np.int32)
        np.add.at(steps, starts[fits], 1)
        np.add.at(steps, (ends - length + 1)[fits], -1)
        window = np.flatnonzero(np.cumsum(steps[:-1]) > 0)
        anchor = lowest[window]
        head = np.ones(len(window), dtype=bool)
        head[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
        at = np.flatnonzero(head)
        first, last, anchor = window[at], window[group_ends(at, len(window))], anchor[at]
        text = np.searchsorted(ends, first, side="right")
        context = span_hash(sums, first, last + length)
        left, right = anchor - first >= half, anchor - last < half
        before = np.where(left, span_hash(sums, np.where(left, anchor - half, 0), anchor) & ~np.uint64(1), np.uint64(0))
        after = np.where(right, span_hash(sums, anchor, np.where(right, anchor + length - half, anchor)) | np.uint64(1), np.uint64(0))
        base = starts[text]
        return Runs(text, anchor - base, first - base, last - base, context, before, after)


def _texts(df: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return df.select(F.xxhash64(text).alias("h"), F.octet_length(text).alias("nb"), text.alias("text"))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Equal (batch, key, context) counted."""
    number, key, context = map(np.concatenate, zip(*parts))
    order = np.lexsort((context, key, number))
    number, key, context = number[order], key[order], context[order]
    head = np.ones(len(key), dtype=bool)
    head[1:] = (number[1:] != number[:-1]) | (key[1:] != key[:-1]) | (context[1:] != context[:-1])
    at = np.flatnonzero(head)
    n = np.diff(np.append(at, len(key)))
    return pa.RecordBatch.from_arrays([pa.array(number[at]), _long(key[at]), _long(context[at]), pa.array(n.astype(np.int64))], names=["batch", "key", "ctx", "n"])


def entries(df: DataFrame, length: int, batches: int, words: bool = False) -> DataFrame:
    """``batch, key, ctx, n``: the entries of every batch of texts, equal ones of a task counted."""
    def run(batch_rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in all_pieces(batch_rows, limit=PIECE):
            runs = Runs.of(text_list(batch.column("text")), length, words)
            number = (np.array(batch.column("h").to_numpy(zero_copy_only=False)).view(np.uint64) % np.uint64(batches)).astype(np.int32)[runs.text]
            for key in (runs.before, runs.after):
                there = key != 0
                parts.append((number[there], key[there], runs.context[there]))
                size += len(parts[-1][0])
            if size > ENTRIES_HELD:
                yield from slices(_summed(parts))
                parts, size = [], 0
        if size:
            yield from slices(_summed(parts))

    return _texts(df).mapInArrow(run, "batch int, key long, ctx long, n long")


class Family:
    """Levels of the index, each empty or twice as large as the one before, and the keys found more than once.

    All levels are stored in the same ``ranges`` of keys and in order of key and
    context inside each, so that a batch meets a level, and two levels become
    one, by a merge scan over both as they lie.
    """

    def __init__(self, work: Workspace, ranges: int):
        self.work, self.ranges = work, ranges
        self.levels: list[tuple[DataFrame, Workspace | None] | None] = []
        self.keys: list[DataFrame] = []

    def meets(self, batch: DataFrame, level: DataFrame) -> DataFrame:
        """Keys of a batch that a level has."""
        return batch.select("key").hint("merge").join(level.select("key").hint("merge"), "key", "left_semi")

    def merged(self, one: DataFrame, other: DataFrame) -> DataFrame:
        """Two levels as one, equal entries counted together."""
        right = other.withColumnRenamed("n", "m").hint("merge")
        both = one.hint("merge").join(right, ["key", "ctx"], "full_outer")
        return both.select("key", "ctx", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

    def add(self, batch: DataFrame, home: Workspace | None = None) -> None:
        """Join a batch (``key, ctx, n``, a sorted table, which ``home`` holds) with itself and all levels, then take it in."""
        found = batch.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
        for level in self.levels:
            if level is not None:
                found = found.unionByName(self.meets(batch, level[0]))
        self.keys.append(self.work.stage(found.distinct(), "repeated_keys"))
        depth = 0
        while depth < len(self.levels) and self.levels[depth] is not None:
            level, old = self.levels[depth]
            new = self.work.inside("suffix_level")
            batch = new.stage_sorted(self.merged(batch, level), "level", "key", ["key", "ctx"], self.ranges, dealt=True)
            for merged in filter(None, (home, old)):
                merged.clear()
            self.levels[depth], home = None, new
            depth += 1
        self.levels[depth : depth + 1] = [(batch, home)]

    def repeated(self) -> DataFrame:
        """``key, ctx, n`` of all entries whose key was found more than once."""
        keys = self.keys[0]
        for more in self.keys[1:]:
            keys = keys.unionByName(more)
        entries = None
        for level, _ in filter(None, self.levels):
            own = level.select("key", "ctx", "n")
            entries = own if entries is None else entries.unionByName(own)
        return entries.join(keys.distinct(), "key", "left_semi").groupBy("key", "ctx").agg(F.sum("n").alias("n"))


def build(df: DataFrame, work: Workspace, length: int = LENGTH, batches: int | None = None, words: bool = False) -> Family:
    """The index of all texts; its tables lie in ``work``."""
    if batches is None:
        batches = batch_count(df.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    ranges = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    whole = work.inside("suffix_batches")
    dealt = entries(df, length, batches, words).repartition(ranges, "key").groupBy("batch", "key", "ctx").agg(F.sum("n").alias("n"))
    every = whole.stage_sorted(dealt, "batches", "key", ["key", "ctx"], ranges, by="batch", dealt=True)
    folder = next((f.rsplit("/batch=", 1)[0] for f in every.inputFiles()), None)
    family = Family(work, ranges)
    for number in range(batches):
        home = None
        if folder:
            home = Workspace(work.spark, "suffix_batch")
            home.folder = f"{folder}/batch={number}"
        family.add(every.filter(F.col("batch") == number).select("key", "ctx", "n"), home)
    return family


def batch_count(size: int) -> int:
    """Batches for so many bytes of text: about ``BATCH_BYTES`` each, but no fewer and no more than the bounds."""
    return min(max(-(-size // BATCH_BYTES), BATCHES[0]), BATCHES[1])


def _contexts(repeated: DataFrame) -> DataFrame:
    """``ctx, whole, before, after``: contexts that repeat throughout, and halves whose windows must be compared."""
    mixed = repeated.groupBy("key").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1").select("key", F.lit(True).alias("mixed"))
    side = F.col("key").bitwiseAND(F.lit(1))
    tagged = repeated.join(mixed, "key", "left").withColumn("mixed", F.coalesce("mixed", F.lit(False)))
    found = tagged.groupBy("ctx").agg(
        (F.max("n") > 1).alias("whole"), F.max(F.col("mixed") & (side == 0)).alias("before"), F.max(F.col("mixed") & (side == 1)).alias("after"))
    return found.filter("whole OR before OR after")


def _runs(df: DataFrame, length: int, words: bool = False) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batches, limit=PIECE):
            runs = Runs.of(text_list(batch.column("text")), length, words)
            at = pa.array(runs.text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h").take(at), batch.column("nb").take(at), *[pa.array(x.astype(np.int32)) for x in (runs.anchor, runs.first, runs.last)], _long(runs.context)],
                names=["h", "nb", "anchor", "first", "last", "ctx"])

    return _texts(df).mapInArrow(run, "h long, nb int, anchor int, first int, last int, ctx long")


_WINDOWS = "pk long, ctx long, place long"  # place: first and last window from the run's first, and whether settled, in bits


def _windows(texts: DataFrame, length: int, words: bool = False) -> DataFrame:
    """Hashes of the windows to compare; those that repeat within a task's rows come out settled.

    Of windows alike in a task, the first context's hash stands for all.
    """
    half = length // 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batches, limit=WINDOW_PIECE):
            hashes, contexts, places, single = [], [], [], []
            for text, asked in zip(text_list(batch.column("text")), batch.column("asked").to_pylist(), strict=True):
                sums = running_hash(units([text], words)[0])
                for one in asked:
                    at = np.arange(one["first"], one["last"] + 1)
                    long = one["anchor"] - at >= half
                    at = at[(long & one["before"]) | (~long & one["after"])]
                    hashes.append(span_hash(sums, at, at + length))
                    contexts.append(np.full(len(at), one["ctx"], dtype=np.int64))
                    places.append(at - one["first"])
                    single.append(np.full(len(at), not one["whole"]))
            if not hashes:
                continue
            h, ctx, low, alone = map(np.concatenate, (hashes, contexts, places, single))
            if not len(h):
                continue
            order = np.lexsort((ctx, h))
            h, ctx, low, alone = h[order], ctx[order], low[order], alone[order]
            start = np.ones(len(h), dtype=bool)
            start[1:] = h[1:] != h[:-1]
            group = np.cumsum(start) - 1
            # A group with several contexts repeats here.
            kinds = np.bincount(group[1:][(ctx[1:] != ctx[:-1]) & ~start[1:]], minlength=group[-1] + 1) + 1
            settled = kinds[group] > 1
            done = np.flatnonzero(settled & alone)
            done = done[np.lexsort((low[done], ctx[done]))]
            c, p = ctx[done], low[done]
            head = np.ones(len(done), dtype=bool)
            head[1:] = (c[1:] != c[:-1]) | (p[1:] > p[:-1] + 1)
            first = np.flatnonzero(head)
            last = group_ends(first, len(done))
            spread = mix(c[first].view(np.uint64) + p[first].astype(np.uint64))
            open_ = np.flatnonzero(start)
            for pk, ctxs, lows, highs, flag in ((spread, c[first], p[first], p[last], True), (h[open_], ctx[open_], low[open_], low[open_], False)):
                if len(pk):
                    yield from slices(pa.RecordBatch.from_arrays(
                        [_long(pk), pa.array(ctxs), pa.array(lows << 33 | highs << 1 | flag)], names=["pk", "ctx", "place"]))

    return texts.select("text", "asked").mapInArrow(run, _WINDOWS)


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the joined spans that go."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    kept, at = [], 0
    for start, end in joined:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]]), joined


def repeats(df: DataFrame, length: int = LENGTH, batches: int | None = None, words: bool = False) -> DataFrame:
    """``h, nb, spans, kept``: for each different text that loses bytes, the spans that go and the bytes that stay.

    ``h`` and ``nb`` are ``xxhash64`` and size of the text; spans are in bytes.
    """
    # Tables go as soon as what is made of them is written.
    index, work = Workspace(df.sparkSession, "suffix_index"), Workspace(df.sparkSession, "suffix_work")
    repeated = work.stage(build(df, index, length, batches, words).repeated(), "repeated_entries")
    index.clear()
    contexts = work.stage(_contexts(repeated), "contexts")
    runs = work.stage(_runs(df, length, words).join(contexts, "ctx"), "repeated_runs")
    asked = runs.filter("before OR after").groupBy("ctx").agg(F.min(F.struct("h", "nb", "anchor", "first", "last", "whole", "before", "after")).alias("r")).select("ctx", "r.*")
    asked = stage(asked, "asked_contexts")
    whole = runs.filter("whole").select("h", "nb", F.struct("first", "last").alias("span"), F.lit(None).cast("struct<ctx:bigint,anchor:int,first:int,last:int,whole:boolean,before:boolean,after:boolean>").alias("ask"))
    wanted = asked.select("h", "nb", F.lit(None).cast("struct<first:int,last:int>").alias("span"), F.struct("ctx", "anchor", "first", "last", "whole", "before", "after").alias("ask"))
    # At most a few entries per run of a text; equal ones are gathered once.
    info = whole.unionByName(wanted).groupBy("h", "nb").agg(F.collect_set("span").alias("spans"), F.collect_set("ask").alias("asked"))
    info = work.stage(info, "repeated_info")
    texts = stage(possible(_texts(df), info, "h").groupBy("h", "nb").agg(F.first("text").alias("text")).join(info, ["h", "nb"]), "repeated_texts")
    work.clear()

    alike = Window.partitionBy("pk")
    windows = _windows(texts.filter(F.size("asked") > 0), length, words)
    windows = windows.withColumn("least", F.min("ctx").over(alike)).withColumn("most", F.max("ctx").over(alike)).filter("place & 1 = 1 OR least != most")
    windows = windows.withColumn("low", F.shiftright("place", 33).cast("int")).withColumn("high", F.shiftright("place", 1).bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    places = asked.filter("NOT whole").select("ctx", "h", "nb", F.col("first").alias("base"))
    more = windows.join(places, "ctx").groupBy("h", "nb").agg(F.collect_set(F.struct((F.col("base") + F.col("low")).alias("first"), (F.col("base") + F.col("high")).alias("last"))).alias("more"))
    joined = texts.select("h", "nb", "text", "spans").join(more, ["h", "nb"], "left")

    def run(batch_rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batch_rows, limit=PIECE):
            hs, nbs, gone, kept = [], [], [], []
            rows = zip(text_list(batch.column("text")), batch.column("h").to_pylist(), batch.column("nb").to_pylist(), batch.column("spans").to_pylist(), batch.column("more").to_pylist(), strict=True)
            for text, h, nb, spans, others in rows:
                places = [(s["first"], s["last"] + length) for s in [*(spans or []), *(others or [])]]
                if words:
                    bounds = word_bounds(text).tolist()
                    places = [(bounds[a], bounds[b]) for a, b in places]
                rest, joined_spans = _cut(text, places)
                if joined_spans:
                    hs.append(h)
                    nbs.append(nb)
                    kept.append(rest)
                    gone.append([{"start": a, "end": b} for a, b in joined_spans])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hs, pa.int64()), pa.array(nbs, pa.int32()), pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                names=["h", "nb", "spans", "kept"])

    return joined.mapInArrow(run, "h long, nb int, spans array<struct<start:int,end:int>>, kept binary")


def digest(df: DataFrame, length: int = LENGTH, batches: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document."""
    found = repeats(df, length, batches).select("h", "nb", F.size("spans").alias("n_spans"), F.octet_length("kept").alias("n_kept"), F.sha2("kept", 256).alias("sha"))
    text = F.coalesce("text", F.lit(""))
    docs = df.select("doc_id", F.xxhash64(text).alias("h"), F.octet_length(text).alias("nb"), F.sha2(text.cast("binary"), 256).alias("all_sha"))
    joined = docs.join(found, ["h", "nb"], "left")
    return joined.select(
        "doc_id", F.col("nb").cast("long").alias("n_bytes"), (F.col("nb") - F.coalesce("n_kept", F.col("nb"))).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "all_sha").alias("kept_sha256"),
    )


def cleaned(df: DataFrame, length: int = LENGTH, batches: int | None = None, words: bool = False) -> DataFrame:
    """All rows and columns of ``df``, with repeated strings cut from ``text``.

    A cut inside a character drops the rest of that character.
    """
    found = repeats(df, length, batches, words).select("h", "nb", "kept")
    text = F.coalesce("text", F.lit(""))
    keyed = df.select(*[F.col(f"`{c}`").alias(f"_{c}") for c in df.columns], F.xxhash64(text).alias("h"), F.octet_length(text).alias("nb"))
    joined = keyed.join(found, ["h", "nb"], "left")

    def run(batches_: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            whole = batch.column("_text").to_pylist()
            cut = [w if k is None else k.decode("utf-8", errors="ignore") for w, k in zip(whole, batch.column("kept").to_pylist(), strict=True)]
            columns = [pa.array(cut, pa.string()) if c == "text" else batch.column(f"_{c}") for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = df.columns
    return joined.mapInArrow(run, df.schema)

