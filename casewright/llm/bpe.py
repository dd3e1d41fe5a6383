"""Byte-pair encoding and decoding over a contiguous rank array.

A short word is a row of parts (first its bytes) with the merge rank of every
two neighbours beside it. The smallest rank is found by a scan, its right
boundary is deleted, and the two ranks next to it are looked up again, until no
neighbours can merge. Many words are rows of one numpy array and take each step
together. Words over ``LONG`` bytes, where repeated scans would cost the square
of the length, keep their ranks in a heap instead; the merges are the same.

A text is first cut at special tokens and then by the vocabulary's word pattern.
The ids equal those of the tokenizer library for the same vocabulary file.

Defined results: a null or empty text has no ids and decodes to the empty text;
equal texts have equal ids; very long texts and words are encoded whole; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from casewright.llm.chunks import Pool
from casewright.llm.common import all_pieces, documents

# Fixed value: the word pattern of byte-level vocabularies of this kind.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_BLANK_RUN = re.compile(r" [\s\u0085]")
LONG = 64
NEVER = np.int32(2**31 - 1)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, mapped back to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("|".join(f"({re.escape(s)})" for s in sorted(special, key=len, reverse=True))) if special else None
        self.width = max([*vocab.values(), *special.values()]) + 1
        self.pieces = [b""] * self.width
        for token, i in vocab.items():
            self.pieces[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        for token, i in special.items():
            self.pieces[i] = token.encode()
        self.start = np.zeros(256, dtype=np.int32)
        for symbol, byte in symbols.items():
            self.start[byte] = vocab[symbol]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        self.ranks = {int(k): r for r, k in reversed(list(enumerate(keys)))}
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank = keys[order], order.astype(np.int32)
        self.pool = Pool(self.encode_chunks)
        self.decimal = [str(i).encode() for i in range(self.width)]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.key_rank[at], NEVER)

    def merge_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of about one length end to end, and the number of ids of each."""
        width = max(map(len, words)) + 1
        sizes = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8).reshape(-1, width)
        column = np.arange(width)
        parts = np.where(column < sizes[:, None], self.start[raw], -1).astype(np.int32)
        ranks = np.full(parts.shape, NEVER, dtype=np.int32)
        ranks[:, :-1] = self.pair_ranks(parts[:, :-1], parts[:, 1:])
        live, done = np.arange(len(words)), np.full(parts.shape, -1, dtype=np.int32)
        while len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            ended = best == NEVER
            if ended.any():
                done[live[ended]] = parts[ended]
                keep = ~ended
                live, parts, ranks, at, best = live[keep], parts[keep], ranks[keep], at[keep], best[keep]
            row = np.arange(len(live))
            parts[row, at] = self.merged[best]
            # Delete the boundary after the merged part: everything right of it moves up by one.
            moved = column[:-1] > at[:, None]
            parts[:, :-1] = np.where(moved, parts[:, 1:], parts[:, :-1])
            ranks[:, :-1] = np.where(moved, ranks[:, 1:], ranks[:, :-1])
            parts[:, -1], ranks[:, -1] = -1, NEVER
            ranks[row, at] = self.pair_ranks(parts[row, at], parts[row, np.minimum(at + 1, width - 1)])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pair_ranks(parts[left, at[left] - 1], parts[left, at[left]])
        there = done >= 0
        return done[there], there.sum(axis=1)

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same merges in the same order, from a heap of (rank, place)."""
        parts = self.start[np.frombuffer(word, dtype=np.uint8)].tolist()
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        rank = lambda a, b: self.ranks.get(a * self.width + b)
        heap = [(r, i) for i in range(len(parts) - 1) if (r := rank(parts[i], parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= len(parts) or rank(parts[i], parts[j]) != r:
                continue
            parts[i], parts[j] = int(self.merged[r]), -1
            after[i] = k = after[j]
            if k < len(parts):
                before[k] = i
                if (r := rank(parts[i], parts[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank(parts[h], parts[i])) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([p for p in parts if p >= 0], dtype=np.int32)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in one array, with the first place and the number of ids of each word."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        short = order[lengths[order] <= LONG]
        out, first, size, filled = [np.zeros(0, np.int32)], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        groups = [short[i : i + 4096] for i in range(0, len(short), 4096)] + [order[i : i + 1] for i in range(len(short), len(order))]
        for at in groups:
            if lengths[at[0]] <= LONG:
                ids, sizes = self.merge_short([words[i] for i in at.tolist()])
            else:
                ids = self.merge_long(words[at[0]])
                sizes = np.array([len(ids)])
            out.append(ids)
            size[at], first[at] = sizes, filled + np.cumsum(sizes) - sizes
            filled += len(ids)
        return np.concatenate(out), first, size

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known: dict[str, int] = {}
        index, counts = [], []
        number = lambda w: known.setdefault(w, len(known))
        for c in chunks:
            body = c[1:]
            if body.isalpha() and (c[0] == " " or c[0].isalpha()):  # one word of letters
                index.append(number(c))
                counts.append(1)
            else:
                words = WORDS.findall(c)
                index.extend(map(number, words))
                counts.append(len(words))
        ids, first, size = self.encode_words([w.encode() for w in known])
        index = np.array(index, dtype=np.int64)
        sizes = size[index]
        total = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(first[index] - total[:-1], sizes) + np.arange(total[-1])
        return ids[source], np.diff(total[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)])

    def chunks(self, text: str) -> list[str]:
        """Parts of a text that never share a word of the pattern.

        Each blank before a non-blank starts a word. A blank before another
        blank does not, so such texts are cut by the pattern itself.
        """
        if _BLANK_RUN.search(text):
            return WORDS.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        if self.cut and any(s in t for t in texts for s in self.special):
            parts = [[p for p in self.cut.split(t) if p] for t in texts]
            out = []
            for ps in parts:
                out.append(np.concatenate([np.zeros(0, np.int32), *[
                    np.array([self.special[p]], np.int32) if p in self.special else self.pool.look_up([self.chunks(p)])[0] for p in ps]]))
            return np.concatenate([np.zeros(0, np.int32), *out]), np.array([len(x) for x in out], dtype=np.int64)
        return self.pool.look_up([self.chunks(t) for t in texts])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def encode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the ids of each whole text. ``path`` names the vocabulary file on every worker."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in all_pieces(batches):
            ids, sizes = own.encode(_texts(batch))
            bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return documents(df, "doc_id", "text").mapInArrow(run, f"doc_id {_kind(df)}, ids array<int>")


def decode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give the empty text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = [own.decode(np.array(i or [], dtype=np.int32)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, f"doc_id {_kind(df)}, text string")


def round_trip(df: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode, then decode from the ids, and digest both: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in all_pieces(batches):
            ids, sizes = own.encode(_texts(batch))
            listed, decoded, first = [], [], 0
            for last in np.cumsum(sizes).tolist():
                some = ids[first:last]
                listed.append(hashlib.sha256(b",".join(map(own.decimal.__getitem__, some.tolist()))).hexdigest())
                decoded.append(hashlib.sha256(own.decode(some).encode()).hexdigest())
                first = last
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(sizes), "ids_sha256": pa.array(listed, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            if with_ids:
                bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"doc_id {_kind(df)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents(df, "doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)
