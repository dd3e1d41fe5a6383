"""Toxicity scores from a bag of character n-grams.

Every n-gram of three to five characters of a word, with a blank as its two
ends, and every whole word hash to a bucket that owns a small vector. A text's
vectors are averaged and go through a linear softmax over two classes. Vectors
and softmax are trained together, so a misspelling shares most vectors with the
word it came from.

Scoring needs one number per bucket (its vector times the difference of the two
class weights), so it is a table lookup over the bytes of a text.

Defined results: a null or empty text has no n-grams and gets the score of the
class balance alone; equal texts get equal scores; an empty table gives an
empty result; other columns, whatever their names, are never read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import all_pieces, documents, fold, text_list

LENGTHS = (3, 4, 5)
_SPACES = bytes(32 if c in (9, 10, 11, 12, 13) else c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Config:
    """``max_documents`` bounds the labelled documents the model is fitted on (half of them per class)."""

    bits: int = 18
    dim: int = 8
    epochs: int = 10
    rate: float = 0.5
    max_documents: int = 6000
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """One logit per bucket, and the logit of an empty text."""

    weight: np.ndarray
    bias: float


def ngram_buckets(texts: list[bytes], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram length and then for whole words: bucket and validity per position, and where texts start."""
    buffer = b" " + b" ".join(texts) + b"     "
    chars = np.frombuffer(buffer.translate(_SPACES), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts[:-1]])]).astype(np.int64)
    n = len(chars) - max(LENGTHS)
    blank = chars == 32
    shift, mix = np.uint32(32 - bits), np.uint32(2654435761)
    code = chars.astype(np.uint32) + np.uint32(1)
    power, value = 1, np.zeros(n, dtype=np.uint32)
    ok = np.ones(n, dtype=bool)
    for length in range(1, max(LENGTHS) + 1):
        value = value + code[length - 1 : length - 1 + n] * np.uint32(power)
        power = power * 16777619 % (1 << 32)
        if length > 2:
            ok &= ~blank[length - 2 : length - 2 + n]
        if length in LENGTHS:
            yield ((value + np.uint32(length)) * mix) >> shift, ok, starts
    first = np.flatnonzero(~blank[1:n] & blank[: n - 1]) + 1
    last = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    if len(first):
        # A whole word: a polynomial over its bytes, by running sums.
        rank = np.arange(len(chars)) - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(chars)]])))
        powers = np.cumprod(np.full(int(rank.max()) + 1, 2654435769, dtype=np.uint32), dtype=np.uint32)
        sums = np.concatenate([[0], np.cumsum(code * powers[rank], dtype=np.uint32)]).astype(np.uint32)
        word = (sums[last[: len(first)]] - sums[first]) * mix >> shift
        bucket, valid = np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=bool)
        bucket[first], valid[first] = word, True
        yield bucket, valid, starts


def logits(texts: list[bytes], model: Model, bits: int) -> np.ndarray:
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, ok, starts in ngram_buckets(texts, bits):
        # A text's range ends before the next text's leading blank.
        total += np.add.reduceat(np.where(ok, model.weight[bucket], np.float32(0)), starts, dtype=np.float64)
        count += np.add.reduceat(ok, starts, dtype=np.int64)
    return model.bias + total / np.maximum(count, 1)


def fit(texts: list[bytes], labels: np.ndarray, share: float, config: Config = Config()) -> Model:
    """Train vectors and softmax together (per-coordinate step sizes); ``share`` is the true share of class 1."""
    size = 1 << config.bits
    bags = []
    for text in texts:
        counts = np.bincount(np.concatenate([b[ok] for b, ok, _ in ngram_buckets([text], config.bits)] or [np.zeros(0, np.uint32)]), minlength=0)
        at = np.flatnonzero(counts)
        bags.append((at.astype(np.int32), (counts[at] / max(1, counts.sum())).astype(np.float32)))
    rng = np.random.default_rng(config.seed)
    vectors = rng.normal(0, 1 / config.dim, (size, config.dim)).astype(np.float32)
    soft = rng.normal(0, 1, (config.dim, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    seen_v, seen_s, seen_b = np.full(size, 1e-8, np.float32), np.full_like(soft, 1e-4), np.full_like(bias, 1e-4)
    balance = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    for epoch in range(config.epochs):
        rate = config.rate * (1 - epoch / config.epochs)
        for i in rng.permutation(len(bags)):
            at, part = bags[i]
            mean = part @ vectors[at] if len(at) else np.zeros(config.dim, np.float32)
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            gap = (p / p.sum()).astype(np.float32)
            gap[int(labels[i])] -= 1
            gap *= np.float32(balance[i])
            step_s, step_v = np.outer(mean, gap), soft @ gap
            if len(at):
                seen_v[at] += part * part * float(step_v @ step_v) / config.dim
                vectors[at] -= (rate * part / np.sqrt(seen_v[at]))[:, None] * step_v
            seen_s += step_s**2
            soft -= rate * 0.2 * step_s / np.sqrt(seen_s)
            seen_b += gap**2
            bias -= rate * 0.2 * gap / np.sqrt(seen_b)
    prior = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    return Model((vectors @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0] + prior))


def train(documents_df: DataFrame, labels: DataFrame, config: Config = Config()) -> Model:
    """Fit on a bounded, hash-chosen sample of labelled documents outside fold 0.

    Rows with a null label or id are not used. Without any labelled row the
    model scores 0.5 everywhere.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(fold() != 0).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    if not total:
        return Model(np.zeros(1 << config.bits, np.float32), 0.0)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = F.lit(False)
    for label, count in sizes.items():
        chosen = chosen | ((F.col("toxic") == label) & (draw < config.max_documents / 2 / count))
    # The sample's ids are bounded by max_documents (twice that cuts off nothing in practice).
    sample = documents(documents_df, "doc_id", "text").join(F.broadcast(known.filter(chosen)), "doc_id").select("doc_id", "text", "toxic")
    rows = sorted((r["doc_id"], r["text"].encode(), r["toxic"]) for r in sample.collect())
    return fit([r[1] for r in rows], np.array([r[2] for r in rows]), sizes.get(1, 0) / total, config)


def score(documents_df: DataFrame, model: Model, config: Config = Config()) -> DataFrame:
    """``doc_id, score, predicted`` for every row, scored on its whole text."""
    held = documents_df.sparkSession.sparkContext.broadcast(model)
    bits = config.bits

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batches):
            z = logits(text_list(batch.column("text")), held.value, bits)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = documents_df.schema["doc_id"].dataType.simpleString()
    return documents(documents_df, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def keep_clean(df: DataFrame, model: Model, config: Config = Config()) -> DataFrame:
    """The rows of ``df`` that score below 0.5, all columns unchanged."""
    held = df.sparkSession.sparkContext.broadcast(model)
    bits = config.bits

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_pieces(batches):
            yield batch.filter(pa.array(logits(text_list(batch.column("text")), held.value, bits) < 0))

    return df.mapInArrow(run, df.schema)
