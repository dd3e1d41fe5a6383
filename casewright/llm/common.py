"""Column expressions and batch helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_BYTES = 1 << 20
#: Bytes of rows handed to a Python worker that end a batch; the JVM holds a batch several times over, outside its heap.
BATCH_BYTES = 1 << 20
#: Rows of numbers a Python worker hands back at once; the JVM holds them outside its heap.
NUMBER_ROWS = 1 << 16


def fold(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as the empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % folds


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, texts with null as the empty text; other columns are left behind."""
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c == "text" else F.col(c) for c in columns])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any case, as Spark compares names."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_list(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts together have about ``limit`` bytes, one row at least."""
    if not batch.num_rows:
        return
    sizes = np.cumsum([0 if n is None else n for n in _lengths(batch.column(column))])
    start = 0
    while start < batch.num_rows:
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def all_pieces(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, column, limit)


def slices(batch: pa.RecordBatch, rows: int = NUMBER_ROWS) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded length."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Byte tables: A-Z to lower case, and white space, or everything but letters, digits and non-ASCII, to a blank.
BY_SPACE = bytes(32 if c in (9, 10, 11, 12, 13) else c + 32 if 65 <= c <= 90 else c for c in range(256))
BY_SIGN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base modulo 2**64 and of its inverse, ``count`` at least."""
    if len(_powers[0]) < count:
        size = max(count, len(_powers[0]) * 9 // 8)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running_hash(chars: np.ndarray) -> np.ndarray:
    """Sums whose differences, shifted back, hash any substring: see ``span_hash``."""
    sums = np.empty(len(chars) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers(len(chars))[0][: len(chars)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def word_hashes(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in order, and the number of words of each text."""
    chars = np.frombuffer((b" ".join(texts) + b" ").translate(table), dtype=np.uint8)
    blank = chars == 32
    before = np.concatenate([[True], blank[:-1]])
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return span_hash(running_hash(chars), starts, ends), np.diff(np.searchsorted(starts, bounds))


BITMAP_BITS = 26


def possible(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose hash ``key`` may be among ``keys``; run before a join that shuffles long rows.

    The bitmap sent to all tasks has ``2 ** BITMAP_BITS`` bits, however many keys
    there are; a full one only lets more rows through.
    """
    spot = F.pmod(F.col(key), F.lit(1 << BITMAP_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))
    words = keys.select((spot / 64).cast("int").alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(1 << BITMAP_BITS - 6, dtype=np.int64)
    bitmap[words["at"].to_numpy()] = words["bits"].to_numpy()
    held = df.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(key).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)
            there = held.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
            yield batch.filter(pa.array(there.astype(bool)))

    return df.mapInArrow(run, df.schema)
