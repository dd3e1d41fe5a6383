"""Token ids in a binary file format with byte-aligned variable-length codes.

Ids are replaced by their frequency rank, so common ids are small numbers. A
rank takes one to four bytes. The lengths stand apart in control bytes, four
two-bit lengths each; the data bytes follow. Decoding looks up the four lengths
of each control byte in a table, finds places by running sums, and gathers.

A file set is a folder with ``ranks`` (the id of each rank) and ``segments``:
binary segments of whole documents in ascending order of id, each with its file
number and the number of ids before it in the file. Segments lie in Parquet, so
any store Spark reads will do, and a repeated task replaces its own output.

Segment layout (little endian): 4 bytes ``FVB1``, documents (4), ids (8),
data bytes (8), ids per document (4 each), control bytes, data bytes.

Defined results: a null or empty text has the end id only; rows with equal
document ids are ordered by their ids' checksum and bytes; a null document id
comes first; an empty table gives an empty file set; very long documents make a
segment of their own size; other columns are left out.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm.bpe import byte_symbols
from casewright.llm.chunks import Pool
from casewright.llm.common import all_pieces, documents

MAGIC, HEAD = b"FVB1", struct.Struct("<4sIQQ")
SEGMENT_IDS = 1 << 19
#: Distinct words a worker keeps the ids of; about 200 bytes each.
WORDS_HELD = 1_200_000
#: Lengths of the four codes of a control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype="<u4")
# A comma or full stop beside another sign is no word by itself; a special token may hold anything.
_MIXED = [re.compile(p) for p in (r",(?:[^\w \n]|_)", r"\.(?:[^\w \n]|_)", r",(?<=[^\w \n],)", r"\.(?<=[^\w \n]\.)", r",(?<=_,)", r"\.(?<=_\.)", r"<\|")]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    coded = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    coded[: len(ranks)] = size - 1
    quads = coded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:count]
    place = np.cumsum(size) - size
    padded = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = padded[place].astype("<u4")
    for i in (1, 2, 3):
        long = np.flatnonzero(size > i)
        out[long] |= padded[place[long] + i].astype("<u4") << np.uint32(8 * i)
    return out & MASKS[size]


def write_segment(sizes: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    return HEAD.pack(MAGIC, len(sizes), len(ranks), len(data)) + sizes.astype("<u4").tobytes() + control + data


def read_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids per document, and all ranks."""
    magic, n, count, length = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    at = HEAD.size
    sizes = np.frombuffer(raw, "<u4", n, at)
    at += 4 * n
    end = at + -(-count // 4)
    return sizes, unpack(raw[at:end], raw[end : end + length], count)


class WordTokenizer:
    """The library's ids of whole texts, from its ids of their distinct chunks.

    The vocabulary drops white space and starts a word at every change between
    letters and other signs, so a text's ids are those of its chunks. A comma or
    full stop between letters or blanks is a word by itself and cut off too.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        self.signs = {byte: sign for sign, byte in byte_symbols().items()}
        self.pool = Pool(self.encode_chunks, WORDS_HELD)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain words go to the library's merge model as they are; others through the whole tokenizer."""
        model, signs = self.own.model.tokenize, self.signs
        found: list[list[int] | None] = [None] * len(chunks)
        odd = []
        for i, chunk in enumerate(chunks):
            low = chunk.lower()
            if chunk.isascii():
                # ASCII letters are their own signs and always in normal form.
                if chunk.isalpha():
                    found[i] = [t.id for t in model(low)]
                else:
                    odd.append(i)
            elif low.isalpha() and chunk.isalpha() and is_normalized("NFC", chunk) and "\u03a3" not in chunk:
                found[i] = [t.id for t in model(low.encode().decode("latin-1").translate(signs))]
            else:
                odd.append(i)
        for i, e in zip(odd, self.own.encode_batch_fast([chunks[i] for i in odd], add_special_tokens=False), strict=True):
            found[i] = e.ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.array(list(chain.from_iterable(found)), dtype=np.int32), sizes

    def chunks(self, text: str) -> list[str]:
        if not any(p.search(text) for p in _MIXED):
            text = text.replace(",", " , ").replace(".", " . ")
        return list(filter(None, text.replace("\n", " ").split(" ")))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.pool.look_up([self.chunks(t) for t in texts])


@functools.lru_cache(maxsize=4)
def word_tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordTokenizer(path)


def tokenize(df: DataFrame, path: str, end_id: int, id_bytes: int = 4, width: int | None = None) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned): each whole text's ids and ``end_id``.

    Two ``id_bytes`` do for ids below 65,536 and halve what is written and moved.
    With ``width`` each task ends with a row of its own, whose ``counts`` say how
    often it met each id below ``width`` (64-bit numbers); see ``staged``.
    """
    kind = f"<u{id_bytes}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, names = word_tokenizer(path), np.zeros(width or 0, dtype=np.int64), ["doc_id", "ids", "counts"][: 3 if width else 2]
        empty = None
        for batch in all_pieces(batches):
            ids, sizes = own.encode([t or "" for t in batch.column("text").to_pylist()])
            bounds = np.cumsum(sizes)
            ids = np.insert(ids, bounds, end_id).astype(kind)
            bounds = np.concatenate([[0], bounds + np.arange(1, len(bounds) + 1)]).astype(np.int32) * id_bytes
            column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids.tobytes())])
            columns = [batch.column("doc_id"), column]
            if width:
                counts += np.bincount(ids, minlength=width)
                columns.append(pa.nulls(len(sizes), pa.binary()))
                empty = pa.nulls(1, batch.column("doc_id").type)
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if empty is not None:
            yield pa.RecordBatch.from_arrays([empty, pa.nulls(1, pa.binary()), pa.array([counts.tobytes()])], names=names)

    return documents(df, "doc_id", "text").mapInArrow(run, f"doc_id {_kind(df)}, ids binary" + (", counts binary" if width else ""))


def staged(df: DataFrame, path: str, end_id: int, width: int, table: str, id_bytes: int = 4) -> tuple[DataFrame, np.ndarray]:
    """The ids of all texts written to ``table``, and how often each id below ``width`` occurs: counted as they are made."""
    found = tokenize(df, path, end_id, id_bytes, width)
    found.write.option("compression", "zstd").parquet(table)
    kept = df.sparkSession.read.schema(found.schema).parquet(table)
    rows = kept.filter("counts IS NOT NULL").select("counts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts += np.frombuffer(raw, dtype=np.int64)
        yield _nonzero(counts)

    return kept.filter("counts IS NULL").select("doc_id", "ids"), _totals(rows.mapInArrow(run, "id int, n long"), width)


def _nonzero(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["id", "n"])


def _totals(counts: DataFrame, width: int) -> np.ndarray:
    """Sums of ``id, n`` rows; ``width`` rows at most reach the driver."""
    out = np.zeros(width, dtype=np.int64)
    for r in counts.groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def count_ids(ids: DataFrame, width: int, id_bytes: int = 4) -> np.ndarray:
    """How often each id occurs. Each task sends one count per id, ``width`` at most."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, dtype=np.int64)
        for batch in all_pieces(batches, "ids"):
            counts += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), f"<u{id_bytes}"), minlength=width)
        yield _nonzero(counts)

    return _totals(ids.select("ids").mapInArrow(run, "id int, n long"), width)


def rank_order(counts: np.ndarray) -> np.ndarray:
    """Ids that occur from most to least frequent, ties by id."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    return order[: np.count_nonzero(counts)]


def write(ids: DataFrame, path: str, width: int, files: int, id_bytes: int = 4, counts: np.ndarray | None = None) -> None:
    """Write ``doc_id, ids`` as a file set. ``width``: ids are below it.

    Without ``counts`` of all ids, ``ids`` is read a second time for them: keep it in a table.
    """
    spark = ids.sparkSession
    order = rank_order(count_ids(ids, width, id_bytes) if counts is None else counts)
    rank = np.zeros(width, dtype=np.uint32)
    rank[order] = np.arange(len(order))
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    held = spark.sparkContext.broadcast(rank)  # one number per id of the vocabulary
    kind = _kind(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, base = TaskContext.get().partitionId(), 0
        names, bodies, count = [], [], 0

        def segment() -> pa.RecordBatch:
            sizes = np.array([len(b) // id_bytes for b in bodies])
            raw = write_segment(sizes, held.value[np.frombuffer(b"".join(bodies), f"<u{id_bytes}")])
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([base], pa.int64()), pa.array([count], pa.int64()), pa.array([names], pa.list_(doc_type)), pa.array([raw], pa.binary())],
                names=["file", "base", "n_ids", "doc_ids", "segment"])

        for batch in batches:
            doc_type = batch.column("doc_id").type
            for name, body in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                names.append(name)
                bodies.append(body)
                count += len(body) // id_bytes
                if count >= SEGMENT_IDS:
                    yield segment()
                    base, names, bodies, count = base + count, [], [], 0
        if names:
            yield segment()

    keyed = ids.withColumn("sum", F.crc32("ids"))
    sorted_ids = keyed.repartitionByRange(files, "doc_id", "sum").sortWithinPartitions("doc_id", "sum", "ids")
    sorted_ids.select("doc_id", "ids").mapInArrow(run, f"file int, base long, n_ids long, doc_ids array<{kind}>, segment binary").write.option("compression", "none").parquet(f"{path}/segments")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (binary, little-endian unsigned 32 bits) of a file set."""
    order = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], dtype="<u4")
    segments = spark.read.parquet(f"{path}/segments")
    # One total per file.
    totals = sorted((r["file"], r["n"]) for r in segments.groupBy("file").agg(F.sum("n_ids").alias("n")).collect())
    starts, total = {}, 0
    for file, n in totals:
        starts[file] = total
        total += n
    held = spark.sparkContext.broadcast((order, starts))
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, first = held.value
        for batch in batches:
            for row in range(batch.num_rows):
                some = batch.slice(row, 1)
                sizes, ranks = read_segment(some.column("segment")[0].as_py())
                ids = ids_of[ranks].astype("<u4")
                bounds = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
                begin = first[some.column("file")[0].as_py()] + some.column("base")[0].as_py()
                raw = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_ids").flatten(), pa.array(begin + bounds[:-1]), pa.array(sizes.astype(np.int64)), raw], names=["doc_id", "start", "n_tokens", "ids"])

    return segments.select("file", "base", "doc_ids", "segment").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")
