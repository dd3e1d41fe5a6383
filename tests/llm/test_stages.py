"""The pipeline's stages on tables with further columns whose names the operators use, and on odd rows."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casewright.llm import common, decontaminate, queries, token_files
from casewright.llm.queries import WORD_VOCABULARY, vocabulary
from test_operators import ODD, lorem

SF_DIR = "/root/testdata/sf0.001"
CLASHES = ["_row", "ROW", "row_", "h", "nb", "kept", "ctx", "label", "component_id", "n_words", "spans_", "score", "_text", "cls"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def documents(spark):
    """A few sound documents and odd rows, each with values of its own in columns whose names clash."""
    sound = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("doc_id < 60")
    odd = spark.createDataFrame([(None if i is None else i + 1000, t, None if i == 2 else "en", "odd", len(t or "")) for i, t in ODD], sound.schema)
    rows = sound.unionByName(odd).withColumn("_mark", F.concat_ws("/", "doc_id", F.crc32("text")))
    return rows.select("*", *[F.concat(F.lit(f"{c}:"), "_mark").alias(c) for c in CLASHES]).drop("_mark")


def _marks(rows):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], *[r[c] for c in CLASHES]) for r in rows)


@pytest.mark.parametrize("name", ["toxicity", "jaccard_join", "suffix_dedup", "decontamination"])
def test_stages_keep_columns_with_clashing_names(spark, documents, name):
    before = {m[0]: m for m in _marks(documents.collect())}
    out = STAGES[name](spark, documents, SF_DIR)
    assert out.columns == documents.columns
    after = out.collect()
    assert len(after) > 30 and all(before[m[0]] == m for m in _marks(after) if m[0] != 1003)  # 1003 stands for two rows
    if name == "jaccard_join":
        assert sum(r["doc_id"] == 1003 for r in after) == 1  # equal rows: one stays
        assert {None, 1001, 1002, 1006} <= {r["doc_id"] for r in after}
    assert STAGES[name](spark, documents.limit(0), SF_DIR).collect() == []


def test_the_last_stage_on_odd_rows(spark, documents):
    out = corpus_pipeline.encode(spark, documents, SF_DIR).collect()
    assert len(out) == documents.count()
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in out)
    assert corpus_pipeline.encode(spark, documents.limit(0), SF_DIR).collect() == []


def test_decontamination_in_several_passes_keeps_clashing_columns(spark, documents, monkeypatch):
    bench = spark.createDataFrame([(i, lorem(100 + i, 14)) for i in range(12)], "item_id long, text string")
    hits = spark.createDataFrame([(2000 + i, lorem(i, 20) + " " + lorem(100 + i, 14), "en", "s", 1, *["x"] * len(CLASHES)) for i in range(3)], documents.schema)
    docs = documents.unionByName(hits)
    whole = _marks(decontaminate.clean(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 300)
    out = decontaminate.clean(docs, bench)
    assert out.columns == docs.columns and _marks(out.collect()) == whole == _marks(documents.collect())


def test_free_names_compare_as_spark_does(rows):
    df = rows([(1, 2)], "ROW int, row_ int")
    assert common.free_name(df, "row") == "row__" and common.free_name(df, "other") == "other"


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_ids_are_counted_as_they_are_made(spark, tmp_path, id_bytes):
    docs = spark.createDataFrame([(i, t) for i, t in ODD] + [(50, lorem(3, 200))], "doc_id long, text string").repartition(3)
    kept, counts = token_files.staged(docs, vocabulary(WORD_VOCABULARY), 1, 49_408, str(tmp_path / "ids"), id_bytes)
    assert kept.columns == ["doc_id", "ids"] and kept.count() == len(ODD) + 1
    assert (counts == token_files.count_ids(kept, 49_408, id_bytes)).all() and counts[1] == len(ODD) + 1
    ids = np.concatenate([np.frombuffer(r["ids"], f"<u{id_bytes}") for r in kept.collect()])
    order = token_files.rank_order(counts).tolist()
    assert order == sorted(set(ids.tolist()), key=lambda i: (-int((ids == i).sum()), i))
    none, zero = token_files.staged(docs.limit(0), vocabulary(WORD_VOCABULARY), 1, 49_408, str(tmp_path / "none"), id_bytes)
    assert none.count() == 0 and not zero.any()


@pytest.mark.parametrize("tune", [corpus_pipeline.tune, lambda spark: queries.op5_jaccard_join(spark, SF_DIR), lambda spark: queries.op10_suffix_dedup(spark, SF_DIR)])
def test_batches_for_python_are_bounded_in_bytes(spark, tune):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    tune(spark)
    texts = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    out = texts.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in out) == 1500 and max(r["bytes"] for r in out) < 2 * common.BATCH_BYTES


def test_numbers_come_back_in_bounded_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2 * common.NUMBER_ROWS + 5))], names=["n"])
    parts = list(common.slices(batch))
    assert max(p.num_rows for p in parts) == common.NUMBER_ROWS and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert list(common.slices(batch.slice(0, 0))) == []
