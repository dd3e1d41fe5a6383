"""Five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all rows the one before kept,
and is written as Parquet before the next one reads it. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import session
from casewright.llm import bpe, decontaminate, jaccard_join, suffix_dedup, toxicity
from casewright.llm.common import BATCH_BYTES, table
from casewright.llm.queries import BYTE_VOCABULARY, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows handed to a Python worker at once; whole texts among them make batches large.
BATCH_ROWS = 2000
#: A passage of over 50 words that repeats goes. It has 275 to 396 bytes in nine of ten places, so no length in bytes stands for it.
PASSAGE_WORDS = 51


def tune(spark: SparkSession) -> None:
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5; it learns from the labelled rows of this input."""
    tune(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that shares four fifths of its five-word shingles."""
    tune(spark)
    return jaccard_join.one_of_each(docs, jaccard_join.Rule(words=5, percent=80))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 51 words that also start elsewhere; a text that loses everything goes."""
    tune(spark)
    text = F.col("text")
    cut = suffix_dedup.cleaned(docs.withColumn("text", F.coalesce(text, F.lit(""))).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), PASSAGE_WORDS, words=True)
    # n_chars still has the length before the cut.
    return cut.filter((text != "") | (F.col("n_chars") == 0)).withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    tune(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of the ids and of the text decoded from them."""
    tune(spark)
    return bpe.round_trip(docs, vocabulary(BYTE_VOCABULARY), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("jaccard_join", one_of_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", remove_benchmarks),
    ("bpe", encode),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.stage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
