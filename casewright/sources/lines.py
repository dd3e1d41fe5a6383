"""Operators on raw text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known files where a line end is missing; (file, end of a record, id of the next).
MERGED_RECORDS = [
    ("DRUG11Q2", "$$$$$$", "7475791"),
    ("DRUG11Q3", "$$$$$$", "7652730"),
    ("DRUG11Q4", "021487$", "7941354"),
]

DELIMITERS = ["$", "|", "\t", ","]


def split_merged_records(lines: DataFrame, rules: list[tuple[str, str, str]] = MERGED_RECORDS) -> DataFrame:
    """Cut lines of (file_name, value) where two records run together, before the second one's id."""
    value = F.col("value")
    for name, tail, next_id in rules:
        merged, cut = tail + next_id, f"{tail}\n{next_id}"
        value = F.when(F.col("file_name").rlike(f"(?i){name}"), F.replace(value, F.lit(merged), F.lit(cut))).otherwise(value)
    return lines.withColumn("value", F.explode(F.split(value, "\n")))


def detect_delimiter(lines: DataFrame, candidates: list[str] = DELIMITERS) -> DataFrame:
    """Per file the delimiter whose most common field count covers most lines; earlier candidates win ties.

    A candidate that never occurs is no delimiter, however regular its single field.
    """
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("rank"), F.lit(d).alias("delimiter"),
                     (F.length("value") - F.length(F.replace(F.col("value"), F.lit(d), F.lit(""))) + 1).alias("n_fields"))
            for i, d in enumerate(candidates)
        ]
    )
    counted = (
        lines.select("file_name", F.explode(entries).alias("e"))
        .filter("e.n_fields > 1")
        .groupBy("file_name", "e.rank", "e.delimiter", "e.n_fields")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    return counted.groupBy("file_name").agg(
        F.max_by(F.struct("delimiter", "n_lines"), F.struct("n_lines", -F.col("rank"))).alias("best")
    ).select("file_name", "best.delimiter", "best.n_lines")
