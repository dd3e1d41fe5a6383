"""Text columns as dense numbers of a shared code table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.operators.joins import lookup_join
from casewright.operators.numbering import RANGE_ROWS, numbered
from casewright.operators.quality import narrow_stats
from casewright.session import stage

MISSING = -1


def category_columns(df: DataFrame, max_share: float = 0.5) -> list[str]:
    """Text columns with few different values."""
    return [r["column_name"] for r in narrow_stats(df, max_share).filter("target = 'category'").collect()]


def code_table(df: DataFrame, columns: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``column_name, value, code``: the values of each column in their order, numbered from 0.

    Values of all columns are counted together, dealt by ranges and numbered
    there, so neither a column nor its values go to one task.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    values = df.select(F.explode(entries).alias("e")).select("e.*").filter(F.col("value").isNotNull()).distinct()
    return numbered(values, ["value"], "code", by="column_name", range_rows=range_rows).withColumn("code", (F.col("code") - 1).cast("int"))


def _one(codes: DataFrame, column: str) -> DataFrame:
    return codes.filter(F.col("column_name") == column)


def encode(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as codes; a missing value, or one the table lacks, is -1."""
    out = df
    for c in columns:
        book = _one(codes, c).select(F.col("value").alias(c), F.col("code").alias("_code"))
        out = lookup_join(out, book, [c]).withColumn(c, F.coalesce("_code", F.lit(MISSING))).drop("_code")
    return out.select(*df.columns)


def decode(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as values again; -1 is missing."""
    out = df
    for c in columns:
        book = _one(codes, c).select(F.col("code").alias(c), F.col("value").alias("_value"))
        out = lookup_join(out, book, [c]).withColumn(c, F.col("_value")).drop("_value")
    return out.select(*df.columns)


def encode_categories(df: DataFrame, max_share: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """The frame with all its category columns coded, and the code table."""
    columns = category_columns(df, max_share)
    if not columns:
        return df, df.sparkSession.createDataFrame([], "column_name string, value string, code int")
    codes = stage(code_table(df, columns), "codes")
    return encode(df, codes, columns), codes
