"""Table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = True) -> None:
    """Snappy Parquet, one folder per quarter where the table has one.

    Rows are first rebalanced by quarter, which gives few files per folder and
    still splits a quarter too large for one task. Rows that come straight from
    files of one quarter each need none of that.
    """
    if "quarter" in df.columns:
        dealt = df.hint("rebalance", "quarter") if rebalance else df
        dealt.write.mode(mode).partitionBy("quarter").option("compression", "snappy").parquet(path)
    else:
        df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
