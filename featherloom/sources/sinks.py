"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, encoding: str = "UTF-8") -> None:
    df.write.options(header=header, sep=sep, encoding=encoding, escape='"').csv(path)


def write_scores(df: DataFrame, path: str, key: str, prob: str) -> None:
    """Lines ``key<TAB>probability`` with six decimals and no header."""
    df.select(key, F.format_string("%.6f", F.col(prob)).alias(prob)).write.options(sep="\t").csv(path)


def write_parquet(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    writer = df.write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
