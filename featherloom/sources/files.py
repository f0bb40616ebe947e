"""File sources. Every reader takes an explicit schema; float NaN is read as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing marker: NaN in float columns becomes NULL."""
    fix = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(fix) if fix else df


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One file, a folder, or a glob of part files as one table."""
    return nan_to_null(spark.read.parquet(*paths))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """CSV with a header line. Cells that do not parse become NULL."""
    opts = {"header": True, "mode": "PERMISSIVE", "escape": '"', **options}
    return nan_to_null(spark.read.options(**opts).schema(schema).csv(path))


def read_headerless(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "\t", encoding: str = "UTF-8"
) -> DataFrame:
    """Separated lines without a header; names come from the schema, by position."""
    return nan_to_null(spark.read.options(sep=sep, encoding=encoding).schema(schema).csv(path))


def read_vector_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``arm reward f1 .. fn`` separated by any white space."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).select(
        parts[0].cast("int").alias("arm"),
        parts[1].cast("double").alias("reward"),
        F.slice(parts, F.lit(3), F.size(parts) - 2).cast("array<double>").alias("features"),
    )


def strip_bom(df: DataFrame) -> DataFrame:
    """Remove a byte-order mark that ended up in the first column's name."""
    return df.toDF(*[c.lstrip(BOM) for c in df.columns])
