"""Star-schema denormalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def denormalize(
    lines: DataFrame, orders: DataFrame, parts: DataFrame, customers: DataFrame,
    suppliers: DataFrame, nations: DataFrame, regions: DataFrame,
) -> DataFrame:
    """Order lines with all dimension columns; lines without a match are kept."""
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
