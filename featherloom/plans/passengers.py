"""Passenger table cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.functions.strings import split_part
from featherloom.operators.encode import map_values


def clean_passengers(df: DataFrame, codes: dict[str, dict[str, int]]) -> DataFrame:
    """Split id, cabin and name into parts and code the listed categories; missing values become -1."""
    d = df.withColumns({
        "group": split_part(F.col("passenger_id"), "_", 0).try_cast("int"), "num_in_group": split_part(F.col("passenger_id"), "_", 1).try_cast("int"),
        "deck": split_part(F.col("cabin"), "/", 0), "num": split_part(F.col("cabin"), "/", 1).try_cast("int"), "side": split_part(F.col("cabin"), "/", 2),
        "first_name": split_part(F.col("name"), " ", 0), "last_name": split_part(F.col("name"), " ", 1)}).drop("cabin", "name")
    d = d.withColumns({c: map_values(F.col(c), m) for c, m in codes.items()})
    whole = {f.name: -1 for f in d.schema.fields if f.dataType.simpleString() in ("int", "bigint", "double", "float")}
    return d.fillna(whole).fillna("-1")
