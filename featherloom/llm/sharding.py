"""Reproducible shuffle and shards from a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.llm.common import number_rows

ROUNDS = 8


def _grid(rows: int) -> tuple[int, int]:
    """Sides of the smallest nearly square grid with at least ``rows`` cells."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _half(left: Column, right: Column, side: int, seed: int) -> Column:
    """``left`` moved round its side by a keyed hash of ``right``: a bijection for each ``right``."""
    return F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), right), F.lit(side)), F.lit(side))


def _feistel(x: Column, a: int, b: int, seed: int) -> Column:
    """One permutation of 0 to a*b-1 as one expression."""
    left, right = F.floor(x / F.lit(b)).cast("long"), F.pmod(x, F.lit(b))
    for i in range(0, ROUNDS, 2):
        left = _half(left, right, a, seed * ROUNDS + i)
        right = _half(right, left, b, seed * ROUNDS + i + 1)
    return left * F.lit(b) + right


def permute(df: DataFrame, number: str, rows: int, name: str, seed: int) -> DataFrame:
    """Adds ``name``: the place of row ``number`` (0 to rows-1) in a keyed permutation of 0 to rows-1.

    The permutation works on a grid of at least ``rows`` cells; a place beyond the rows is permuted again until it falls inside
    (cycle walking). A cycle holds at most grid - rows < sqrt(rows) + 1 cells outside, so that many steps always suffice; they are spent
    only on the about 1 in sqrt(rows) rows that fall outside at first.
    """
    a, b = _grid(rows)
    df = df.withColumns({"__l": F.expr(f"`{number}` div {b}L"), "__r": F.pmod(F.col(number), F.lit(b))})
    for i in range(0, ROUNDS, 2):
        df = df.withColumn("__l", _half(F.col("__l"), F.col("__r"), a, seed * ROUNDS + i))
        df = df.withColumn("__r", _half(F.col("__r"), F.col("__l"), b, seed * ROUNDS + i + 1))
    df = df.withColumn(name, F.col("__l") * F.lit(b) + F.col("__r")).drop("__l", "__r")
    if a * b == rows:
        return df
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(a * b - rows)), F.col(name),
                       lambda at, _: F.when(at < F.lit(rows), at).otherwise(_feistel(at, a, b, seed)))
    return df.withColumn(name, F.when(F.col(name) < F.lit(rows), F.col(name)).otherwise(walk))


def assign(docs: DataFrame, shards: int, order: list[str], seed: int = 7) -> DataFrame:
    """Adds ``position`` (place in the shuffle), ``shard`` and ``slot`` to every row.

    Rows are numbered in the order of ``order`` (nulls first), the numbers permuted; shard = position mod shards and slot = position div
    shards, so shard sizes differ by one row at most and slots have no gaps. A row's shard and slot can be computed from its row number
    and the number of rows alone. Rows that tie in ``order`` are numbered in any order, so list enough columns to tell rows apart;
    equal rows then swap nothing. An empty table gives an empty table. Input columns named like the added ones are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    named = number_rows(docs.drop("position", "shard", "slot", "__row"), [F.col(c).asc_nulls_first() for c in order], "__row", "sharded")
    rows = named.count()
    placed = permute(named, "__row", rows, "position", seed).drop("__row")
    return placed.withColumns({"shard": F.pmod("position", F.lit(shards)).cast("int"), "slot": F.expr(f"position div {shards}L")})
