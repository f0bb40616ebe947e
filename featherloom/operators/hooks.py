"""Open hooks for user functions.

A group function gets no whole group. It is given in three parts, like an aggregate: ``start`` turns
a batch of one key's rows into a small state, ``merge`` joins two states, ``finish`` gives the result
row. States are made inside the partitions and merged in two steps, so of a hot key only small states
travel. Keys must not be null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.operators.stats import join_groups

def fold_groups(
    df: DataFrame, keys: list[str], state_schema: str, start: Callable[[Any], tuple], merge: Callable[[tuple, tuple], tuple],
    finish: Callable[[tuple], tuple], result_schema: str, salts: int = 32,
) -> DataFrame:
    """One row per key from user functions over batches (pandas frames) and states (tuples)."""
    key_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    state_names = [p.split()[0] for p in state_schema.split(",")]
    result_names = [p.split()[0] for p in result_schema.split(",")]
    width = len(keys)

    def batch_states(batch):
        for key, part in batch.groupby(keys, dropna=False, sort=False):
            yield key, start(part)

    def stored_states(batch):
        for row in batch[[*keys, *state_names]].itertuples(index=False, name=None):
            yield row[:width], row[width:]

    def combine(states: Callable, close: Callable | None = None) -> Callable:
        """Merge the states of neighbouring equal keys; input is sorted by key within a partition."""
        names = result_names if close else state_names

        def run(batches: Iterator) -> Iterator:
            import pandas as pd

            key, held = None, None

            def row():
                return (*key, *(close(held) if close else held))

            for batch in batches:
                done = []
                for k, state in states(batch):
                    if key is not None and all(a == b or (a != a and b != b) for a, b in zip(k, key)):
                        held = merge(held, state)
                        continue
                    if key is not None:
                        done.append(row())
                    key, held = k, state
                if done:
                    yield pd.DataFrame(done, columns=[*keys, *names])
            if key is not None:
                yield pd.DataFrame([row()], columns=[*keys, *names])

        return run

    state_columns, result_columns = f"{key_schema}, {state_schema}", f"{key_schema}, {result_schema}"
    states = df.sortWithinPartitions(*keys).mapInPandas(combine(batch_states), state_columns)
    salted = states.repartition(*keys, F.pmod(F.xxhash64(*state_names), F.lit(salts))).sortWithinPartitions(*keys)
    joined = salted.mapInPandas(combine(stored_states), state_columns)
    return joined.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(combine(stored_states, finish), result_columns)


def transform_groups(df: DataFrame, keys: list[str], folded: DataFrame, **cols: Column) -> DataFrame:
    """Per-row expressions over a row and its group's folded values."""
    return join_groups(df, folded, keys).withColumns(cols)


def evaluate(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """User metrics are aggregate expressions; all of them come from one pass."""
    return df.agg(*[m.alias(n) for n, m in metrics.items()])
