"""Operators that look at a bounded part first: quantile brackets and nearest neighbours through pivots."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherloom.operators import knn, quantiles
from featherloom.streaming import jobs

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def columns(n, seed):
    rnd = random.Random(seed)
    return [(rnd.gauss(0, 1), float(rnd.randrange(5)), None, 7.0 if rnd.random() < 0.97 else rnd.random(), i if i % 3 else None) for i in range(n)]


@pytest.mark.parametrize("n, accuracy, inside", [(1, 10_000, 1 << 20), (2, 10_000, 1), (1000, 10_000, 1 << 20), (5000, 50, 1 << 20), (5000, 50, 20), (5000, 20, 1)])
def test_column_quantiles_are_exact(spark, monkeypatch, n, accuracy, inside):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "INSIDE", inside)
    rows = columns(n, n)
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e long").repartition(3)
    got = quantiles.column_quantiles(df, {c: SHARES for c in "abcde"})
    for i, c in enumerate("abcde"):
        have = np.array([r[i] for r in rows if r[i] is not None], float)
        want = [None] * len(SHARES) if not len(have) else np.quantile(have, SHARES).tolist()
        assert got[c] == (want if not len(have) else pytest.approx(want, abs=1e-12)), c


def test_quantiles_shuffle_only_the_bracket(spark):
    """Of 200,000 different values the counting pass shuffles those near the searched rank."""
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    spark.sparkContext.setJobGroup("bracket", "bracket")
    got = quantiles.column_quantiles(df, {"v": [0.5]})["v"][0]
    spark.sparkContext.setJobGroup(None, None)
    store = spark._jsc.sc().statusStore()
    jobs = [store.job(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("bracket")]
    written = sum(store.lastStageAttempt(s).shuffleWriteRecords() for j in jobs for s in [j.stageIds().apply(i) for i in range(j.stageIds().size())])
    print(f"rows shuffled: {written} of 200000")
    assert written < 2000
    assert got == pytest.approx(np.median([r["v"] for r in df.collect()]))


def clustered(n, dim, centres, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    x = middle[rng.integers(0, centres, n)] + 0.05 * rng.normal(size=(n, dim))
    x[::50] = x[0]  # copies
    return x


def plain(x, k):
    out = {}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(1)
        out[i] = [int(j) for j in np.lexsort((np.arange(len(x)), np.round(d, 12))) if j != i][:k]
    return out


@pytest.mark.parametrize("name, x", [("clustered", clustered(2000, 16, 20, 1)), ("spread", np.random.default_rng(2).normal(size=(300, 8))), ("copies", np.ones((40, 3))),
                                     ("few", np.eye(4))])
def test_pivot_search_is_exact(spark, name, x):
    k = 5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").repartition(3)
    found, seen = knn.pivot_search(df, df, "id", "vec", k, exclude="id", pivots=16, block_rows=64)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == {i: v for i, v in plain(x, k).items() if v}
    pairs = seen.agg(F.sum("rows")).first()[0]
    print(f"{name}: {pairs} of {len(x) ** 2} pairs compared")
    if name == "clustered":
        assert pairs < len(x) ** 2 / 4


def test_pivot_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    assert knn.pivot_nearest(none, none, "id", "vec", 3).count() == 0


def test_sliding_counts_from_panes(spark):
    """30-day windows from daily panes equal windows over the events."""
    rnd = random.Random(4)
    day = np.datetime64("2024-01-01")
    rows = [(rnd.randrange(3), int(d), rnd.randrange(1, 5)) for d in sorted(rnd.sample(range(90), 40))]
    df = spark.createDataFrame([(str(day + d), u, n) for u, d, n in rows], "day string, user_id long, n long").withColumn("day", F.col("day").cast("timestamp"))
    got = {(r["end"].date().isoformat(), r["user_id"]): r["n"] for r in jobs.sliding_from_panes(df, "user_id", 30).collect()}
    want = {}
    for u, d, n in rows:
        for i in range(1, 31):
            want[str(day + d + i), u] = want.get((str(day + d + i), u), 0) + n
    assert got == want


def test_a_search_task_holds_one_batch_of_base_rows():
    """Base rows pass through a task batch by batch; only the queries and their best rows stay."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(5)

    def batch(start, x, base):
        n = len(x)
        zero = pa.array(np.zeros(n, "int64"))
        vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="int32") * x.shape[1]), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(start, start + n)), vec, zero, zero, zero, zero, pa.array([base] * n)],
                                          names=["id", "vec", "skip", "cell", "qb", "bb", "base"])

    queries = rng.normal(size=(50, 32))
    seen = []

    def feed():
        yield batch(0, queries, False)
        for i in range(60):
            x = rng.normal(size=(4000, 32))
            seen.append(x.astype("float32"))
            yield batch(i * 4000, x, True)

    tracemalloc.start()
    got = [b for b in knn._block_search(3, False)(feed())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(f"peak MB {peak / 1e6:.0f} with 61 MB of base rows")
    assert peak - sum(x.nbytes for x in seen) < 45e6
    assert sum(b.num_rows for b in got) == 150


def test_buckets_that_hold_most_pairs_are_searched_once(spark, monkeypatch):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.random.default_rng(6).normal(size=(60, 4)))], "id long, vec array<double>")
    cells, plain_nearest = [], knn.nearest
    monkeypatch.setattr(knn, "nearest", lambda *a, **o: cells.append(o.get("cell")) or plain_nearest(*a, **o))
    found = knn.lsh_nearest(df, "id", "vec", 3, bucket_length=1e6, tables=24)
    assert cells == [None]
    assert found.exceptAll(plain_nearest(df, df, "id", "vec", 3, exclude="id")).count() == 0


def test_block_pairs_are_dealt_in_turn(spark):
    """Eight pairs of one cell go to eight of 24 tasks; hashed, several met in one task."""
    pairs = spark.range(8).select(F.lit(0).cast("long").alias("cell"), F.col("id").cast("int").alias("qb"), F.lit(0).alias("bb"), F.lit(1).alias("nb"))
    rows = pairs.crossJoin(spark.range(3).select(F.col("id")))
    at = {(r["qb"], r["at"]) for r in knn._in_turn(rows, 24).select("qb", F.spark_partition_id().alias("at")).collect()}
    assert len(at) == len({qb for qb, _ in at}) == len({p for _, p in at}) == 8
    hashed = {r["at"] for r in rows.repartition(24, "cell", "qb", "bb").select(F.spark_partition_id().alias("at")).collect()}
    assert len(hashed) < 8
