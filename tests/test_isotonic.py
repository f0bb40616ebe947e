"""Isotonic regression cut into chunks and slope ranges, beside pooling in plain Python; threshold lines beside every threshold."""

import random

import pytest
from pyspark.sql import functions as F

from featherloom.operators import isotonic, metrics


def pooled(points):
    """{score: fitted} by pooling adjacent violators."""
    sums = {}
    for x, y in points:
        s, n = sums.get(x, (0, 0))
        sums[x] = (s + y, n + 1)
    blocks = []
    for x in sorted(sums):
        blocks.append([*sums[x], [x]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, xs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + xs]
    return {x: s / n for s, n, xs in blocks for x in xs}


def cases():
    r = random.Random(5)
    yield "noisy", [(i / 7, int(r.random() < i / 300)) for i in range(300)]
    yield "rising", [(float(i), float(i * i)) for i in range(200)]
    yield "falling", [(float(i), float(-i)) for i in range(200)]
    yield "ties", [(float(r.randrange(12)), r.randrange(2)) for _ in range(400)]
    yield "waves", [(float(i), float((i % 40) + i // 40)) for i in range(240)]


@pytest.mark.parametrize("name,points", list(cases()))
def test_chunks_and_slope_ranges_pool_like_one_stack(spark, name, points):
    d = spark.createDataFrame([(x, float(y)) for x, y in points], "x double, y double")
    want = pooled(points)
    got = {r["x"]: r["fitted"] for r in isotonic.fit(d, "x", "y", chunk_rows=16, corners=6).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_keys_nulls_and_prediction(spark):
    rows = [("a", 1.0, 0.0), ("a", 3.0, 1.0), (None, 1.0, 1.0), (None, 2.0, 0.0), ("a", None, 1.0), ("a", 2.0, None), ("a", float("nan"), 1.0)]
    d = spark.createDataFrame(rows, "k string, x double, y double")
    fitted = isotonic.fit(d, "x", "y", ["k"])
    assert {(r["k"], r["x"], r["fitted"]) for r in fitted.collect()} == {("a", 1.0, 0.0), ("a", 3.0, 1.0), (None, 1.0, 0.5), (None, 2.0, 0.5)}
    asked = spark.createDataFrame([("a", 0.0), ("a", 1.5), ("a", 9.0), (None, 5.0), ("b", 1.0), ("a", None), ("a", 1.5)], "k string, x double")
    got = sorted((str(r["k"]), str(r["x"]), r["p"]) for r in isotonic.predict(fitted, asked, "x", "p", ["k"]).collect())
    assert got == sorted([("a", "0.0", 0.0), ("a", "1.5", 0.25), ("a", "1.5", 0.25), ("a", "9.0", 1.0), ("None", "5.0", 0.5), ("b", "1.0", None), ("a", "None", None)],
                         key=lambda r: r[:2])
    assert isotonic.fit(d.where("false"), "x", "y", ["k"]).count() == 0


def test_out_of_fold_fits_leave_the_own_fold_out(spark):
    r = random.Random(8)
    rows = [(i, r.choice([0, 1, None]), r.randrange(9) / 4, r.randrange(2)) for i in range(90)] + [(90, 0, None, 1), (91, 1, 1.0, None)]
    d = spark.createDataFrame(rows, "id int, f int, x double, y int")
    got = {r["id"]: r["p"] for r in isotonic.out_of_fold(d, "x", "y", "f", "p").collect()}
    assert len(got) == len(rows)
    for i, f, x, _ in rows:
        want = pooled([(a, b) for _, g, a, b in rows if g != f and a is not None and b is not None])
        if x is None:
            assert got[i] is None
        elif x in want:
            assert abs(got[i] - want[x]) < 1e-9


def test_threshold_line_is_the_best_of_all_thresholds(spark):
    r = random.Random(3)
    rows = [(r.randrange(3), *[r.randrange(20) / 20 if r.random() > .1 else None for _ in range(3)]) for _ in range(80)] + [(None, .5, .5, .5), (1, None, None, None)]
    d = spark.createDataFrame(rows, "y int, a double, b double, c double")
    probs, weights = ["a", "b", "c"], [1.0, .7, .4]
    found = metrics.threshold_lines(d, "y", probs, [.2, .3, .4], weights, weights)
    now = [.2, .3, .4]
    for i, (at, loss) in enumerate(found):
        tries = sorted({x[i + 1] for x in rows if x[i + 1] is not None} | {1.0})
        losses = d.agg(*[metrics.weighted_mae(F.col("y"), metrics.pick_class(probs, now[:i] + [t] + now[i + 1:], weights), weights) for t in tries]).first()
        assert abs(min(losses) - loss) < 1e-9 and abs(losses[tries.index(at)] - loss) < 1e-9
        assert not any(abs(v - loss) < 1e-9 for t, v in zip(tries, losses) if t > at)
        now[i] = at
    assert metrics.threshold_lines(d.where("false"), "y", probs, now, weights, weights) == [(t, None) for t in now]
