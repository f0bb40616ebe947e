"""Inputs the test tables do not hold: new files between stream runs, nulls, hot labels, many draws."""

import pytest
from pyspark.sql import functions as F

from featherloom.catalog.hooks import _finish, _merge, _start
from featherloom.operators import aggregates, encode, joins, metrics, models, splits
from featherloom import session
from featherloom.plans import shop
from featherloom.session import scratch_path
from featherloom.streaming import jobs


@pytest.fixture
def feed(spark):
    """A folder of events that grows, and all rows written to it so far."""
    path = scratch_path(spark, "feed")
    rows = []

    def add(new):
        rows.extend(new)
        spark.createDataFrame(new, "id long, k long, us long").select("id", "k", F.timestamp_micros("us").alias("ts")).coalesce(1).write.mode("append").parquet(path)
        return jobs.read_files(spark, path, spark.read.parquet(path).schema)

    return add, rows


def minutes(*ms, start=0, key=1):
    return [(start + i, key, m * 60_000_000) for i, m in enumerate(ms)]


def test_second_run_reads_new_files(spark, feed):
    add, rows = feed
    out = scratch_path(spark, "out")
    jobs.run_to_files(add(minutes(*range(100))), out, f"{out}-progress")
    jobs.run_to_files(add(minutes(*range(50), start=1000)), out, f"{out}-progress")
    assert spark.read.parquet(out).count() == len(rows) == 150


def test_open_windows_are_kept_over_runs(spark, feed):
    add, rows = feed
    out = scratch_path(spark, "out")
    for new in (minutes(*range(0, 300, 7)), minutes(*range(300, 500, 3), start=500)):
        last = jobs.last_seen(add(new), "k", "ts")
        jobs.run_updates(last, out, f"{out}-progress")
    got = jobs.latest(spark, out, last.schema, ["day", "k"]).agg(F.unix_micros(F.max("last_seen"))).first()[0]
    assert got == max(r[2] for r in rows)


def test_pane_gaps_hold_open_panes_and_flag_late_events(spark, feed):
    """Three runs over hourly panes; the state store keeps only open panes, and what comes after its pane is given out has no gap."""
    add, rows = feed
    out = scratch_path(spark, "out")
    waiting = []
    for new in (minutes(0, 10, 30, 25, 70), minutes(65, 62, 190, start=10) + minutes(150, 155, start=20, key=2), minutes(5, 200, 400, start=30)):
        jobs.run_pane_gaps(add(new), out, f"{out}-progress", "k", "ts", "id", late_seconds=600, pane_seconds=3600)
        state = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{out}-progress")
        waiting.append({r["id"] for r in state.select("list_element.id").collect()})
    got = {r["id"]: r["gap_seconds"] for r in jobs.pane_gaps_now(spark, out, f"{out}-progress", "k", "id").collect()}
    late = {30}  # minute 5 comes when the watermark stands at minute 180
    want = dict.fromkeys(late)
    for key in (1, 2):
        at = sorted((us, i) for i, k, us in rows if k == key and i not in late)
        want |= {i: None if n == 0 else (us - at[n - 1][0]) / 1e6 for n, (us, i) in enumerate(at)}
    assert got == want and len(got) == len(rows)
    assert waiting == [{4}, {12}, {32}]


def test_pane_gaps_without_events_or_times(spark, feed):
    add, _ = feed
    out = scratch_path(spark, "out")
    jobs.run_pane_gaps(add([(1, 1, None), (2, None, 60_000_000), (3, None, 90_000_000)]), out, f"{out}-progress", "k", "ts", "id")
    got = {r["id"]: (r["k"], r["gap_seconds"]) for r in jobs.pane_gaps_now(spark, out, f"{out}-progress", "k", "id").collect()}
    assert got == {1: (1, None), 2: (None, None), 3: (None, 30.0)}


def test_gaps_across_runs_put_late_events_in_order(spark, feed):
    add, rows = feed
    out = scratch_path(spark, "out")
    for new in (minutes(0, 10, 30, 25), minutes(28, 27, 50, start=10) + minutes(5, 45, start=20, key=2), minutes(47, 90, start=30)):
        jobs.run_event_gaps(add(new), out, f"{out}-progress", "k", "ts", "id")
    got = {r["id"]: r["gap_seconds"] for r in jobs.event_gaps_now(spark, out, "k", "id").collect()}
    want = {}
    for key in (1, 2):
        at = sorted((us, i) for i, k, us in rows if k == key)
        want |= {i: None if n == 0 else (us - at[n - 1][0]) / 1e6 for n, (us, i) in enumerate(at)}
    assert got == want


def test_draws_have_no_upper_bound(spark):
    n = splits.sample_rows(spark.range(2000), "id", 20.0, 3, replacement=True).count()
    assert 39_000 < n < 41_000
    d = spark.range(20000).select(splits.poisson_count(["id"], 5, 0.8).alias("n")).groupBy("n").count().collect()
    assert sum(r["n"] * r["count"] for r in d) / 20000 == pytest.approx(0.8, abs=0.03)


def test_caps_above_a_thousand(spark):
    d = spark.range(6000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    got = splits.capped_per_class(d, "id", "y", {0: 5000, 1: 100}, 1).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in got} == {0: 5000, 1: 100}


def test_bins_beyond_the_grid_stay(spark):
    d = spark.createDataFrame([(-1,), (0,), (2,), (7,), (7,), (None,)], "b int")
    assert {r["bin"]: r["w"] for r in aggregates.histogram(d, F.col("b"), 3).collect()} == {-1: 1, 0: 1, 1: 0, 2: 1, 7: 2}


def test_null_scores_are_no_hits(spark):
    d = spark.createDataFrame([(1, None), (1, 0.2), (0, 0.8), (0, None)], "y int, s double")
    got = {r["threshold"]: (r["tp"], r["fp"], r["p"], r["n"]) for r in metrics.counts_at(d, "y", "s", [0.1, 0.5, 0.9], at_most=True).collect()}
    assert got == {0.1: (0, 0, 2, 2), 0.5: (1, 0, 2, 2), 0.9: (1, 1, 2, 2)}
    bins = {r["bin"]: r["n"] for r in metrics.calibration(d, "y", "s").collect()}
    assert bins == {None: 2, 2: 1, 8: 1}


@pytest.mark.parametrize("small", [1024, 1])
def test_null_gets_no_bin_and_no_centre(spark, small, monkeypatch):
    monkeypatch.setattr(joins, "SMALL_LOOKUP", small)
    d = spark.createDataFrame([(1, None), (2, 0.0), (3, 5.0), (4, 10.0)], "id int, x double")
    for closed in (True, False):
        assert {r["id"]: r["b"] for r in encode.equal_width_bin(d, "x", "b", 2, closed).collect()}[1] is None
    table = spark.createDataFrame([(1.0, 9), (1.0, 3), (8.0, 4)], "c double, m int")
    got = {r["id"]: (r["c"], r["m"]) for r in joins.nearest_lookup(d, "x", table, "c", ["m"]).collect()}
    assert got == {1: (None, None), 2: (1.0, 3), 3: (8.0, 4), 4: (8.0, 4)}


def test_spread_of_constant_groups():
    import pandas as pd
    for v in (0.1, 1e8 + 0.3, 7.0):
        part = pd.DataFrame({"value": [v] * 7})
        variation, peak = _finish(_merge(_start(part), _merge(_start(part), _start(part))))
        assert isinstance(variation, float) and variation == pytest.approx(0, abs=1e-9) and peak == pytest.approx(1)


def test_trend_is_exact(spark):
    d = spark.createDataFrame([(1, f"2024-0{m}-10", float(m * 3)) for m in range(1, 8)] + [(2, "2024-01-01", 5.0)], "k int, t string, v double")
    got = aggregates.monthly_trend(d.withColumn("t", F.to_timestamp("t")), ["k"], "t", "v", "s").collect()
    assert {r["k"]: r["s"] for r in got} == {1: 3.0, 2: 0.0}


@pytest.mark.parametrize("small", [1024, 1])
def test_lookups_small_and_large(spark, small, monkeypatch):
    monkeypatch.setattr(joins, "SMALL_LOOKUP", small)
    rows = [(i, None if i % 17 == 0 else i * 37 % 101 / 2) for i in range(300)]
    d = spark.createDataFrame(rows, "id int, x double")
    centres = [(float(c), c * 10) for c in (3, 9, 10, 27, 44)]
    got = {r["id"]: (r["c"], r["m"]) for r in joins.nearest_lookup(d, "x", spark.createDataFrame(centres, "c double, m int"), "c", ["m"]).collect()}
    assert got == {i: (None, None) if x is None else min(centres, key=lambda c: (abs(c[0] - x), c[0])) for i, x in rows}
    bins = [(0.0, 5.0, "a"), (7.0, 20.5, "b"), (20.5, 40.0, "c")]
    got = {r["id"]: r["l"] for r in joins.range_lookup(d, "x", spark.createDataFrame(bins, "lo double, hi double, l string"), "lo", "hi", "l").collect()}
    assert got == {i: None if x is None else next((n for a, b, n in bins if a < x <= b), None) for i, x in rows}


def test_scratch_is_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", [])
    path = session.scratch_path(spark, "left")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not session._written
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_user_without_an_action_type_has_no_clusters_of_it(spark):
    """The count of clusters is 0 there as all other counts are, not null."""
    rows = [(1, 7, "2024-01-19 10:00:00", 5, "click", 1, None), (2, 7, "2024-01-19 11:00:00", 6, "click", 2, None), (3, 8, "2024-01-19 11:00:00", 6, "purchase", 2, None)]
    actions = spark.createDataFrame(rows, "event_id long, user_id long, ts string, product_id long, action string, cluster int, widget int").withColumn("ts", F.col("ts").cast("timestamp"))
    products = spark.createDataFrame([(5, 9.5, "b", "c", 1), (6, 3.0, "b", "c", 2)], "product_id long, price double, brand string, category string, cluster int")
    got = {r["user_id"]: r for r in shop.action_features(actions, products, "2024-01-21", 15).collect()}
    counts = {u: [r[f"num_{s}_clusters"] for s in ("click", "favorite", "order", "to_cart")] for u, r in got.items()}
    assert counts == {7: [2, 0, 0, 0], 8: [0, 0, 1, 0]}
    assert got[7]["main_order_cluster"] is None


def test_small_variance_drop_beside_a_large_mean(spark):
    """The drop is found as between the sides, so a mean of 10^7 does not drown a drop of about 0.1."""
    x, y = [i % 5 for i in range(200)], [0.25 * (i % 8) + (0.7 if i % 5 > 2 else 0.0) for i in range(200)]
    df = spark.createDataFrame([(float(a), 1e7 + b) for a, b in zip(x, y)], "x double, y double")

    def mean(v):
        return sum(v) / len(v)

    def drop(edge):
        sides = [[b for a, b in zip(x, y) if a < edge], [b for a, b in zip(x, y) if a > edge]]
        return sum(len(s) / len(y) * (mean(s) - mean(y)) ** 2 for s in sides)

    got = models.best_splits(df, ["x"], "y", "mse").first()
    assert got["threshold"] == 2.5 and got["gain"] == pytest.approx(drop(2.5), rel=1e-6)


def test_trees_over_cells_see_every_row(spark):
    """The number of cells does not follow the number of rows, their sums are those of all rows, and a tree over them is the tree over the rows."""
    from pyspark.ml.regression import DecisionTreeRegressor

    df = spark.range(20_000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") * 37 % 9973).cast("double").alias("b"),
                                    ((F.col("id") % 7 > 3).cast("double") * 5 + F.col("id") % 11).alias("y"))
    cells = models.tree_cells(df, ["a", "b"], "y").cache()
    assert cells.count() <= 7 * 32
    total = df.agg(F.count("*"), F.sum("y"), F.sum(F.col("y") * F.col("y"))).first()
    assert list(cells.agg(F.sum("n"), F.sum("__s"), F.sum("__ss")).first()) == pytest.approx(list(total))
    tree = DecisionTreeRegressor(featuresCol="features", labelCol="y", maxDepth=1, maxBins=64)
    plain = models.fit_on(["a", "b"], tree, df).transform(df).agg(metrics.rmse(F.col("y"), F.col("prediction"))).first()[0]
    celled = models.fit_on(["a", "b"], tree.copy({tree.weightCol: "n"}), cells).transform(cells).agg(models.rmse_of_cells(cells, F.col("prediction"))).first()[0]
    assert celled == pytest.approx(plain, rel=1e-9)
