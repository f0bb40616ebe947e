"""Literal examples with known results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from featherloom.functions import arrays, dates, numbers, rows, strings
from featherloom.operators import aggregates, categories, encode, joins, metrics, models, reshape, windows


def frame(spark, cols, data, schema):
    return spark.createDataFrame(data, schema).toDF(*cols)


def ordered(df, key, col):
    return [r[col] for r in df.orderBy(key).collect()]


def series(spark, values, kind="double"):
    return spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")


def test_drop_repeats(spark):
    d = series(spark, [1, 2, 2, 3, 4, 5, 5, 5, 6, 7, 7], "int")
    assert ordered(windows.drop_repeats(d, [], ["i"], "v"), "i", "v") == [1, 2, 3, 4, 5, 6, 7]


def test_nth_null_label(spark):
    n = None
    grid = [(0.04, n, n, 0.25, n, 0.43, 0.71, 0.51, n, n), (n, n, n, 0.04, 0.76, n, n, 0.67, 0.76, 0.16), (n, n, 0.5, n, 0.31, 0.4, n, n, 0.24, 0.01),
            (0.49, n, n, 0.62, 0.73, 0.26, 0.85, n, n, n), (n, n, 0.41, n, 0.05, n, 0.61, n, 0.48, 0.68)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(grid)], "id int, " + ", ".join(f"{c} double" for c in "abcdefghij"))
    assert ordered(d.select("id", rows.nth_null_label(list("abcdefghij"), 3).alias("x")), "id", "x") == ["e", "c", "d", "h", "d"]


def test_sum_of_three_largest(spark):
    d = spark.createDataFrame(list(zip("aaabbcaabcccbbc", [12, 345, 3, 1, 45, 14, 4, 52, 54, 23, 235, 21, 57, 3, 87])), "g string, v int")
    got = {r["g"]: r["s"] for r in aggregates.sum_of_largest(d, ["g"], "v", 3, "s").collect()}
    assert got == {"a": 409, "b": 156, "c": 345}


def test_distance_to_previous_zero(spark):
    d = series(spark, [7, 2, 0, 3, 4, 2, 5, 0, 3, 4], "int")
    assert ordered(windows.since_last(d, [], ["i"], F.col("v") == 0, "x"), "i", "x") == [1, 2, 0, 1, 2, 3, 4, 0, 1, 2]


def test_fill_negatives(spark):
    vals = [-12, -7, -14, 4, -7, 28, -2, -1, 8, -2, 28, 12, 16, -24, -12]
    d = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(zip("ABAAABAAABAAAAA", vals))], "i int, g string, v int")
    got = windows.fill_negatives(d, ["g"], "v", "x").collect()
    assert {(r["g"], r["x"]) for r in got if r["v"] < 0} == {("A", 13.6), ("B", 28.0)}


def test_grouped_rolling_mean(spark):
    n = None
    d = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(zip("aabbabbbabab", [1.0, 2.0, 3.0, n, 2.0, 3.0, n, 1.0, 7.0, 3.0, n, 8.0]))], "i int, g string, v double")
    got = ordered(windows.rolling_stats(d, ["g"], ["i"], "v", 3), "i", "rolling_mean_3")
    assert got == pytest.approx([1, 1.5, 3, 3, 5 / 3, 3, 3, 2, 11 / 3, 2, 4.5, 4])


def test_flight_cleanup(spark):
    data = [(0, "LoNDon_paris", 10045.0, [23, 47], "KLM(!)"), (1, "MAdrid_miLAN", None, [], "<Air France> (12)"), (2, "londON_StockhOlm", 10065.0, [24, 43, 87], "(British Airways. )"),
            (3, "Budapest_PaRis", None, [13], "12. Air France"), (4, "Brussels_londOn", 10085.0, [67, 32], '"Swiss Air"')]
    d = spark.createDataFrame(data, "i int, route string, number double, delays array<int>, airline string")
    d = windows.interpolate(d, [], ["i"], "number", "number_filled")
    out = d.select(
        "i", F.col("number_filled").cast("int").alias("number"), strings.capitalize(strings.split_part(F.col("route"), "_", 0)).alias("a"),
        strings.capitalize(strings.split_part(F.col("route"), "_", 1)).alias("b"), strings.letters(F.col("airline")).alias("airline"),
        *arrays.spread(F.col("delays"), ["d1", "d2", "d3"])).orderBy("i").collect()
    assert [tuple(r)[1:] for r in out] == [
        (10045, "London", "Paris", "KLM", 23, 47, None), (10055, "Madrid", "Milan", "Air France", None, None, None), (10065, "London", "Stockholm", "British Airways", 24, 43, 87),
        (10075, "Budapest", "Paris", "Air France", 13, None, None), (10085, "Brussels", "London", "Swiss Air", 67, 32, None)]


def test_impurity_values(spark):
    d = spark.createDataFrame([(v,) for v in [1, 1, 2, 4, 2, 2, 0, 1, 0, 4]], "y int")
    assert models.impurity(d, "y", "gini", [0, 1, 2, 4]).first()[0] == pytest.approx(0.74)
    assert models.impurity(d, "y", "entropy", [0, 1, 2, 4]).first()[0] == pytest.approx(1.3661548, abs=1e-6)


@pytest.mark.parametrize("kind, gain", [("gini", 0.5), ("entropy", 0.69314618)])
def test_best_split_of_a_step(spark, kind, gain):
    d = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") < 50).cast("int").alias("y"))
    row = models.best_splits(d, ["x"], "y", kind, [0, 1]).first()
    assert row["threshold"] == 49.5 and row["gain"] == pytest.approx(gain, abs=2e-6)


def test_best_split_of_six_points(spark):
    d = spark.createDataFrame(list(zip([0.1, 0.4, 0.2, 0.3, 0.5, 0.0], [0, 1, 0, 1, 1, 0])), "x double, y int")
    assert models.best_splits(d, ["x"], "y", "gini", [0, 1]).first()["threshold"] == pytest.approx(0.25)


def test_parse_guarded_predicate(spark):
    d = spark.createDataFrame([(v,) for v in [None, "", "abc", "20", "21", "39", "40", "25.0", " 25 "]], "if1 string")
    assert sorted(r[0] for r in d.where(strings.int_between(F.col("if1"), 20, 40)).collect()) == [" 25 ", "21", "39"]


def test_threshold_class_choice(spark):
    weights, thresholds = [1.0, 0.72, 0.52, 0.37, 0.27, 0.19, 0.14, 0.0], [0.24, 0.235, 0.122, 0.05, 0.05, 0.05, 0.05, 0.05]
    cols = [f"c{i}" for i in range(8)]
    d = spark.createDataFrame([(0.3, 0.3, 0.1, 0.1, 0.1, 0.05, 0.03, 0.02), (0.01, 0.23, 0.1, 0.04, 0.04, 0.04, 0.04, 0.04), (0.2, 0.1, 0.1, 0.04, 0.04, 0.04, 0.24, 0.24)], cols)
    assert [r[0] for r in d.select(metrics.pick_class(cols, thresholds, weights)).collect()] == [0, 1, 6]


def test_min_equal_gap(spark):
    assert windows.min_equal_gap(series(spark, [1, 2, 3, 1], "int").select(F.col("i").cast("long").alias("i"), "v"), "i", "v").first()[0] == 2
    assert windows.min_equal_gap(series(spark, [1, 2, 3], "int").select(F.col("i").cast("long").alias("i"), "v"), "i", "v").first()[0] == -1


def test_animals(spark):
    data = [("cat", 2.5, 1, "yes"), ("cat", 3.0, 3, "yes"), ("snake", 0.5, 2, "no"), ("dog", None, 3, "yes"), ("dog", 5.0, 2, "no"), ("cat", 2.0, 3, "no"),
            ("snake", 4.5, 1, "no"), ("cat", None, 1, "yes"), ("dog", 7.0, 2, "no"), ("dog", 3.0, 1, "no")]
    d = spark.createDataFrame([(label, *r) for label, r in zip("abcdefghij", data)], "k string, animal string, age double, visits int, priority string")
    assert [r["k"] for r in d.where("visits >= 3").orderBy("k").collect()] == ["b", "d", "f"]
    assert [r["k"] for r in d.where(F.col("age").isNull()).orderBy("k").collect()] == ["d", "h"]
    assert [r["k"] for r in d.where((F.col("animal") == "cat") & (F.col("age") < 3)).orderBy("k").collect()] == ["a", "f"]
    assert [r["k"] for r in d.where(F.col("age").between(2, 4)).orderBy("k").collect()] == ["a", "b", "f", "j"]
    assert [r["k"] for r in d.orderBy(F.desc_nulls_last("age"), "visits").collect()][:3] == ["i", "e", "g"]
    pivot = reshape.pivot_mean(d, ["animal"], "visits", [1, 2, 3], "age").orderBy("animal").collect()
    assert [tuple(r) for r in pivot] == [("cat", 2.5, None, 2.5), ("dog", 3.0, 6.0, None), ("snake", 4.5, 0.5, None)]
    counts = {r["animal"]: r["n"] for r in aggregates.value_counts(d, "animal").collect()}
    assert counts == {"cat": 4, "dog": 4, "snake": 2}
    more = reshape.remove_key(reshape.add_row(d, {"k": "k", "animal": "dog", "age": 5.5, "visits": 2, "priority": "no"}), "k", "a")
    assert more.count() == 10


def test_day_parts_at_the_edges(spark):
    hours = [4, 5, 6, 7, 11, 12, 13, 16, 17, 18, 19, 21, 22, 23, 0]
    d = spark.createDataFrame([(i, datetime(2024, 1, 6) + timedelta(hours=h)) for i, h in enumerate(hours)], "i int, ts timestamp")
    got = {p: ordered(d.select("i", dates.day_part(F.col("ts"), p).alias("x")), "i", "x") for p in dates.DAY_PARTS}
    assert [x[0] for x in got["client"]] == list("nmmmmddde" + "ee" + "ennn"[0:1] + "nnn")[:15]
    assert got["client_closed"][5] == "morning" and got["client_closed"][8] == "day" and got["client_closed"][12] == "evening"
    assert got["session"][2] == "night" and got["session"][5] == "morning" and got["session"][9] == "afternoon" and got["session"][10] == "evening"
    assert got["shop"][2] == "morning" and got["shop"][5] == "day" and got["shop"][9] == "rest"
    assert d.select(F.min(dates.weekday(F.col("ts")))).first()[0] == 5


def test_windows_are_inclusive_as_written(spark):
    d = spark.range(60).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("ts"))
    assert d.where(dates.day_window(F.col("ts"), "2024-02-10", 30)).count() == 31
    assert d.where(dates.half_open_window(F.col("ts"), "2024-02-10", 30)).count() == 30


def test_rounding_and_logs(spark):
    d = series(spark, [-2.5, -0.5, 0.5, 2.5])
    assert ordered(d.select("i", F.bround("v", 0).alias("x")), "i", "x") == [-2.0, 0.0, 0.0, 2.0]
    assert ordered(d.select("i", numbers.away_from_zero(F.col("v")).alias("x")), "i", "x") == [-3.0, -1.0, 1.0, 3.0]
    infinite = series(spark, [1.0, float("inf"), float("-inf"), float("nan"), None])
    assert ordered(infinite.select("i", numbers.finite(F.col("v")).alias("x")), "i", "x") == [1.0, None, None, None, None]
    assert ordered(infinite.select("i", numbers.guarded_log(numbers.finite(F.col("v"))).alias("x")), "i", "x") == [0.0, None, None, None, None]


def test_bins_are_closed_on_the_stated_side(spark):
    d = series(spark, [0.0, 1.0, 1.5, 9.0, 10.0])
    assert ordered(encode.equal_width_bin(d, "v", "b"), "i", "b") == [0, 0, 1, 8, 9]
    assert ordered(encode.equal_width_bin(d, "v", "b", right_closed=False), "i", "b") == [0, 1, 1, 9, 9]
    same = series(spark, [3.0] * 7 + [4.0, 5.0, 6.0])
    assert set(ordered(encode.quantile_bin(same, "v", "b"), "i", "b")) == {0, 1, 2, 3}


def test_ties_go_to_the_smaller_value(spark):
    d = spark.createDataFrame([("u", c) for c in "bbaacd"], "k string, v string")
    row = categories.category_profile(d, ["k"], "v").first()
    assert row["mode"] == "a" and row["mode_count"] == 2 and row["unique"] == 4
    top = categories.top_arrays(d, ["k"], "v", 3, "v", "n").first()
    assert top["v"] == ["a", "b", "c"] and top["n"] == [2, 2, 1]


def test_checked_pairs_refuse_mismatches(spark):
    a, b = spark.createDataFrame([(1, 0), (2, 1)], "id int, y int"), spark.createDataFrame([(1, 0.2)], "id int, p double")
    with pytest.raises(ValueError):
        joins.checked_pairs(a, b, "id")


def test_pivot_unique_refuses_double_cells(spark):
    d = spark.createDataFrame([("r", "a", 1), ("r", "a", 2)], "r string, c string, v int")
    with pytest.raises(Exception, match="more than one row"):
        reshape.pivot_unique(d, ["r"], "c", ["a", "b"], "v").collect()
