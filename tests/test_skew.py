"""Hot keys, ties, nulls and changed partitioning against plain window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from featherloom.operators import encode, hooks, knn, metrics, ordered, splits, windows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, another key of nulls, tied order values."""
    n = 6000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40)
    return spark.range(n).select("id", key.alias("k"), (F.col("id") * 7919 % 500).alias("t"),
                                 F.when(F.col("id") % 5 != 0, (F.col("id") * 31 % 101).cast("double")).alias("v")).repartition(6).cache()


def by(*order):
    return Window.partitionBy("k").orderBy(*order)


def same(a, b, cols):
    x = {r["id"]: [r[c] for c in cols] for r in a.collect()}
    y = {r["id"]: [r[c] for c in cols] for r in b.collect()}
    assert x.keys() == y.keys()
    for i in x:
        assert x[i] == pytest.approx(y[i]), i


@pytest.mark.parametrize("order, sort", [(["t", "id"], lambda: [F.asc("t"), F.asc("id")]), (["-t", "id"], lambda: [F.desc("t"), F.asc("id")])])
@pytest.mark.parametrize("chunks", [1 << 20, 50, 3])
def test_running(skewed, order, sort, chunks):
    got = ordered.running(skewed, ["k"], order, {"n": ("count", F.lit(1)), "s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, totals=True, chunk_rows=chunks)
    w = by(*sort()).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"n": F.count("*").over(w), "s": F.sum("v").over(w), "m": F.max("v").over(w), "n_total": F.count("*").over(Window.partitionBy("k"))})
    same(got, want, ["n", "s", "m", "n_total"])


def test_running_exclusive(skewed):
    got = ordered.running(skewed, ["k"], ["t", "id"], {"n": ("count", F.lit(1)), "m": ("max", F.col("v"))}, exclusive=True, chunk_rows=40)
    w = by("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    same(got, skewed.withColumns({"n": F.count("*").over(w), "m": F.max("v").over(w)}), ["n", "m"])


@pytest.mark.parametrize("chunks", [1 << 20, 7])
def test_previous(skewed, chunks):
    got = ordered.previous(skewed, ["k"], ["t", "id"], {"p": F.col("v")}, chunk_rows=chunks)
    same(got, skewed.withColumn("p", F.lag("v").over(by("t", "id"))), ["p"])


def test_previous_descending(skewed):
    got = ordered.previous(skewed, ["k"], ["-t", "-id"], {"p": F.col("v")}, chunk_rows=9)
    same(got, skewed.withColumn("p", F.lead("v").over(by("t", "id"))), ["p"])


@pytest.mark.parametrize("rows", [2, 7])
def test_rolling_over_block_edges(skewed, rows):
    got = ordered.rolling(skewed, ["k"], ["t", "id"], rows, {"m": F.avg("v"), "c": F.count("v")}, block_rows=30, chunk_rows=70)
    w = by("t", "id").rowsBetween(-(rows - 1), 0)
    same(got, skewed.withColumns({"m": F.avg("v").over(w), "c": F.count("v").over(w)}), ["m", "c"])


def test_known_around(skewed):
    got = ordered.known_around(skewed, ["k"], ["t", "id"], {"v": F.col("v")}, F.col("v").isNotNull(), chunk_rows=11)
    up, down = by("t", "id").rowsBetween(Window.unboundedPreceding, 0), by(F.desc("t"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"prev_v": F.last("v", True).over(up), "next_v": F.last("v", True).over(down)})
    same(got, want, ["prev_v", "next_v"])


def test_global_positions_by_text(spark, skewed):
    d = skewed.withColumn("word", F.concat(F.lit("same-prefix-"), F.lpad((F.col("id") % 7).cast("string"), 3, "0")))
    got = ordered.positions(d, [], ["word", "-t", "id"], chunk_rows=100)
    want = d.withColumn("pos", F.row_number().over(Window.orderBy("word", F.desc("t"), "id")))
    same(got, want, ["pos"])


def test_one_value_on_many_rows_is_cut(spark, skewed):
    """40 % of the rows on one time: no range far above the mean, no chunk above its bound."""
    d = skewed.withColumn("t", F.when(F.col("id") % 5 < 2, 7).otherwise(F.col("t")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        parts = [r["count"] for r in ordered.ranged(d, [], ["t"]).groupBy("__part").count().collect()]
        got = ordered.positions(d, [], ["t", "id"], chunk_rows=64)
        same(got, d.withColumn("pos", F.row_number().over(Window.orderBy("t", "id"))), ["pos"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(parts) == 6000 and max(parts) <= 2 * 6000 / 20


@pytest.mark.parametrize("partitions", ["2", "200"])
def test_many_partitions_with_generated_code(spark, skewed, partitions):
    names = {"spark.sql.shuffle.partitions": partitions, "spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        test_running(skewed, ["t", "id"], lambda: [F.asc("t"), F.asc("id")], 1 << 20)
        test_known_around(skewed)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_cumulative_product_signs(spark):
    d = spark.createDataFrame([(1, None), (2, 2.0), (3, -3.0), (4, None), (5, -0.5), (6, 0.0), (7, 5.0)], "id int, f double")
    got = {r["id"]: r["p"] for r in windows.cumulative_product(d, [], ["id"], F.col("f"), "p").collect()}
    assert got == {1: None, 2: pytest.approx(2), 3: pytest.approx(-6), 4: pytest.approx(-6), 5: pytest.approx(3), 6: 0, 7: 0}


def test_quantiles(skewed):
    got = ordered.group_quantiles(skewed, ["k"], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}, chunk_rows=70)
    want = skewed.groupBy("k").agg(*[F.percentile("v", p).alias(n) for n, p in (("a", 0.0), ("b", 0.25), ("c", 0.5), ("d", 0.99), ("e", 1.0))])
    x, y = ({r["k"]: list(r)[1:] for r in d.collect()} for d in (got, want))
    assert x.keys() == y.keys() and all(x[k] == pytest.approx(y[k]) for k in x)


def test_auc_counts_pairs(spark):
    data = [(i, (i * 7) % 5 % 2, ((i * 13) % 9) / 9) for i in range(60)]
    d = spark.createDataFrame(data, "id int, y int, p double")
    pos, neg = [p for _, y, p in data if y], [p for _, y, p in data if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert metrics.auc(d, "y", "p").first()[0] == pytest.approx(pairs)


def vectors(spark, n=300, copies=100):
    """Vectors of which a third are the same one."""
    x = F.array(*[F.when(F.col("id") < copies, 0.5).otherwise((F.xxhash64("id", F.lit(i)) % 1000) / 1000) for i in range(4)])
    return spark.range(n).select("id", x.alias("vec"), (F.col("id") % 3).alias("fold"))


def brute(rows, k, skip):
    out = {}
    for i, v, f in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w, g in rows if not skip(i, j, f, g))
        out[i] = [j for _, j in near[:k]]
    return out


@pytest.mark.parametrize("block_rows", [17, 8192])
@pytest.mark.parametrize("exclude", [None, "id", "fold"])
def test_nearest_equals_brute_force(spark, block_rows, exclude):
    d = vectors(spark)
    rows = [tuple(r) for r in d.collect()]
    skip = {None: lambda i, j, f, g: False, "id": lambda i, j, f, g: i == j, "fold": lambda i, j, f, g: f == g}[exclude]
    want = brute(rows, 4, skip)
    got: dict = {}
    for r in knn.nearest(d, d, "id", "vec", 4, exclude=exclude, block_rows=block_rows).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == want


def test_cell_search_with_all_probes_is_exact(spark):
    d = vectors(spark, copies=0)
    exact = knn.nearest(d, d, "id", "vec", 4, exclude="id")
    assert knn.recall_at(exact, knn.cell_nearest(d, "id", "vec", 4, cells=5, probes=5), "id", 4).agg(F.min("recall")).first()[0] == 1.0
    some = knn.recall_at(exact, knn.cell_nearest(d, "id", "vec", 4, cells=5, probes=2), "id", 4).agg(F.avg("recall")).first()[0]
    assert 0.5 < some <= 1.0


def test_approximate_search_reaches_its_recall(spark):
    """Vectors without clusters, where few cells lose many neighbours, and rows that are alone in their buckets."""
    rng = random.Random(9)
    d = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(24)]) for i in range(1200)], "id long, vec array<double>")
    exact = knn.nearest(d, d, "id", "vec", 5, exclude="id").cache()
    found = knn.cell_nearest(d, "id", "vec", 5, cells=8, probes=1)
    assert knn.recall_at(exact, found, "id", 5).agg(F.avg("recall")).first()[0] >= 0.9
    lonely = knn.lsh_nearest(d, "id", "vec", 5, bucket_length=1e-6, tables=1)
    assert knn.recall_at(exact, lonely, "id", 5).agg(F.min("recall")).first()[0] == 1.0


def test_random_choices_do_not_depend_on_partitions(skewed):
    for fn in (lambda d: splits.sample_rows(d, "id", 0.3, 5), lambda d: splits.sample_n(d, "id", 50, 5),
               lambda d: splits.exact_split(d, "id", 0.3, 5).where("is_train = 1"), lambda d: splits.capped_per_class(d, "id", "k", {0: 5, 1: 2}, 5)):
        a = sorted(r["id"] for r in fn(skewed).collect())
        assert a == sorted(r["id"] for r in fn(skewed.repartition(13, "v")).collect()) and a


def test_split_sizes(skewed):
    n = skewed.count()
    assert splits.exact_split(skewed, "id", 0.25, 1).where("is_train = 1").count() == int(n * 0.75)
    folds = splits.stratified_folds(skewed.where("k = 0"), "id", "k", 5).groupBy("fold").count().collect()
    assert max(r["count"] for r in folds) - min(r["count"] for r in folds) <= 1
    drawn = splits.sample_rows(skewed, "id", 1.0, 3, replacement=True).count()
    assert abs(drawn - n) < 0.1 * n


def test_target_encoding_by_definition(spark):
    data = [(i, "abc"[i % 3] if i % 7 else "z", i % 4, float((i * 37) % 11)) for i in range(80)]
    d = spark.createDataFrame(data, "id int, c string, f int, y double")
    got = {r["id"]: r["e"] for r in encode.target_encode_out_of_fold(d, "c", "y", "f", "e").collect()}

    def var(x):
        m = sum(x) / len(x)
        return sum((a - m) ** 2 for a in x) / len(x)

    for i, c, f, _ in data:
        rest = [y for _, _, g, y in data if g != f]
        mine = [y for _, cc, g, y in data if g != f and cc == c]
        overall = sum(rest) / len(rest)
        weight = var(rest) * len(mine) / (var(rest) * len(mine) + var(mine))
        assert got[i] == pytest.approx(weight * sum(mine) / len(mine) + (1 - weight) * overall)


def test_threshold_search_against_brute_force(spark):
    cols, weights = ["c0", "c1", "c2"], [1.0, 0.5, 0.25]
    data = [(i % 3, (i * 7 % 10) / 20, (i * 3 % 10) / 15, (i * 9 % 10) / 10) for i in range(40)]
    d = spark.createDataFrame(data, "y int, c0 double, c1 double, c2 double")
    grid, best = [0.05, 0.2, 0.4], [0.1, 0.1, 0.1]

    def loss(t):
        total = 0
        for y, *p in data:
            ok = [i for i in range(3) if p[i] >= t[i]]
            pick = max(ok, key=lambda i: (p[i] * weights[i], -i)) if ok else max(range(3), key=lambda i: (p[i], -i))
            total += weights[y] * abs(y - pick)
        return total / len(data)

    for i in range(3):
        best[i] = min(grid, key=lambda g: (round(loss(best[:i] + [g] + best[i + 1:]), 12), g))
    got = metrics.threshold_search(d, "y", cols, grid, [0.1, 0.1, 0.1], weights, weights)
    assert loss(got) == pytest.approx(loss(best))


def test_fold_groups_on_a_hot_key(skewed):
    d = skewed.where("k is not null and v is not null").select("k", "v")
    got = hooks.fold_groups(d, ["k"], "n double, s double", lambda p: (float(len(p)), float(p["v"].sum())), lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: (s[1] / s[0],), "mean double")
    want = {r["k"]: r["m"] for r in d.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    assert {r["k"]: r["mean"] for r in got.collect()} == pytest.approx(want)


def test_interpolation_keeps_head_and_tail(spark):
    d = spark.createDataFrame([(i, v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])], "i int, v double")
    assert [r["x"] for r in windows.interpolate(d, [], ["i"], "v", "x").orderBy("i").collect()] == [None, 2.0, 4.0, 6.0, 8.0, 8.0]


@pytest.mark.parametrize("grid", [[0.1, 0.2, 0.3, 0.4], [0.5], [0.1, 0.15, 0.9]])
@pytest.mark.parametrize("at_most", [False, True])
def test_counts_at_every_threshold(spark, grid, at_most):
    data = [(i % 2, x) for i, x in enumerate([-5.0, 0.0, 0.1, 0.15, 0.2, 0.25, 0.3, 0.30000001, 0.4, 0.5, 0.9, 7.0])]
    d = spark.createDataFrame(data, "y int, x double")
    for r in metrics.counts_at(d, "y", "x", grid, at_most).collect():
        hit = [y for y, x in data if (x <= r["threshold"] if at_most else x >= r["threshold"])]
        assert (r["tp"], r["fp"]) == (sum(hit), len(hit) - sum(hit))
