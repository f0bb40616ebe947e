"""Similarity and nearest neighbours (K), and the nearest-neighbour join J14."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import Book, rnd
from featherloom.operators import encode, knn
from featherloom.session import materialize

book = Book()

D_SQL = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))"
NN = """nn AS (SELECT a, b, sqrt(d2) AS distance, rk FROM (SELECT q.vec_id AS a, s.vec_id AS b, {d} AS d2,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY {d}, s.vec_id) AS rk FROM {src} q, {src} s {where}) WHERE rk <= {k})"""


def emb_nn(k, where="", src="embeddings"):
    return NN.format(d=D_SQL.format(a="q.embedding", b="s.embedding"), src=src, where=where, k=k)


NOT_SELF = "WHERE q.vec_id <> s.vec_id"


@book.add("j14_nearest_topk", f"WITH {emb_nn(5)} SELECT a AS vec_id, b AS neighbour, round(distance, 6) AS distance FROM nn")
def _(t):
    vectors = t.embeddings
    d = knn.pivot_nearest(vectors, vectors, "vec_id", "embedding", 5)
    return d.select("vec_id", "neighbour", rnd("distance").alias("distance"))


@book.add("k01_exact_nearest", f"WITH {emb_nn(10, NOT_SELF)} SELECT a AS vec_id, b AS neighbour, CAST(rk AS INT) AS rank, round(distance * distance, 6) AS squared FROM nn")
def _(t):
    vectors = t.embeddings
    d = knn.pivot_nearest(vectors, vectors, "vec_id", "embedding", 10, exclude="vec_id")
    return d.select("vec_id", "neighbour", "rank", rnd(F.col("distance") * F.col("distance")).alias("squared"))


@book.add("k02_distance_stats", f"""WITH {emb_nn(5)} SELECT a AS vec_id, round(avg(distance), 6) AS distance_mean, round(max(distance), 6) AS distance_max, round(min(distance), 6) AS distance_min,
  round(stddev_pop(distance), 6) AS distance_std, round(max(distance) - min(distance), 6) AS distance_range, round(1 / (avg(distance) + 1e-6), 6) AS local_density FROM nn GROUP BY 1""")
def _(t):
    d = knn.distance_stats(knn.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 5), "vec_id")
    return d.select("vec_id", *[rnd(c).alias(c) for c in d.columns[1:]])


# per-user feature rows, scaled for the search and reported raw
USERS = """u0 AS (SELECT user_id AS vec_id, count(*)::DOUBLE AS n, round(avg(value), 4) AS mean, max(value) AS top, count(*) FILTER (WHERE event_type = 'purchase')::DOUBLE AS bought,
  CAST(min(event_id) % 4 AS INT) AS grp, CASE WHEN max(value) > 130 THEN 1 ELSE 0 END AS target FROM events GROUP BY 1),
users AS (SELECT *, [(n - (SELECT min(n) FROM u0)) / ((SELECT max(n) - min(n) FROM u0)), (mean - (SELECT min(mean) FROM u0)) / ((SELECT max(mean) - min(mean) FROM u0)),
  (top - (SELECT min(top) FROM u0)) / ((SELECT max(top) - min(top) FROM u0))] AS embedding FROM u0)"""


def users(t):
    kind = F.col("event_type") == "purchase"
    u = t.events.groupBy(F.col("user_id").alias("vec_id")).agg(
        F.count("*").cast("double").alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.max("value").alias("top"), F.count_if(kind).cast("double").alias("bought"),
        (F.min("event_id") % 4).cast("int").alias("grp"))
    u = u.withColumns({"target": (F.col("top") > 130).cast("int"), "s_n": F.col("n"), "s_mean": F.col("mean"), "s_top": F.col("top")})
    u = encode.min_max_scale(u, ["s_n", "s_mean", "s_top"])
    return u.withColumn("embedding", F.array("s_n", "s_mean", "s_top")).drop("s_n", "s_mean", "s_top")


def user_nn(t, k=5, **opts):
    u = users(t)
    return u, knn.nearest(u, u, "vec_id", "embedding", k, **opts)


UNN = f"WITH {USERS}, {emb_nn(5, src='users')} "
UNN_NOT_SELF = f"WITH {USERS}, {emb_nn(5, NOT_SELF, src='users')} "


@book.add("k03_value_stats", UNN + """SELECT a AS vec_id, round(avg(s.bought), 6) AS bought_mean, max(s.bought) AS bought_max, min(s.bought) AS bought_min, round(stddev_pop(s.bought), 6) AS bought_std,
  median(s.bought) AS bought_median, sum(s.bought) AS bought_sum, max(s.bought) - min(s.bought) AS bought_range FROM nn JOIN users s ON s.vec_id = b GROUP BY 1""")
def _(t):
    u, nn = user_nn(t)
    d = knn.value_stats(nn, u, "vec_id", ["bought"]).drop("bought_weighted_mean")
    return d.withColumns({c: rnd(c) for c in d.columns if c != "vec_id"})


@book.add("k04_weighted_mean", UNN + "SELECT a AS vec_id, round(sum(s.bought / (distance + 1e-6)) / sum(1 / (distance + 1e-6)), 4) AS weighted FROM nn JOIN users s ON s.vec_id = b GROUP BY 1")
def _(t):
    u, nn = user_nn(t)
    return knn.value_stats(nn, u, "vec_id", ["bought"]).select("vec_id", rnd("bought_weighted_mean", 4).alias("weighted"))


@book.add("k05_ratios_and_differences", UNN + """SELECT q.vec_id, round(any_value(q.n) / (avg(s.n) + 1e-6), 6) AS consistency, round(any_value(q.mean) - avg(s.mean), 6) + 0 AS decay,
  round(any_value(q.bought) / (avg(s.bought) + 1e-6), 6) AS exploration FROM nn JOIN users s ON s.vec_id = b JOIN users q ON q.vec_id = a GROUP BY 1""")
def _(t):
    u, nn = user_nn(t)
    d = u.join(knn.value_stats(nn, u, "vec_id", ["n", "mean", "bought"]), "vec_id")
    return d.select("vec_id", rnd(knn.consistency(F.col("n"), F.col("n_mean"))).alias("consistency"), rnd(F.col("mean") - F.col("mean_mean")).alias("decay"),
                    rnd(knn.consistency(F.col("bought"), F.col("bought_mean"))).alias("exploration"))


@book.add("k06_cluster_outlier", UNN + """, c AS (SELECT a, s.grp AS v, count(*) AS n FROM nn JOIN users s ON s.vec_id = b GROUP BY 1, 2), m AS (SELECT a, arg_min(v, (-n, v)) AS mode FROM c GROUP BY 1)
SELECT vec_id, mode AS grp_mode, CASE WHEN grp <> mode THEN 1 ELSE 0 END AS outlier FROM users JOIN m ON a = vec_id""")
def _(t):
    u, nn = user_nn(t)
    d = u.join(knn.neighbour_mode(nn, u, "vec_id", "grp"), "vec_id")
    return d.select("vec_id", "grp_mode", (F.col("grp") != F.col("grp_mode")).cast("int").alias("outlier"))


@book.add("k07_relative_flags", UNN + """SELECT q.vec_id, CASE WHEN any_value(q.top) > avg(s.top) AND any_value(q.n) > avg(s.n) THEN 1 ELSE 0 END AS high_value,
  CASE WHEN any_value(q.mean) > avg(s.mean) AND any_value(q.n) < avg(s.n) THEN 1 ELSE 0 END AS stable_inactive FROM nn JOIN users s ON s.vec_id = b JOIN users q ON q.vec_id = a GROUP BY 1""")
def _(t):
    u, nn = user_nn(t)
    d = u.join(knn.value_stats(nn, u, "vec_id", ["n", "mean", "top"]), "vec_id")
    high = (F.col("top") > F.col("top_mean")) & (F.col("n") > F.col("n_mean"))
    idle = (F.col("mean") > F.col("mean_mean")) & (F.col("n") < F.col("n_mean"))
    return d.select("vec_id", high.cast("int").alias("high_value"), idle.cast("int").alias("stable_inactive"))


@book.add("k08_target_stats", UNN_NOT_SELF + """SELECT a AS vec_id, round(avg(s.target), 6) AS target_mean, round(stddev_pop(s.target), 6) AS target_std, median(s.target) AS target_median,
  CAST(sum(s.target) AS BIGINT) AS target_sum FROM nn JOIN users s ON s.vec_id = b GROUP BY 1""")
def _(t):
    u, nn = user_nn(t, exclude="vec_id")
    return knn.value_stats(nn, u, "vec_id", ["target"]).select(
        "vec_id", rnd("target_mean").alias("target_mean"), rnd("target_std").alias("target_std"), "target_median", "target_sum")


@book.add("k09_search_scaled_report_raw", UNN + "SELECT a AS vec_id, round(avg(s.top), 6) AS top_mean, round(avg(distance), 6) AS scaled_distance FROM nn JOIN users s ON s.vec_id = b GROUP BY 1")
def _(t):
    u, nn = user_nn(t)
    nn = materialize(nn, "neighbours")
    raw = knn.value_stats(nn, u, "vec_id", ["top"]).select("vec_id", rnd("top_mean").alias("top_mean"))
    return raw.join(knn.distance_stats(nn, "vec_id").select("vec_id", rnd("distance_mean").alias("scaled_distance")), "vec_id")


@book.add("k10_self_excluded", f"WITH {emb_nn(3, NOT_SELF)} SELECT a AS vec_id, b AS neighbour, CAST(rk AS INT) AS rank FROM nn")
def _(t):
    vectors = t.embeddings
    return knn.pivot_nearest(vectors, vectors, "vec_id", "embedding", 3, exclude="vec_id").drop("distance")


@book.add("k11_cumulative_stats", f"WITH {emb_nn(4, NOT_SELF)} SELECT a AS vec_id, " + ", ".join(
    f"round({f}(distance) FILTER (WHERE rk <= {i}), 6) AS {n}_{i}" for i in range(1, 5) for f, n in (("avg", "mean"), ("min", "min"), ("max", "max"), ("stddev_pop", "std")))
    + ", round(min(distance), 6) AS nearest, round(avg(distance), 6) AS mean_all FROM nn GROUP BY 1")
def _(t):
    nn = knn.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 4, exclude="vec_id")
    d = knn.cumulative_distance_stats(nn, "vec_id", 4)
    return d.select("vec_id", *[rnd(c).alias(c) for c in d.columns[1:]])


ABS = "probs AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS embedding FROM embeddings)"


PROBABILITY_STATS = f"""WITH {ABS}, {emb_nn(5, NOT_SELF, src='probs')}, h AS (SELECT vec_id, embedding, list_sum(embedding) AS total FROM probs),
u AS (SELECT vec_id, embedding, -list_sum(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN x / total * ln(x / total) ELSE 0 END)) AS e FROM h),
l AS (SELECT a, unnest(embedding) AS p, e FROM nn JOIN u ON vec_id = b)
SELECT a AS vec_id, round(avg(p), 6) AS p_mean, round(stddev_pop(p), 6) AS p_std, round(min(p), 6) AS p_min, round(max(p), 6) AS p_max, round(median(p), 6) AS p_median, round(avg(e), 6) AS p_entropy FROM l GROUP BY 1"""


@book.add("k12_probability_stats", PROBABILITY_STATS)
@book.add("k12_probability_stats_all", PROBABILITY_STATS)
def _(t):
    dims = t.embeddings.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 1
    names = [f"m{i + 1}" for i in range(dims)]
    p = t.embeddings.select("vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("embedding"))
    p = p.select("vec_id", "embedding", *[F.get("embedding", F.lit(i)).alias(m) for i, m in enumerate(names)])
    d = knn.probability_stats(knn.nearest(p, p, "vec_id", "embedding", 5, exclude="vec_id"), p, "vec_id", names)
    return d.select("vec_id", *[rnd(c).alias(c) for c in d.columns[1:]])


@book.add("k13_sentinel_aware", f"WITH {emb_nn(6, NOT_SELF)}, s AS (SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN -1 ELSE label END AS x FROM embeddings), " + """
c AS (SELECT a, x, count(*) AS n FROM nn JOIN s ON vec_id = b WHERE x <> -1 GROUP BY 1, 2), m AS (SELECT a, arg_min(x, (-n, x)) AS x_mode FROM c GROUP BY 1)
SELECT nn.a AS vec_id, coalesce(round(avg(nullif(x, -1)), 6), -1) AS x_mean, max(nullif(x, -1)) AS x_max, min(nullif(x, -1)) AS x_min, round(stddev_samp(nullif(x, -1)), 6) AS x_std,
  count(*) FILTER (WHERE x = -1) AS x_invalid, any_value(x_mode) AS x_mode FROM nn JOIN s ON vec_id = b LEFT JOIN m ON m.a = nn.a GROUP BY 1""")
def _(t):
    base = t.embeddings.withColumn("x", F.when(F.col("vec_id") % 4 == 0, -1).otherwise(F.col("label")))
    nn = materialize(knn.nearest(base, base, "vec_id", "embedding", 6, exclude="vec_id"), "neighbours")
    d = knn.sentinel_stats(nn, base, "vec_id", "x").join(knn.neighbour_mode(nn, base, "vec_id", "x", sentinel=-1), "vec_id", "left")
    return d.withColumns({"x_mean": rnd("x_mean"), "x_std": rnd("x_std")})


VOTE = f"""WITH {emb_nn(7, NOT_SELF)}, v AS (SELECT a, label, count(*) AS n, sum(1 / (distance + 1e-10)) AS w FROM nn JOIN embeddings ON vec_id = b GROUP BY 1, 2)
SELECT a AS vec_id, arg_min(label, (-n, label)) AS uniform, arg_min(label, (-w, label)) AS weighted FROM v GROUP BY 1"""


@book.add("k14_vote", VOTE)
def _(t):
    nn = materialize(knn.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 7, exclude="vec_id"), "neighbours")
    a = knn.vote(nn, t.embeddings, "vec_id", "label", out="uniform")
    return a.join(knn.vote(nn, t.embeddings, "vec_id", "label", by_distance=True, out="weighted"), "vec_id")


@book.add("k15_lsh_nearest")
def _(t):
    return knn.lsh_nearest(t.embeddings, "vec_id", "embedding", 5, bucket_length=0.5, tables=4)


@book.add("k16_cell_nearest")
def _(t):
    return knn.cell_nearest(t.embeddings, "vec_id", "embedding", 5, cells=8, probes=3)


def recall_of(t, approx):
    exact = knn.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 5, exclude="vec_id")
    return knn.recall_at(exact, approx, "vec_id", 5)


@book.add("k15_lsh_recall")
def _(t):
    return recall_of(t, book.queries["k15_lsh_nearest"](t))


@book.add("k16_cell_recall")
def _(t):
    return recall_of(t, book.queries["k16_cell_nearest"](t))


# with enough tables of half spaces, or with every cell probed, the approximate searches must equal the exact one
EXACT5 = f"WITH {emb_nn(5, NOT_SELF)} SELECT a AS vec_id, b AS neighbour, CAST(rk AS INT) AS rank, round(distance, 6) AS distance FROM nn"


@book.add("k15_lsh_many_tables", EXACT5)
def _(t):
    return knn.lsh_nearest(t.embeddings, "vec_id", "embedding", 5, bucket_length=1e6, tables=24).withColumn("distance", rnd("distance"))


@book.add("k16_all_cells", EXACT5)
def _(t):
    return knn.cell_nearest(t.embeddings, "vec_id", "embedding", 5, cells=4, probes=4).withColumn("distance", rnd("distance"))


@book.add("k17_recall", f"""WITH {emb_nn(5, NOT_SELF)}, coarse AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 10)) AS embedding FROM embeddings), nn_exact AS (SELECT * FROM nn),
{emb_nn(5, NOT_SELF, src='coarse').replace('nn AS', 'nn_coarse AS', 1)}
SELECT e.a AS vec_id, count(h.b) AS hits, 5 - count(h.b) AS misses, count(h.b) / 5.0::DOUBLE AS recall FROM nn_exact e LEFT JOIN nn_coarse h ON h.a = e.a AND h.b = e.b GROUP BY 1""")
def _(t):
    # the approximation here is a search on vectors rounded down to tenths
    coarse = t.embeddings.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 10)).alias("embedding"))
    exact = knn.nearest(t.embeddings, t.embeddings, "vec_id", "embedding", 5, exclude="vec_id")
    return knn.recall_at(exact, knn.nearest(coarse, coarse, "vec_id", "embedding", 5, exclude="vec_id"), "vec_id", 5)


@book.add("k18_cosine_nearest", f"""WITH n AS (SELECT vec_id, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE ** 2))) AS len, embedding FROM embeddings),
unit AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / len) AS embedding FROM n), {emb_nn(5, NOT_SELF, src='unit')}
SELECT a AS vec_id, b AS neighbour, round(1 - distance * distance / 2, 6) AS cosine FROM nn""")
def _(t):
    u = knn.normalized(t.embeddings.select("vec_id", "embedding"), "embedding")
    d = knn.pivot_nearest(u, u, "vec_id", "embedding", 5, exclude="vec_id")
    return d.select("vec_id", "neighbour", rnd(1 - F.col("distance") * F.col("distance") / 2).alias("cosine"))


@book.add("k19_composite_label", UNN_NOT_SELF.replace("q.vec_id <> s.vec_id", "q.vec_id % 5 <> s.vec_id % 5").replace("rk <= 5", "rk <= 7") + """,
v AS (SELECT a, s.target || '_' || s.grp AS label, count(*) AS n FROM nn JOIN users s ON s.vec_id = b GROUP BY 1, 2), m AS (SELECT a, arg_min(label, (-n, label)) AS vote FROM v GROUP BY 1)
SELECT a AS vec_id, vote, CAST(split_part(vote, '_', 1) AS INT) AS target_vote, CAST(split_part(vote, '_', 2) AS INT) AS grp_vote FROM m""")
def _(t):
    from featherloom.plans.votes import composite_label_vote

    u = users(t).withColumn("fold", F.col("vec_id") % 5)
    return composite_label_vote(u, "vec_id", "embedding", ["target", "grp"], "fold", 7)
