"""Spark ML jobs (M)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from featherloom.catalog.base import SCORED, Book, rnd, uniform_sql
from featherloom.catalog.neighbours import emb_nn
from featherloom.operators import isotonic, metrics, spectral, splits, textspace
from featherloom.operators import models as ml
from featherloom.session import materialize

book = Book()
TREES = 100
COLS = ["chars", "words", "digits", "lines", "mean_word"]


def texts(t):
    """Labelled documents with simple text measures."""
    x = F.col("text")
    words = F.size(F.split(x, " ", -1)).cast("double")
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("y"), F.length(x).cast("double").alias("chars"), words.alias("words"),
        F.regexp_count(x, F.lit(r"\d")).cast("double").alias("digits"), F.regexp_count(x, F.lit("\n")).cast("double").alias("lines"),
        (F.length(x) / words).alias("mean_word"))


def _auc(d, score, label="y"):
    return metrics.auc(d, label, score).withColumn("auc", rnd("auc"))


@book.add("m01_median_logistic")
def _(t):
    d = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"), F.dayofmonth("o_orderdate").cast("double").alias("day"),
                        (F.col("o_orderstatus") == "F").cast("double").alias("y"))
    model = ml.logistic_with_medians(["price", "day"], "y").fit(d)
    return model.transform(d).select("o_orderkey", rnd(ml.positive()).alias("prob"))


@book.add("m02_balanced_logistic_feature")
def _(t):
    d = texts(t)
    scored = ml.scaled_logistic(d, COLS, "y").transform(d).withColumn("logit_feature", ml.positive())
    return _auc(scored, "logit_feature")


@book.add("m03_char_ngram_words")
def _(t):
    words = t.documents.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("length(word) > 1")
    words = words.groupBy("word").agg(F.min_by("lang", F.col("lang")).alias("lang"))
    # written out, or every stage of the fit would read the documents again
    words = materialize(words, "words").withColumn("grams", ml.char_ngrams(F.col("word"), 2, 4))
    out = ml.word_classifier("lang").fit(words).transform(words)
    return out.groupBy("lang").agg(F.count("*").alias("words"), F.avg((F.col("label_index") == F.col("prediction")).cast("int")).alias("recall"))


# fixed values: words left out of the text vectors
STOP = "a an and are as at be but by for from has have he her his i if in into is it its no not of on or our she so such that the their them then there these they this to was we were which who will with you your".split()


@book.add("m04_text_mixture_clusters")
def _(t):
    return ml.text_clusters(t.documents, "doc_id", "text", 4, STOP)


@book.add("m04_text_components")
def _(t):
    _, found = textspace.text_components(t.documents, "doc_id", "text", 2, STOP)
    rows = [(i, float(x), len(found.mean)) for i, x in enumerate(found.singular)]
    return t.spark.createDataFrame(rows, "component int, singular_value double, terms int").withColumn("singular_value", rnd("singular_value"))


@book.add("m04_vocabulary", f"""
WITH w AS (SELECT list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN ({", ".join(f"'{x}'" for x in STOP)})) AS w FROM documents),
g AS (SELECT list_concat(w, list_transform(list_zip(w[1:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS g FROM w),
n AS (SELECT term, count(*) AS n FROM (SELECT unnest(g) AS term FROM g) GROUP BY 1),
d AS (SELECT term, count(*) AS docs FROM (SELECT unnest(list_distinct(g)) AS term FROM g) GROUP BY 1)
SELECT term, n, docs, round(ln((1 + (SELECT count(*) FROM documents)) / (1 + docs)) + 1, 6) AS idf FROM n JOIN d USING (term) ORDER BY n DESC, term LIMIT 10000""")
def _(t):
    rows = t.documents.agg(F.count("*")).scalar()
    return textspace.vocabulary(t.documents, "text", STOP).withColumn("idf", rnd(F.log((1 + rows) / (1 + F.col("docs"))) + 1))


@book.add("m05_graph_clusters")
def _(t):
    return ml.graph_clusters(t.embeddings, "vec_id", "embedding", 4)


@book.add("m05_graph_eigenvalues")
def _(t):
    _, values = spectral.leading_eigenvectors(ml.neighbour_graph(t.embeddings, "vec_id", "embedding"), 4)
    return t.spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "component int, eigenvalue double").withColumn("eigenvalue", rnd("eigenvalue"))


@book.add("m06_principal_components")
def _(t):
    d = ml.principal_components(texts(t), COLS, 2)
    return d.select("doc_id", rnd("pca_0").alias("pca_0"), rnd("pca_1").alias("pca_1"))


@book.add("m07_error_clusters")
def _(t):
    d = texts(t)
    errors = ml.scaled_logistic(d, COLS, "y").transform(d).where(F.col("prediction") != F.col("y"))
    return ml.cluster_profile(errors.select(*COLS), COLS, 3)


@book.add("m08_base_models")
def _(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), F.col("p_retailprice").alias("price"))
    d = materialize(d, "lines")
    cols, rows = ["quantity", "discount", "tax", "price"], None
    cells = materialize(ml.tree_cells(d, cols, "y"), "cells")
    for name, model in ml.regressors("y", trees=TREES).items():
        if name in ("forest", "boosted"):  # hundreds of passes: over cells, which hold every row
            part = ml.fit_on(cols, model.copy({model.weightCol: "n", model.maxBins: 2 * ml.BINS}), cells).transform(cells).agg(
                F.lit(name).alias("model"), ml.rmse_of_cells(cells, F.col("prediction")).alias("rmse"))
        else:
            part = ml.fit_on(cols, model, d).transform(d).agg(F.lit(name).alias("model"), metrics.rmse(F.col("y"), F.col("prediction")).alias("rmse"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@book.add("m08_base_classifiers")
def _(t):
    d, rows = materialize(texts(t), "texts"), None
    for name, model in ml.classifiers("y", trees=TREES).items():
        part = ml.fit_on(COLS, model, d).transform(d).agg(F.lit(name).alias("model"), F.avg((F.col("prediction") == F.col("y")).cast("int")).alias("accuracy"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@book.add("m09_feature_subset_bagging")
def _(t):
    d = materialize(texts(t), "texts")
    return ml.feature_subset_bagging(d, d, COLS, "y", models=14).select("doc_id", rnd("score").alias("score"))


@book.add("m10_bootstrap_bagging")
def _(t):
    d = materialize(texts(t), "texts")
    return ml.bootstrap_bagging(d, d, "doc_id", COLS, "y", models=5).select("doc_id", rnd("score").alias("score"))


def _stacked(t):
    d = materialize(splits.random_folds(texts(t), "doc_id", 4, 5), "texts")
    models = {"logistic": LogisticRegression(featuresCol="features", labelCol="y", maxIter=20), "forest": ml.classifiers("y", trees=TREES)["forest"]}
    return ml.stack(d, COLS, models, "y", "fold", 4)


@book.add("m11_out_of_fold_stacking")
def _(t):
    return _stacked(t).select("doc_id", "fold", *[rnd(c).alias(c) for c in ("oof_logistic", "oof_forest", "meta")])


@book.add("m12_isotonic_calibration")
def _(t):
    d = texts(t)
    d = ml.scaled_logistic(d, COLS, "y").transform(d).select("doc_id", "y", ml.positive().alias("score"))
    return ml.calibrate(d, "score", "y").select("doc_id", rnd("calibrated").alias("calibrated"))


def _split_sql(kind):
    imp = {
        "gini": lambda n, a: f"(1 - (({a}1 / {n}) ** 2 + ({a}0 / {n}) ** 2))",
        "entropy": lambda n, a: f"(-(({a}1 / {n}) * ln({a}1 / {n} + 1e-6) + ({a}0 / {n}) * ln({a}0 / {n} + 1e-6)))",
    }[kind]
    return f"""WITH {SCORED}, l AS (SELECT y, 'x' AS feature, x AS v FROM scored UNION ALL SELECT y, 'p1', p1 FROM scored UNION ALL SELECT y, 'p2', p2 FROM scored),
c AS (SELECT feature, v, sum(y)::DOUBLE AS c1, sum(1 - y)::DOUBLE AS c0 FROM l GROUP BY 1, 2),
r AS (SELECT feature, v, lag(v) OVER w AS pv, sum(c1) OVER w - c1 AS l1, sum(c0) OVER w - c0 AS l0, sum(c1) OVER (PARTITION BY feature) AS t1, sum(c0) OVER (PARTITION BY feature) AS t0 FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)),
s AS (SELECT *, l1 + l0 AS nl, t1 + t0 AS nt, t1 - l1 AS r1, t0 - l0 AS r0, t1 + t0 - l1 - l0 AS nr FROM r WHERE pv IS NOT NULL),
g AS (SELECT feature, (pv + v) / 2 AS threshold, {imp('nt', 't')} - nl / nt * {imp('nl', 'l')} - nr / nt * {imp('nr', 'r')} AS gain FROM s)
SELECT feature, arg_min(threshold, (-round(gain, 12), threshold)) AS threshold, round(max(gain), 6) AS gain FROM g GROUP BY 1"""


@book.add("m13_best_split_gini", _split_sql("gini"))
def _(t):
    return ml.best_splits(t.scored, ["x", "p1", "p2"], "y", "gini", [1, 0]).withColumn("gain", rnd("gain"))


@book.add("m13_best_split_entropy", _split_sql("entropy"))
def _(t):
    return ml.best_splits(t.scored, ["x", "p1", "p2"], "y", "entropy", [1, 0]).withColumn("gain", rnd("gain"))


@book.add("m13_best_split_variance", """
WITH c AS (SELECT l_quantity AS v, count(*)::DOUBLE AS n, sum(l_extendedprice / 1000) AS s, sum((l_extendedprice / 1000) ** 2) AS ss FROM lineitem GROUP BY 1),
r AS (SELECT v, lag(v) OVER w AS pv, sum(n) OVER w - n AS nl, sum(s) OVER w - s AS sl, sum(ss) OVER w - ss AS ql, sum(n) OVER () AS nt, sum(s) OVER () AS st, sum(ss) OVER () AS qt FROM c WINDOW w AS (ORDER BY v)),
g AS (SELECT (pv + v) / 2 AS threshold, (qt / nt - (st / nt) ** 2) - nl / nt * (ql / nl - (sl / nl) ** 2) - (nt - nl) / nt * ((qt - ql) / (nt - nl) - ((st - sl) / (nt - nl)) ** 2) AS gain FROM r WHERE pv IS NOT NULL)
SELECT 'l_quantity' AS feature, threshold, round(gain, 4) AS gain FROM g ORDER BY gain DESC, threshold LIMIT 1""")
def _(t):
    d = t.lineitem.select("l_quantity", (F.col("l_extendedprice") / 1000).alias("y"))
    return ml.best_splits(d, ["l_quantity"], "y", "mse").withColumn("gain", rnd("gain", 4))


@book.add("m14_bagged_sample", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {uniform_sql('o_orderkey', 4)} < 0.6")
def _(t):
    return ml.bagged_sample(t.orders, "o_orderkey", ["o_custkey", "o_totalprice", "o_orderstatus"], 0.6, 0.7, 4)


@book.add("m15_segmented_model")
def _(t):
    d = texts(t)
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=20)
    return ml.segmented(d, F.col("chars") < 1500, COLS, "y", model, ml.positive()).select("doc_id", rnd("score").alias("score"))


# The same jobs with parts that have a closed form, so that SQL can say what must come out.

TEXTS = """texts AS (SELECT doc_id, quality::DOUBLE AS y, length(text)::DOUBLE AS chars, len(string_split(text, ' '))::DOUBLE AS words FROM documents JOIN labels USING (doc_id))"""


def _line(label="y"):
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal")


@book.add("m02_class_weights", f"WITH {TEXTS} SELECT doc_id, round((SELECT count(*) FROM texts) / (2 * count(*) OVER (PARTITION BY y)), 9) AS weight FROM texts")
def _(t):
    return ml.balanced_weights(texts(t).select("doc_id", "y"), "y").select("doc_id", rnd("weight", 9).alias("weight"))


@book.add("m03_char_ngram_counts", r"""
WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM documents),
g AS (SELECT word, n, unnest(range(1, length(word) - n + 2)) AS i FROM w, range(2, 5) r(n) WHERE length(word) > 1)
SELECT substr(word, i, n) AS gram, count(*) AS n FROM g GROUP BY 1""")
def _(t):
    words = t.documents.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("length(word) > 1").distinct()
    return words.select(F.explode(ml.char_ngrams(F.col("word"), 2, 4)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@book.add("m08_line_by_fold", f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS y, l_quantity AS x, CAST(floor({uniform_sql('l_orderkey', 6)} * 5) AS INT) AS fold FROM lineitem),
m AS (SELECT f AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM p, range(0, 5) r(f) WHERE fold <> f GROUP BY 1)
SELECT fold, round(sqrt(avg((y - a - b * x) ** 2)), 4) AS rmse, count(*) AS n FROM p JOIN m USING (fold) GROUP BY 1""")
def _(t):
    """Root mean squared error of rows that the model has not seen."""
    d = t.lineitem.select("l_orderkey", F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x"))
    d = materialize(splits.random_folds(d, "l_orderkey", 5, 6), "lines")
    scored = ml.out_of_fold(d, ["x"], _line(), "fold", 5, F.col("prediction"), "guess")
    return scored.groupBy("fold").agg(rnd(metrics.rmse(F.col("y"), F.col("guess")), 4).alias("rmse"), F.count("*").alias("n"))


def _draws(seed):
    edges = splits.poisson_edges(1.0)
    u = uniform_sql("doc_id", seed)
    return "CASE " + " ".join(f"WHEN {u} < {e!r}::DOUBLE THEN {n}" for n, e in enumerate(edges)) + f" ELSE {len(edges)} END"


@book.add("m10_bootstrap_lines", f"""
WITH {TEXTS}, d AS (SELECT *, {_draws(3)} AS w1, {_draws(4)} AS w2 FROM texts),
l AS (SELECT 1 AS i, y, words AS x, w1::DOUBLE AS w FROM d UNION ALL SELECT 2, y, words, w2 FROM d),
m AS (SELECT (sum(w) * sum(w * x * y) - sum(w * x) * sum(w * y)) / (sum(w) * sum(w * x * x) - sum(w * x) ** 2) AS b, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my FROM l GROUP BY i)
SELECT doc_id, round((SELECT avg(my - b * mx) FROM m) + (SELECT avg(b) FROM m) * words, 6) AS score FROM texts""")
def _(t):
    d = materialize(texts(t), "texts")
    return ml.bootstrap_bagging(d, d, "doc_id", ["words"], "y", models=2, seed=3, base=LinearRegression(solver="normal")).select("doc_id", rnd("score").alias("score"))


@book.add("m11_out_of_fold_line", f"""
WITH {TEXTS}, p AS (SELECT doc_id, y, words AS x, CAST(floor({uniform_sql('doc_id', 5)} * 4) AS INT) AS fold FROM texts),
m AS (SELECT f AS fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM p, range(0, 4) r(f) WHERE fold <> f GROUP BY 1)
SELECT doc_id, fold, round(a + b * x, 6) AS oof FROM p JOIN m USING (fold)""")
def _(t):
    d = materialize(splits.random_folds(texts(t).select("doc_id", "y", "words"), "doc_id", 4, 5), "texts")
    return ml.out_of_fold(d, ["words"], _line(), "fold", 4, F.col("prediction"), "oof").select("doc_id", "fold", rnd("oof").alias("oof"))


@book.add("m12_isotonic_steps", f"""
WITH {SCORED}, s AS (SELECT p1, sum(y) AS y, count(*) AS n FROM scored GROUP BY 1),
c AS (SELECT p1, sum(y) OVER w AS cy, sum(n) OVER w AS cn, sum(y) OVER w - y AS by, sum(n) OVER w - n AS bn FROM s WINDOW w AS (ORDER BY p1)),
lows AS (SELECT a.p1 AS lo, x.p1 AS place, min((b.cy - a.by) / (b.cn - a.bn)) AS m FROM c a JOIN c x ON a.p1 <= x.p1 JOIN c b ON b.p1 >= x.p1 GROUP BY 1, 2)
SELECT place AS p1, round(max(m), 9) AS calibrated FROM lows GROUP BY 1""")
def _(t):
    """Greatest lower mean over starts of the least mean over ends, at each distinct score."""
    d = t.scored.select("p1", F.col("y").cast("double").alias("y"))
    return ml.calibrate(d, "p1", "y").groupBy("p1").agg(rnd(F.max("calibrated"), 9).alias("calibrated"))


@book.add("m12_isotonic_out_of_fold", f"""
WITH {SCORED}, p AS (SELECT doc_id, y, p1 AS x, CAST(floor({uniform_sql('doc_id', 9)} * 4) AS INT) AS fold FROM scored),
s AS (SELECT f, x, sum(y) AS y, count(*) AS n FROM p, range(0, 4) r(f) WHERE fold <> f GROUP BY 1, 2),
c AS (SELECT f, x, sum(y) OVER w AS cy, sum(n) OVER w AS cn, sum(y) OVER w - y AS by, sum(n) OVER w - n AS bn FROM s WINDOW w AS (PARTITION BY f ORDER BY x)),
lows AS (SELECT a.f, a.x AS lo, m.x, min((b.cy - a.by) / (b.cn - a.bn)) AS v FROM c a JOIN c m ON a.f = m.f AND a.x <= m.x JOIN c b ON b.f = m.f AND b.x >= m.x GROUP BY 1, 2, 3),
fit AS (SELECT f, x, max(v) AS v FROM lows GROUP BY 1, 2)
SELECT doc_id, fold, round(CASE WHEN hi.x > lo.x THEN lo.v + (hi.v - lo.v) * ((p.x - lo.x) / (hi.x - lo.x)) ELSE coalesce(lo.v, hi.v) END, 9) AS calibrated
FROM p ASOF LEFT JOIN fit lo ON p.fold = lo.f AND p.x >= lo.x ASOF LEFT JOIN fit hi ON p.fold = hi.f AND p.x <= hi.x""")
def _(t):
    """Calibrated score of rows that the fit has not seen."""
    d = splits.random_folds(t.scored.select("doc_id", "y", "p1"), "doc_id", 4, 9)
    return isotonic.out_of_fold(d, "p1", "y", "fold", "calibrated").select("doc_id", "fold", rnd("calibrated", 9).alias("calibrated"))


@book.add("m15_segmented_lines", f"""
WITH {TEXTS}, m AS (SELECT chars < 1500 AS side, regr_slope(y, words) AS b, regr_intercept(y, words) AS a FROM texts GROUP BY 1)
SELECT doc_id, round(a + b * words, 6) AS score FROM texts JOIN m ON side = (chars < 1500)""")
def _(t):
    return ml.segmented(texts(t), F.col("chars") < 1500, ["words"], "y", _line(), F.col("prediction")).select("doc_id", rnd("score").alias("score"))


@book.add("m08_knn_out_of_fold", f"""WITH e AS (SELECT *, vec_id % 4 AS fold FROM embeddings), {emb_nn(5, "WHERE q.fold <> s.fold", src="e")}
SELECT a AS vec_id, round(avg(label), 6) AS guess FROM nn JOIN e ON e.vec_id = b GROUP BY 1""")
def _(t):
    d = t.embeddings.select("vec_id", "embedding", "label", (F.col("vec_id") % 4).alias("fold"))
    return ml.knn_out_of_fold(d, "vec_id", "embedding", "label", "fold").select("vec_id", rnd("guess").alias("guess"))


@book.add("m11_soft_vote", f"""WITH {SCORED}, s AS (SELECT doc_id, p1, CASE WHEN x % 3 <> 0 THEN p2 END AS p2 FROM scored)
SELECT doc_id, round((0.7::DOUBLE * p1 + coalesce(0.3::DOUBLE * p2, 0)) / (0.7::DOUBLE + CASE WHEN p2 IS NULL THEN 0 ELSE 0.3::DOUBLE END), 6) AS vote FROM s""")
def _(t):
    d = t.scored.select("doc_id", "p1", F.when(F.col("x") % 3 != 0, F.col("p2")).alias("p2"))
    return ml.soft_vote(d, ["p1", "p2"], weights=[0.7, 0.3]).select("doc_id", rnd("vote").alias("vote"))
