"""Evaluation and ensembling (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import SCORED, Book, rnd
from featherloom.operators import encode
from featherloom.operators import metrics as m
from featherloom.operators.joins import checked_pairs, weighted_blend
from featherloom.operators.ordered import group_quantiles
from featherloom.operators.stats import with_stats

book = Book()
W = f"WITH {SCORED}"


@book.add("v01_checked_mae", f"{W} SELECT round(avg(abs(y - p1)), 6) AS mae FROM scored")
def _(t):
    pairs = checked_pairs(t.scored.select("doc_id", "y"), t.scored.select("doc_id", "p1"), "doc_id")
    return pairs.agg(rnd(m.mae(F.col("y"), F.col("p1"))).alias("mae"))


@book.add("v02_rmse_by_fold", f"{W} SELECT CASE WHEN grouping(doc_id % 5) = 1 THEN -1 ELSE doc_id % 5 END AS fold, round(sqrt(avg((y - p1) ** 2)), 6) AS rmse FROM scored GROUP BY GROUPING SETS ((doc_id % 5), ())")
def _(t):
    d = t.scored.withColumn("fold", F.col("doc_id") % 5)
    overall = d.agg(m.rmse(F.col("y"), F.col("p1")).alias("rmse")).select(F.lit(-1).cast("long").alias("fold"), "rmse")
    return d.groupBy("fold").agg(m.rmse(F.col("y"), F.col("p1")).alias("rmse")).unionByName(overall).withColumn("rmse", rnd("rmse"))


@book.add("v03_mape", "SELECT round(100 * avg(abs((o_totalprice - 250000) / (o_totalprice + 1e-10))), 6) AS mape FROM orders")
def _(t):
    return t.orders.agg(rnd(m.mape(F.col("o_totalprice"), F.lit(250000.0))).alias("mape"))


@book.add("v04_auc", f"""{W}, r AS (SELECT y, rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2 AS rk FROM scored)
SELECT round((sum(CASE WHEN y = 1 THEN rk END) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)), 6) AS auc FROM r""")
def _(t):
    return m.auc(t.scored, "y", "p1").select(rnd("auc").alias("auc"))


CURVE = f"""{W}, c AS (SELECT p1 AS threshold, sum(sum(y)) OVER (ORDER BY p1 DESC) AS tp, sum(sum(1 - y)) OVER (ORDER BY p1 DESC) AS fp, sum(sum(y)) OVER () AS p, sum(sum(1 - y)) OVER () AS n FROM scored GROUP BY 1)"""


@book.add("v05_roc_curve", f"{CURVE} SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c")
def _(t):
    return m.roc_points(t.scored, "y", "p1").select("threshold", rnd("fpr").alias("fpr"), rnd("tpr").alias("tpr"))


@book.add("v05_youden_threshold", f"{CURVE} SELECT threshold, round(tp / p - fp / n, 6) AS youden_j FROM c ORDER BY round(tp / p - fp / n, 12) DESC, threshold DESC LIMIT 1")
def _(t):
    return m.youden_threshold(t.scored, "y", "p1").select("threshold", rnd("youden_j").alias("youden_j"))


@book.add("v06_precision_recall", f"{CURVE} SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM c")
def _(t):
    return m.precision_recall(t.scored, "y", "p1").select("threshold", rnd("precision").alias("precision"), rnd("recall").alias("recall"))


@book.add("v07_confusion", f"{W} SELECT y, CASE WHEN p1 >= 0.4 THEN 1 ELSE 0 END AS p, count(*) AS n FROM scored GROUP BY 1, 2")
def _(t):
    return m.confusion(t.scored.withColumn("pred", (F.col("p1") >= 0.4).cast("int")), "y", "pred")


@book.add("v07_class_report", f"""{W}, d AS (SELECT y, CASE WHEN p1 >= 0.4 THEN 1 ELSE 0 END AS p FROM scored), k AS (SELECT unnest([0, 1]) AS class),
c AS (SELECT class, count(*) FILTER (WHERE y = class) AS support, count(*) FILTER (WHERE p = class) AS predicted, count(*) FILTER (WHERE y = class AND p = class) AS tp FROM d, k GROUP BY 1)
SELECT class, support, round(tp / nullif(predicted, 0), 6) AS precision, round(tp / support, 6) AS recall, round(2 * tp / (support + predicted), 6) AS f1,
  round(sum(tp) OVER () / sum(support) OVER (), 6) AS accuracy, round(avg(tp / support) OVER (), 6) AS balanced_accuracy FROM c""")
def _(t):
    d = m.class_report(t.scored.withColumn("pred", (F.col("p1") >= 0.4).cast("int")), "y", "pred")
    return d.select("class", "support", *[rnd(c).alias(c) for c in ("precision", "recall", "f1", "accuracy", "balanced_accuracy")])


GRID = [0.1 + 0.8 * i / 49 for i in range(50)]


@book.add("v08_best_f1", f"""{W}, g AS (SELECT unnest({GRID}) :: DOUBLE AS threshold), c AS (SELECT threshold, 2 * count(*) FILTER (WHERE p1 >= threshold AND y = 1) / (count(*) FILTER (WHERE p1 >= threshold) + count(*) FILTER (WHERE y = 1)) AS f1 FROM scored, g GROUP BY 1)
SELECT threshold, round(f1, 6) AS f1 FROM c ORDER BY f1 DESC, threshold LIMIT 1""")
def _(t):
    return m.best_f1(t.scored, "y", "p1", GRID).withColumn("f1", rnd("f1"))


SCAN = [float(x) for x in range(0, 14440, 20)]


@book.add("v09_rule_scan", f"""{W}, g AS (SELECT (i * 20)::DOUBLE AS threshold FROM range(0, 722) r(i)),
c AS (SELECT threshold, count(*) FILTER (WHERE x <= threshold AND y = 1) / count(*) FILTER (WHERE y = 1) AS tpr, count(*) FILTER (WHERE x <= threshold AND y = 0) / count(*) FILTER (WHERE y = 0) AS fpr FROM scored, g GROUP BY 1)
SELECT threshold, round((1 + tpr - fpr) / 2, 6) AS auc FROM c""")
def _(t):
    return m.rule_scan(t.scored, "y", "x", SCAN).withColumn("auc", rnd("auc"))


# fixed values: class weights
WEIGHTS = [1.00, 0.72, 0.52, 0.37, 0.27, 0.19, 0.14, 0.00]
CASES = "CASE {c} " + " ".join(f"WHEN {i} THEN {w}::DOUBLE" for i, w in enumerate(WEIGHTS)) + " END"
CLS = "cls AS (SELECT doc_id, CAST(n_chars % 8 AS INT) AS y, CAST(n_chars // 8 % 8 AS INT) AS p FROM documents)"


def _classes(t):
    n = F.col("n_chars")
    return t.documents.select("doc_id", (n % 8).cast("int").alias("y"), (F.floor(n / 8) % 8).cast("int").alias("p"))


@book.add("v10_weighted_mae", f"WITH {CLS} SELECT round(avg({CASES.format(c='y')} * abs(y - p)), 6) AS wmae FROM cls")
def _(t):
    return _classes(t).agg(rnd(m.weighted_mae(F.col("y"), F.col("p"), WEIGHTS)).alias("wmae"))


@book.add("v11_weighted_mae_normalised", f"WITH {CLS} SELECT round(sum({CASES.format(c='y')} * abs(y - p)) / sum({CASES.format(c='y')}), 6) AS wmae FROM cls")
def _(t):
    return _classes(t).agg(rnd(m.weighted_mae(F.col("y"), F.col("p"), WEIGHTS, normalise=True)).alias("wmae"))


@book.add("v12_blend", f"{W} SELECT doc_id, round(0.63 * p1 + 0.37 * p2, 6) AS p FROM scored")
def _(t):
    a, b = (t.scored.select("doc_id", F.col(c).alias("p")) for c in ("p1", "p2"))
    return weighted_blend([(a, 0.63), (b, 0.37)], "doc_id", "p").withColumn("p", rnd("p"))


@book.add("v13_disagreement_blend", "SELECT o_orderkey, round(CASE WHEN abs(a - b) > 2000 THEN 0.2 * a + 0.8 * b ELSE a END, 4) AS p FROM (SELECT o_orderkey, o_totalprice AS a, o_totalprice * (1 + (o_orderkey % 3) / 100.0::DOUBLE) AS b FROM orders)")
def _(t):
    a = F.col("o_totalprice")
    b = a * (1 + (F.col("o_orderkey") % 3) / 100.0)
    return t.orders.select("o_orderkey", rnd(F.when(F.abs(a - b) > 2000, 0.2 * a + 0.8 * b).otherwise(a), 4).alias("p"))


PROBS = [f"c{i}" for i in range(8)]
# fixed values: probability threshold per class
THRESHOLDS = [0.24, 0.235, 0.122, 0.05, 0.05, 0.05, 0.05, 0.05]


def probs(t):
    n = F.col("n_chars")
    raw = [((n % (11 + 2 * i)) + 1).cast("double") for i in range(8)]
    total = sum(raw[1:], raw[0])
    return t.documents.select("doc_id", (n % 8).cast("int").alias("y"), *[(r / total).alias(c) for r, c in zip(raw, PROBS)])


PROB_SQL = "raw AS (SELECT doc_id, CAST(n_chars % 8 AS INT) AS y, " + ", ".join(f"(n_chars % {11 + 2 * i} + 1)::DOUBLE AS r{i}" for i in range(8)) + " FROM documents), pr AS (SELECT doc_id, y, " + ", ".join(
    f"r{i} / ({' + '.join(f'r{j}' for j in range(8))}) AS c{i}" for i in range(8)) + " FROM raw)"


@book.add("v14_threshold_class_choice", f"""WITH {PROB_SQL}, l AS (SELECT doc_id, unnest(range(8)) AS k, unnest([{', '.join(PROBS)}]) AS p, unnest({THRESHOLDS}) AS t, unnest({WEIGHTS}) AS w FROM pr),
b AS (SELECT doc_id, arg_min(k, (-(p * w::DOUBLE), k)) FILTER (WHERE p >= t) AS best, arg_min(k, (-p, k)) AS plain FROM l GROUP BY 1) SELECT doc_id, CAST(coalesce(best, plain) AS INT) AS chosen FROM b""")
def _(t):
    return probs(t).select("doc_id", m.pick_class(PROBS, THRESHOLDS, WEIGHTS).alias("chosen"))


def _search_sql(candidates, tie):
    """Brute force: every candidate of every class in turn, with the whole loss over all rows."""
    best, steps = [f"{t!r}::DOUBLE" for t in THRESHOLDS], []
    for i in range(8):
        tries = [*best[:i], "t", *best[i + 1:]]
        high = "greatest(" + ", ".join(f"CASE WHEN c{j} >= {t} THEN c{j} * {w!r}::DOUBLE END" for j, (t, w) in enumerate(zip(tries, WEIGHTS))) + ")"
        first = " ".join(f"WHEN c{j} >= {t} AND c{j} * {w!r}::DOUBLE = high THEN {j}" for j, (t, w) in enumerate(zip(tries, WEIGHTS)))
        plain = " ".join(f"WHEN c{j} = greatest({', '.join(PROBS)}) THEN {j}" for j in range(8))
        steps.append(f"""h{i} AS (SELECT *, {high} AS high FROM pr, ({candidates.format(c=f'c{i}')}) v),
l{i} AS (SELECT t, sum(CAST({CASES.format(c='y')} AS DECIMAL(20, 9)) * abs(y - CASE {first} {plain} END)) AS loss, count(*) AS n FROM h{i} GROUP BY 1),
b{i} AS (SELECT {i} AS class, t, loss::DOUBLE / n AS wmae FROM l{i} ORDER BY loss, t {tie} LIMIT 1)""")
        best[i] = f"(SELECT t FROM b{i})"
    return f"WITH {PROB_SQL}, " + ", ".join(steps), best


_GRID_SQL, _GRID_BEST = _search_sql("SELECT i / 40::DOUBLE AS t FROM range(1, 21) r(i)", "ASC")
_LINE_SQL, _ = _search_sql("SELECT DISTINCT {c} AS t FROM pr UNION SELECT 1.0::DOUBLE", "DESC")


@book.add("v15_threshold_search", f"{_GRID_SQL} SELECT concat_ws(',', {', '.join(f'CAST({b} AS VARCHAR)' for b in _GRID_BEST)}) AS thresholds, round((SELECT wmae FROM b7), 6) AS wmae")
def _(t):
    d = probs(t)
    best = m.threshold_search(d, "y", PROBS, [i / 40 for i in range(1, 21)], THRESHOLDS, WEIGHTS, WEIGHTS)
    loss = m.weighted_mae(F.col("y"), m.pick_class(PROBS, best, WEIGHTS), WEIGHTS)
    return d.agg(F.lit(",".join(str(b) for b in best)).alias("thresholds"), rnd(loss).alias("wmae"))


@book.add("v15_threshold_lines", _LINE_SQL + " SELECT class, round(t, 9) AS threshold, round(wmae, 6) AS wmae FROM (" + " UNION ALL ".join(f"SELECT * FROM b{i}" for i in range(8)) + ")")
def _(t):
    best = m.threshold_lines(probs(t), "y", PROBS, THRESHOLDS, WEIGHTS, WEIGHTS)
    rows = t.spark.createDataFrame([(i, *b) for i, b in enumerate(best)], "class int, threshold double, wmae double")
    return rows.select("class", rnd("threshold", 9).alias("threshold"), rnd("wmae").alias("wmae"))


@book.add("v16_error_summary", f"""{W}, e AS (SELECT *, CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END <> y AS wrong FROM scored)
SELECT count(*) AS n, count(*) FILTER (WHERE wrong) AS errors, count(*) FILTER (WHERE wrong AND y = 0) AS false_positives, count(*) FILTER (WHERE wrong AND y = 1) AS false_negatives,
  round(count(*) FILTER (WHERE wrong) / count(*), 6) AS error_share, round(count(*) FILTER (WHERE wrong AND y = 0) / count(*) FILTER (WHERE wrong), 6) AS false_positive_share, round(avg(abs(y - p1)), 6) AS mean_distance FROM e""")
def _(t):
    d = m.error_summary(t.scored, "y", "p1")
    return d.withColumns({c: rnd(c) for c in ("error_share", "false_positive_share", "mean_distance")})


@book.add("v17_error_by_decile", f"""{W}, q AS (SELECT list_sort(list_distinct(quantile_cont(x, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM scored),
d AS (SELECT greatest(len(list_filter(e, lambda v: v < x)) - 1, 0) AS decile, abs(y - p1) AS err FROM scored, q)
SELECT CAST(decile AS INT) AS decile, round(quantile_cont(err, 0.25), 6) AS q25, round(median(err), 6) AS q50, round(quantile_cont(err, 0.75), 6) AS q75 FROM d GROUP BY 1""")
def _(t):
    d = encode.quantile_bin(t.scored.select("x", F.abs(F.col("y") - F.col("p1")).alias("err")), "x", "decile")
    q = group_quantiles(d, ["decile"], "err", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return q.select("decile", *[rnd(c).alias(c) for c in ("q25", "q50", "q75")])


@book.add("v18_calibration", f"{W} SELECT CAST(least(floor(p1 * 10), 9) AS BIGINT) AS bin, round(avg(p1), 6) AS mean_score, round(avg(y), 6) AS positive_rate, count(*) AS n FROM scored GROUP BY 1")
def _(t):
    d = m.calibration(t.scored, "y", "p1")
    return d.select("bin", rnd("mean_score").alias("mean_score"), rnd("positive_rate").alias("positive_rate"), "n")


RES = "r AS (SELECT event_id, value - 20.3 AS r FROM events)"


@book.add("v19_asymmetric_loss", f"""WITH {RES} SELECT event_id, round(CASE WHEN r > 1 THEN 1.2 * (r - 1) ** 2 WHEN r < -1 THEN 0.9 * (-r - 1) ** 2 ELSE 0 END, 6) AS loss,
  round(CASE WHEN r > 1 THEN 2.4 * (r - 1) WHEN r < -1 THEN -1.8 * (-r - 1) ELSE 0 END, 6) AS gradient, CASE WHEN r > 1 THEN 2.4 WHEN r < -1 THEN 1.8 ELSE 0 END::DOUBLE AS hessian FROM r""")
def _(t):
    cols = m.asymmetric_loss(F.lit(20.3), F.col("value"))
    return t.events.select("event_id", *[rnd(c).alias(n) for n, c in cols.items()])


@book.add("v20_log_loss", f"{W} SELECT round(avg(-(y * ln(least(greatest(p1, 1e-15), 1 - 1e-15)) + (1 - y) * ln(1 - least(greatest(p1, 1e-15), 1 - 1e-15)))), 6) AS log_loss FROM scored")
def _(t):
    return t.scored.agg(rnd(m.log_loss(F.col("y"), F.col("p1"))).alias("log_loss"))


@book.add("v21_fold_mean_and_std", f"{W}, f AS (SELECT doc_id % 5 AS fold, avg(abs(y - p1)) AS score FROM scored GROUP BY 1) SELECT fold, round(score, 6) AS score, round(avg(score) OVER (), 6) AS mean, round(stddev_pop(score) OVER (), 6) AS std FROM f")
def _(t):
    d = m.fold_scores(t.scored.withColumn("fold", F.col("doc_id") % 5), "fold", m.mae(F.col("y"), F.col("p1")))
    return d.select("fold", *[rnd(c).alias(c) for c in ("score", "mean", "std")])


@book.add("v22_box_statistics", "SELECT o_orderstatus, min(o_totalprice) AS low, round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(median(o_totalprice), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75, max(o_totalprice) AS high FROM orders GROUP BY 1")
def _(t):
    q = group_quantiles(t.orders, ["o_orderstatus"], "o_totalprice", {"low": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "high": 1.0})
    return q.select("o_orderstatus", *[rnd(c, 4).alias(c) for c in ("low", "q25", "q50", "q75", "high")])


@book.add("v23_attribution", """
WITH l AS (SELECT 'brand' AS feature, p_brand AS value, l_discount - 0.05 AS a FROM lineitem JOIN part ON l_partkey = p_partkey UNION ALL SELECT 'type', p_type, l_tax - 0.04 FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT feature, value, count(*) AS n, sum(abs(a)) AS s FROM l GROUP BY 1, 2), d AS (SELECT feature, CASE WHEN n / sum(n) OVER (PARTITION BY feature) >= 0.04 THEN value ELSE 'Other' END AS value, n, s FROM c)
SELECT feature, value, round(sum(s) / sum(n), 6) AS mean_abs FROM d GROUP BY 1, 2 ORDER BY sum(s) / sum(n) DESC, feature, value LIMIT 12""")
def _(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    cells = F.array(F.struct(F.lit("brand").alias("feature"), F.col("p_brand").alias("value"), (F.col("l_discount") - 0.05).alias("a")),
                    F.struct(F.lit("type").alias("feature"), F.col("p_type").alias("value"), (F.col("l_tax") - 0.04).alias("a")))
    return m.attribution(d.select(F.inline(cells)), "feature", "value", "a", 12, 0.04).withColumn("mean_abs", rnd("mean_abs"))


@book.add("v24_huber", f"""WITH {RES} SELECT event_id, round(CASE WHEN abs(r) <= 1 THEN r * r / 2 ELSE abs(r) - 0.5 END, 6) AS loss, round(CASE WHEN abs(r) <= 1 THEN r ELSE sign(r) END, 6) + 0 AS gradient,
  CASE WHEN abs(r) <= 1 THEN 1 ELSE 0 END::DOUBLE AS hessian, round(avg(CASE WHEN abs(r) <= 1 THEN r * r / 2 ELSE abs(r) - 0.5 END) OVER (), 6) AS mean_loss FROM r""")
def _(t):
    cols = m.huber(F.lit(20.3), F.col("value"), 1.0)
    d = t.events.select("event_id", *[c.alias(n) for n, c in cols.items()])
    d = with_stats(d, mean=F.avg("loss"))
    return d.select("event_id", *[rnd(n).alias(n) for n in cols], rnd("stats.mean").alias("mean_loss"))


@book.add("v25_mean_asymmetric_loss", f"WITH {RES} SELECT round(avg(CASE WHEN r > 1 THEN 1.2 * (r - 1) ** 2 WHEN r < -1 THEN 0.9 * (-r - 1) ** 2 ELSE 0 END), 6) AS mean_loss FROM r")
def _(t):
    return t.events.agg(rnd(F.avg(m.asymmetric_loss(F.lit(20.3), F.col("value"))["loss"])).alias("mean_loss"))


@book.add("v26_segment_errors", f"{W} SELECT lang, count(*) AS n, round(avg(abs(y - p1)), 6) AS mean_error, round(sum(abs(y - p1)), 6) AS total_error, round(sum(abs(y - p1)) / sum(sum(abs(y - p1))) OVER (), 6) AS error_share FROM scored GROUP BY 1")
def _(t):
    d = m.segment_errors(t.scored, "lang", F.abs(F.col("y") - F.col("p1")))
    return d.select("lang", "n", *[rnd(c).alias(c) for c in ("mean_error", "total_error", "error_share")])


@book.add("v27_segment_auc", f"""{W}, l AS (SELECT lang, 'p1' AS model, y, p1 AS s FROM scored UNION ALL SELECT lang, 'p2', y, p2 FROM scored),
r AS (SELECT *, rank() OVER (PARTITION BY lang, model ORDER BY s) + (count(*) OVER (PARTITION BY lang, model, s) - 1) / 2 AS rk FROM l),
a AS (SELECT lang, model, sum(CASE WHEN y = 1 THEN rk END) AS rs, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM r GROUP BY 1, 2)
SELECT lang, model, round((rs - p * (p + 1) / 2) / nullif(p * n, 0), 6) AS auc FROM a""")
def _(t):
    return m.segment_auc(t.scored, "y", "lang", ["p1", "p2"]).withColumn("auc", rnd("auc"))
