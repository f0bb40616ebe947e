"""Model scores. Ranking metrics count equal scores first and then use running sums, so there is
no global sort in one task and ties are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions.numbers import ratio
from featherloom.operators.ordered import running
from featherloom.operators.stats import with_stats


def _score_counts(df: DataFrame, label: str, score: str, keys: list[str]) -> DataFrame:
    y = F.col(label).cast("long")
    return df.groupBy(*keys, score).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def auc(df: DataFrame, label: str, score: str, keys: list[str] | None = None, out: str = "auc") -> DataFrame:
    """Exact ROC AUC with averaged ties, overall or per key; null when one class is missing."""
    keys = keys or []
    d = running(_score_counts(df, label, score, keys), keys, [score],
                {"cn": ("sum", F.col("neg")), "cp": ("sum", F.col("pos"))}, totals=True)
    wins = F.sum(F.col("pos") * (F.col("cn") - F.col("neg") / 2))
    pairs = F.max("cp_total").cast("double") * F.max("cn_total")
    return d.groupBy(*keys).agg(ratio(wins, pairs).alias(out))


def score_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score used as threshold ``p >= score``: true/false positives and class totals."""
    d = running(_score_counts(df, label, score, []), [], [f"-{score}"],
                {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}, totals=True)
    return d.select(F.col(score).alias("threshold"), "tp", "fp", F.col("tp_total").alias("p"), F.col("fp_total").alias("n"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_curve(df, label, score)
    return c.select("threshold", ratio(F.col("fp").cast("double"), F.col("n").cast("double")).alias("fpr"),
                    ratio(F.col("tp").cast("double"), F.col("p").cast("double")).alias("tpr"))


def youden_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """Threshold with the largest ``tpr - fpr``; ties go to the highest threshold."""
    r = roc_points(df, label, score)
    j = F.col("tpr") - F.col("fpr")
    key = F.struct(F.round(j, 12), F.col("threshold"))
    return r.agg(F.max_by("threshold", key).alias("threshold"), F.max(j).alias("youden_j"))


def precision_recall(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_curve(df, label, score)
    return c.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    ratio(F.col("tp").cast("double"), F.col("p").cast("double")).alias("recall"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("y"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class: support, precision, recall, F1; with accuracy and balanced accuracy on each row."""
    cells = confusion(df, label, pred)
    hit = F.sum(F.when(F.col("c") == F.col("o"), F.col("n")).otherwise(0))
    sides = cells.select("n", F.inline(F.array(
        F.struct(F.col("y").alias("c"), F.col("p").alias("o"), F.lit(1).alias("is_true")),
        F.struct(F.col("p").alias("c"), F.col("y").alias("o"), F.lit(0).alias("is_true")))))
    d = sides.groupBy("c").agg(
        F.sum(F.when((F.col("is_true") == 1) & (F.col("c") == F.col("o")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_true") == 1, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("is_true") == 0, F.col("n")).otherwise(0)).alias("predicted"))
    precision = ratio(F.col("tp").cast("double"), F.col("predicted").cast("double"))
    recall = ratio(F.col("tp").cast("double"), F.col("support").cast("double"))
    d = d.select(F.col("c").alias("class"), "support", "tp", precision.alias("precision"), recall.alias("recall"),
                 ratio(2.0 * F.col("tp"), (F.col("support") + F.col("predicted")).cast("double")).alias("f1"))
    d = with_stats(d, name="__s", tp=F.sum("tp"), n=F.sum("support"), balanced=F.avg("recall"))
    s = F.col("__s")
    return d.withColumns({"accuracy": s["tp"] / s["n"], "balanced_accuracy": s["balanced"]}).drop("__s", "tp")


def _cuts_passed(x: Column, grid: list[float], inclusive: bool) -> Column:
    """Number of sorted cut points below ``x`` (or equal to it when inclusive).

    On an evenly spaced grid the place is computed and only the three cuts around it are compared.
    """
    cuts, n = F.array(*[F.lit(g) for g in grid]), len(grid)

    def passed(g: Column) -> Column:
        return (g <= x) if inclusive else (g < x)

    step = (grid[-1] - grid[0]) / (n - 1) if n > 1 else 0.0
    if step <= 0 or any(abs(g - grid[0] - i * step) > 1e-6 * step for i, g in enumerate(grid)):
        return F.size(F.filter(cuts, passed))
    place = F.least(F.greatest(F.floor((x - grid[0]) / step), F.lit(-1)), F.lit(n)).cast("int")
    near = [F.coalesce(passed(F.when(place + j >= 0, F.get(cuts, place + j))).cast("int"), F.lit(0)) for j in (-1, 0, 1)]
    return F.greatest(place - 1, F.lit(0)) + near[0] + near[1] + near[2]


def counts_at(df: DataFrame, label: str, score: str, grid: list[float], at_most: bool = False) -> DataFrame:
    """True and false positives for every threshold of a grid, in one pass.

    Each row is counted in its grid cell; running sums over the cells give the thresholds.
    ``at_most`` predicts positive for ``score <= t`` instead of ``score >= t``.
    """
    points = sorted(float(g) for g in grid)
    cuts = F.array(*[F.lit(g) for g in points])
    x, y = F.col(score).cast("double"), F.col(label).cast("long")
    below = F.when(x.isNotNull(), _cuts_passed(x, points, inclusive=not at_most))  # a row without a score is never a hit
    cells = df.groupBy(below.alias("cell")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    by_cell = cells.agg(F.collect_list(F.struct("cell", "pos", "neg")).alias("cells"))  # at most len(grid) + 1 cells
    steps = by_cell.select("cells", F.posexplode(cuts).alias("i", "threshold"))
    hit = (lambda c: c["cell"] <= F.col("i")) if at_most else (lambda c: c["cell"] > F.col("i"))

    def total(field: str, only_hits: bool) -> Column:
        picked = F.filter("cells", hit) if only_hits else F.col("cells")
        return F.aggregate(picked, F.lit(0).cast("long"), lambda a, c: a + c[field])

    return steps.select("threshold", total("pos", True).alias("tp"), total("neg", True).alias("fp"),
                        total("pos", False).alias("p"), total("neg", False).alias("n"))


def best_f1(df: DataFrame, label: str, score: str, grid: list[float]) -> DataFrame:
    """Grid threshold with the highest F1; ties go to the lowest threshold."""
    c = counts_at(df, label, score, grid)
    f1 = ratio(2.0 * F.col("tp"), (F.col("p") + F.col("tp") + F.col("fp")).cast("double"))
    d = c.withColumn("f1", F.coalesce(f1, F.lit(0.0)))
    return d.agg(F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1"))


def rule_scan(df: DataFrame, label: str, value: str, grid: list[float]) -> DataFrame:
    """AUC of the rule ``value <= t`` for every ``t``: ``(1 + tpr - fpr) / 2``."""
    c = counts_at(df, label, value, grid, at_most=True)
    tpr = ratio(F.col("tp").cast("double"), F.col("p").cast("double"))
    fpr = ratio(F.col("fp").cast("double"), F.col("n").cast("double"))
    return c.select("threshold", ((1 + tpr - fpr) / 2).alias("auc"))


# aggregate expressions -------------------------------------------------------------------

def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def mape(y: Column, p: Column, eps: float = 1e-10) -> Column:
    return 100 * F.avg(F.abs((y - p) / (y + F.lit(eps))))


def log_loss(y: Column, p: Column, eps: float = 1e-15) -> Column:
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return F.avg(-(y * F.ln(q) + (1 - y) * F.ln(1 - q)))


def class_weight(y: Column, weights: list[float]) -> Column:
    return F.get(F.array(*[F.lit(float(w)) for w in weights]), y.cast("int"))


def weighted_mae(y: Column, p: Column, weights: list[float], normalise: bool = False) -> Column:
    """``mean(w |y - p|)``, or ``sum(w |y - p|) / sum(w)`` when normalised; the weight is that of the true class."""
    w = class_weight(y, weights)
    loss = w * F.abs(y - p)
    return ratio(F.sum(loss), F.sum(w)) if normalise else F.avg(loss)


# per-row losses --------------------------------------------------------------------------

def asymmetric_loss(y: Column, p: Column, alpha: float = 1.2, beta: float = 0.9, eps: float = 1.0, power: float = 2.0) -> dict[str, Column]:
    """Epsilon-insensitive loss, its gradient and its hessian in ``p``.

    ``alpha`` weighs predictions that are too high, ``beta`` those that are too low.
    """
    r = p - y
    over, under = r - eps, -r - eps

    def branch(high: Column, low: Column) -> Column:
        return F.when(r > eps, high).when(r < -eps, low).otherwise(F.lit(0.0))

    second = power * (power - 1)
    hessian = branch(alpha * second * F.pow(over, power - 2), beta * second * F.pow(under, power - 2)) if power > 1 else F.lit(0.0)
    return {
        "loss": branch(alpha * F.pow(over, power), beta * F.pow(under, power)),
        "gradient": branch(alpha * power * F.pow(over, power - 1), -beta * power * F.pow(under, power - 1)),
        "hessian": hessian,
    }


def huber(y: Column, p: Column, delta: float) -> dict[str, Column]:
    r = p - y
    near = F.abs(r) <= delta
    return {
        "loss": F.when(near, r * r / 2).otherwise(delta * (F.abs(r) - delta / 2)),
        "gradient": F.when(near, r).otherwise(delta * F.signum(r)),
        "hessian": F.when(near, F.lit(1.0)).otherwise(F.lit(0.0)),
    }


# choices ---------------------------------------------------------------------------------

def pick_class(probs: list[str], thresholds: list[float], weights: list[float]) -> Column:
    """Class with the largest weighted probability among those at or above their threshold; the most
    probable class when none passes. Ties go to the lower class."""
    scores = [F.when(F.col(c) >= t, F.col(c) * w) for c, t, w in zip(probs, thresholds, weights)]

    def first_best(values: list[Column]) -> Column:
        best = F.greatest(*values)  # skips nulls
        return F.coalesce(*[F.when(v == best, F.lit(i)) for i, v in enumerate(values)])

    return F.coalesce(first_best(scores), first_best([F.col(c) for c in probs]))


def _row_loss(y: Column, p: Column, weights: list[float]) -> Column:
    """``w |y - p|`` of one row as an exact decimal (weights to nine places), so that sums and ties do not depend on the order of rows."""
    return (class_weight(y, weights) * F.abs(y - p)).cast("decimal(20,9)")


def threshold_search(df: DataFrame, label: str, probs: list[str], grid: list[float], start: list[float],
                     pick_weights: list[float], loss_weights: list[float]) -> list[float]:
    """Class by class, the grid threshold with the lowest weighted MAE, ties to the first; one aggregation per class."""
    best = list(start)
    y = F.col(label).cast("double")
    for i in range(len(probs)):
        tries = [best[:i] + [g] + best[i + 1:] for g in grid]
        losses = df.agg(*[
            F.sum(_row_loss(y, pick_class(probs, t, pick_weights).cast("double"), loss_weights)).alias(f"g{j}") for j, t in enumerate(tries)
        ]).first()
        j = min(range(len(grid)), key=lambda k: (losses[k] is None, losses[k], k))
        best[i] = grid[j]
    return best


def threshold_lines(df: DataFrame, label: str, probs: list[str], start: list[float], pick_weights: list[float], loss_weights: list[float],
                    rounds: int = 1) -> list[tuple[float, float | None]]:
    """Class by class, the best of all thresholds in [0, 1], as (threshold, weighted MAE after that step).

    Along the threshold of one class a row has two outcomes only: the choice with that class allowed (threshold up to its probability) and
    without it. So the loss is a step function. Rows whose choice stays are no steps and go nowhere; the others are summed per probability,
    and running sums from the top give the loss at every step. Ties go to the largest threshold; 1.0 is always tried.

    A row with a null label or without any probability costs nothing. An empty table keeps ``start``, with null losses.
    """
    best, found = list(start), [(t, None) for t in start]
    y = F.col(label).cast("double")
    d = df.where(y.isNotNull() & F.coalesce(*probs).isNotNull())

    def loss(thresholds: list[float]) -> Column:
        return _row_loss(y, pick_class(probs, thresholds, pick_weights).cast("double"), loss_weights)

    for i in [*range(len(probs))] * rounds:
        allowed, barred = ([*best[:i], t, *best[i + 1:]] for t in (float("-inf"), float("inf")))
        p = F.col(probs[i]).cast("double")
        # one pass: the loss of all rows without the class, and what allowing it changes at each probability
        change = F.when(p.isNotNull(), loss(allowed) - loss(barred)).otherwise(F.lit(0).cast("decimal(20,9)"))
        rows = d.select(F.when(change != 0, F.least(p, F.lit(1.0))).alias("at"), change.alias("change"), loss(barred).alias("barred"))
        steps = rows.groupBy("at").agg(F.sum("change").alias("change"), F.sum("barred").alias("barred"), F.count("*").alias("n"))
        steps = steps.unionByName(d.sparkSession.createDataFrame([(1.0,)], "at double"), allowMissingColumns=True)
        steps = steps.groupBy("at").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("change", "barred", "n")])
        run = running(steps, [], ["-at"], {"change_above": ("sum", F.col("change")), "barred_above": ("sum", F.col("barred")), "rows_above": ("sum", F.col("n"))},
                      totals=True)
        total = F.col("barred_above_total") + F.col("change_above")
        top = run.where("at IS NOT NULL").agg(
            F.max_by(F.struct("at", total.alias("loss"), F.col("rows_above_total").alias("n")), F.struct(-total, F.col("at"))).alias("b")).first()["b"]
        if not top["n"]:
            return found
        best[i] = top["at"]
        found[i] = (top["at"], float(top["loss"] / top["n"]))
    return found


# error reports ---------------------------------------------------------------------------

def error_summary(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Wrong rows, false positives and negatives with their shares, and the mean distance."""
    y, wrong = F.col(label), (F.col(score) >= threshold).cast("int") != F.col(label)
    n = F.count("*")
    return df.agg(
        n.alias("n"), F.count_if(wrong).alias("errors"), F.count_if(wrong & (y == 0)).alias("false_positives"),
        F.count_if(wrong & (y == 1)).alias("false_negatives"), (F.count_if(wrong) / n).alias("error_share"),
        (F.count_if(wrong & (y == 0)) / F.count_if(wrong)).alias("false_positive_share"), F.avg(F.abs(y - F.col(score))).alias("mean_distance"))


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and positive rate per equal-width score bin; the last bin includes 1."""
    i = F.when(F.col(score).isNotNull(), F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)))
    return df.groupBy(i.alias("bin")).agg(F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("positive_rate"), F.count("*").alias("n"))


def fold_scores(df: DataFrame, fold: str, metric: Column) -> DataFrame:
    """A metric per fold, with the mean and population deviation over the folds on each row."""
    per_fold = df.groupBy(fold).agg(metric.alias("score"))
    d = with_stats(per_fold, name="__s", mean=F.avg("score"), std=F.stddev_pop("score"))
    return d.select(fold, "score", F.col("__s.mean").alias("mean"), F.col("__s.std").alias("std"))


def segment_errors(df: DataFrame, segment: str, error: Column) -> DataFrame:
    """Mean error, total error and share of all error per segment."""
    d = df.groupBy(segment).agg(F.count("*").alias("n"), F.avg(error).alias("mean_error"), F.sum(error).alias("total_error"))
    return with_stats(d, name="__s", t=F.sum("total_error")).withColumn("error_share", ratio(F.col("total_error"), F.col("__s.t"))).drop("__s")


def segment_auc(df: DataFrame, label: str, segment: str, models: list[str]) -> DataFrame:
    """AUC of every model column in every segment, as one long table."""
    long = df.select(segment, label, *models).unpivot([segment, label], models, "model", "score")
    return auc(long, label, "score", [segment, "model"])


def attribution(long: DataFrame, feature: str, value: str, amount: str, k: int, min_share: float = 0.01) -> DataFrame:
    """Mean absolute attribution per (feature, category); categories rarer than a share of the
    feature's rows count as ``Other``. The k largest."""
    counts = long.groupBy(feature, value).agg(F.count("*").alias("n"), F.sum(F.abs(amount)).alias("s"))
    totals = counts.groupBy(F.col(feature).alias("__f")).agg(F.sum("n").alias("__t"))
    d = counts.join(totals, F.col(feature) == F.col("__f"))
    name = F.when(F.col("n") / F.col("__t") >= min_share, F.col(value)).otherwise("Other")
    d = d.groupBy(feature, name.alias("value")).agg((F.sum("s") / F.sum("n")).alias("mean_abs"))
    return d.orderBy(F.desc("mean_abs"), feature, "value").limit(k)
