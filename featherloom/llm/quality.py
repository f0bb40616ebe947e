"""Text statistics, plain rules and robust multivariate outliers (minimum covariance determinant) per language and source."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherloom.llm.common import WORD, let
from featherloom.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
GRID = 1024  # statistics are rounded to 1/GRID, so their sums and products add up exactly in any order


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long) of the whole text.

    n_dup_lines: lines with a word that equal an earlier line. n_repeat_words: words that stand in a window of three words found at least
    twice in the text. Null texts are empty. All of it works inside one row; nothing is shuffled.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    keep = [c for c in docs.columns if c not in (text, *names)]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, body.alias("__text"), F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("__w"))
    lines = F.filter(F.split("__text", "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    triples = F.when(F.size("__w") >= 3, F.transform(F.slice("__w", F.lit(1), F.size("__w") - 2), lambda x, i: F.concat_ws(
        " ", x, F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(F.expr("cast(array() as array<string>)"))
    rows = rows.select(
        *keep, F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.when(F.instr("__text", "\n") > 0, let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(0).cast("long").alias("n_dup_lines"),
        triples.alias("__t"))
    repeated = F.when(F.size(F.array_distinct("__t")) < F.size("__t"), _covered(F.col("__t"))).otherwise(0)
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.cast("long").alias("n_repeat_words"))


def _covered(triples: Column) -> Column:
    """Words covered by windows whose triple occurs at least twice: sort, keep those equal to a neighbour, add up what each newly covers."""
    placed = F.sort_array(F.transform(triples, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    twice = let(placed, lambda s: F.transform(F.filter(s, lambda e, k: F.coalesce(e["x"] == F.get(s, k - 1)["x"], F.lit(False)) | F.coalesce(
        e["x"] == F.get(s, k + 1)["x"], F.lit(False))), lambda e: e["i"]))
    return let(F.sort_array(twice), lambda at: F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
                                                           F.lit(0), lambda a, b: a + b))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def statistics() -> dict[str, Column]:
    """The transformed statistics that the outlier rule sees, for rows with words: each about symmetric and of order 1."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))

    def on_grid(c: Column) -> Column:
        return F.round(c * GRID) / GRID

    return {"x0": on_grid(F.ln(words)), "x1": on_grid(F.ln(chars / words)), "x2": on_grid(F.log1p(F.col("n_symbols") * 100 / chars)),
            "x3": on_grid(F.log1p(F.col("n_dup_lines") * 100 / words)), "x4": on_grid(F.log1p(F.col("n_repeat_words") * 100 / words))}


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _with_factor(df: DataFrame, d: int) -> DataFrame:
    """Adds the Cholesky factor l_i_j of the matrix v_i_j and its log determinant ``logdet``."""
    for i in range(d):
        for j in range(i + 1):
            rest = F.col(f"v_{i}_{j}") - _total([F.lit(0.0)] + [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)])
            df = df.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return df.withColumn("logdet", _total([2 * F.ln(f"l_{i}_{i}") for i in range(d)]))


def _distance(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds ``d2``: squared Mahalanobis distance from m_i under the factor l_i_j, by forward substitution."""
    for i, x in enumerate(names):
        rest = F.col(x) - F.col(f"m_{i}") - _total([F.lit(0.0)] + [F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i)])
        df = df.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    return df.withColumn("d2", _total([F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(names))])).drop(*[f"z_{i}" for i in range(len(names))])


def _medians(rows: DataFrame, names: list[str], label: str) -> DataFrame:
    """Per group and statistic the median ``med`` on the grid, from exact counts per grid value."""
    cells = rows.select("g", F.posexplode(F.array(*names)).alias("k", "x")).groupBy("g", "k", "x").agg(F.count("*").alias("n"))
    spans = Window.partitionBy("g", "k")
    cum = cells.withColumns({"c": F.sum("n").over(spans.orderBy("x")), "all": F.sum("n").over(spans)})
    return materialize(cum.where(F.col("c") * 2 >= F.col("all")).groupBy("g", "k").agg(F.min("x").alias("med")), label)


def _pivot(df: DataFrame, value: str, names: list[str], prefix: str) -> DataFrame:
    return df.groupBy("g").agg(*[F.max(F.when(F.col("k") == i, F.col(value))).alias(f"{prefix}{i}") for i in range(len(names))])


def fit_mcd(rows: DataFrame, names: list[str], support: float = 0.75, steps: int = 4, floors: list[float] | None = None) -> DataFrame:
    """Minimum-covariance-determinant centre m_i and Cholesky factor l_i_j for each value of column ``g``: one row per group.

    Two deterministic starts, medians with median absolute deviations and plain moments, are improved by ``steps`` concentration steps:
    moments of the ``support`` share of rows that lie nearest. Of both results the one with the smaller determinant stays. A step is one
    pass: rows are counted and summed per (group, start, distance bin) before the shuffle, so a group of any size costs each task a few
    hundred sums; bins are 1/16 of an e-fold of the distance and the last one counts whole. ``floors`` are least standard deviations,
    since many statistics are constant in clean text.
    """
    d = len(names)
    floors = floors or [0.05] * d
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = [F.sum(x).alias(f"s_{i}") for i, x in enumerate(names)] + [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"q_{i}_{j}") for i, j in pairs]
    flat = [f"s_{i}" for i in range(d)] + [f"q_{i}_{j}" for i, j in pairs]

    def moments(df: DataFrame) -> DataFrame:
        n = F.col("n")
        df = df.withColumns({f"m_{i}": F.col(f"s_{i}") / n for i in range(d)})
        return df.withColumns({f"v_{i}_{j}": F.col(f"q_{i}_{j}") / n - F.col(f"m_{i}") * F.col(f"m_{j}") + (
            F.lit(floors[i] ** 2) if i == j else F.lit(0.0)) for i, j in pairs})

    keep = ["g", "start", *[f"m_{i}" for i in range(d)], *[f"v_{i}_{j}" for i, j in pairs]]
    plain = moments(rows.groupBy("g").agg(F.count("*").alias("n"), *sums).withColumn("start", F.lit(1))).select(*keep)
    centre = _medians(rows, names, "centres")
    wide = _pivot(centre, "med", names, "m_")
    away = rows.join(wide, "g").select("g", *[F.abs(F.col(x) - F.col(f"m_{i}")).alias(x) for i, x in enumerate(names)])
    spread = _pivot(_medians(away, names, "spreads"), "med", names, "d_")
    robust = wide.join(spread, "g").withColumn("start", F.lit(0)).withColumns({
        f"v_{i}_{j}": F.pow(F.col(f"d_{i}") * 1.4826, F.lit(2)) + floors[i] ** 2 if i == j else F.lit(0.0) for i, j in pairs}).select(*keep)
    params = materialize(_with_factor(plain.unionByName(robust), d).drop(*[f"v_{i}_{j}" for i, j in pairs]), "mcd")
    for _ in range(steps):
        near = _distance(rows.join(params, "g"), names).withColumn("bin", F.floor(F.ln(F.col("d2") + 1e-6) * 16).cast("int"))
        bins = near.groupBy("g", "start", "bin").agg(F.count("*").alias("n"), *sums)
        group = Window.partitionBy("g", "start")
        upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        cum = bins.withColumns({"c": F.sum("n").over(upto), "all": F.sum("n").over(group)})
        inner = cum.where((F.col("c") - F.col("n")) < F.col("all") * support)
        params = moments(inner.groupBy("g", "start").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in flat])).select(*keep)
        params = materialize(_with_factor(params, d).drop(*[f"v_{i}_{j}" for i, j in pairs]), "mcd")
    best = params.groupBy("g").agg(F.min_by(F.struct(*[c for c in params.columns if c != "g"]), F.struct("logdet", "start")).alias("p"))
    return materialize(best.select("g", "p.*").drop("start"), "mcd")


# least standard deviations of the statistics x0..x4: spread that clean text may show although most rows of a group are alike
FLOORS = [1.0, 0.15, 0.35, 0.6, 0.6]


def judge(docs: DataFrame, text: str = "text", least_rows: int = 200, cutoff: float = 49.0, support: float = 0.75) -> DataFrame:
    """``docs`` without ``text`` plus the statistics, base_failed, d2 (null without an estimate) and kept.

    Rows that pass the base rules enter the estimate of their (lang, source) group; groups of fewer than ``least_rows`` such rows are
    estimated together, per language and then as a whole, and a rest of fewer than ``least_rows`` is not judged. Kept: base rules passed
    and squared distance at most ``cutoff`` (seven robust standard deviations; the 0.999999 quantile of a normal cloud in five
    dimensions is 38, and clean text has heavier tails). Null languages and sources are groups of their own.
    """
    held = materialize(text_stats(docs.drop("base_failed", "kept", "d2"), text).withColumn("base_failed", base_failed()), "stats")
    named = held.withColumns(statistics()).withColumns({
        "__lang": F.coalesce(F.concat(F.lit("l"), F.col("lang")), F.lit("")), "__source": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))})
    names = list(statistics())
    passed = named.where(~F.col("base_failed"))
    sizes = passed.groupBy("__lang", "__source").agg(F.count("*").alias("n"))
    small = F.sum(F.when(F.col("n") < least_rows, F.col("n")).otherwise(0))
    sizes = sizes.join(sizes.groupBy("__lang").agg(small.alias("of_lang")), "__lang").withColumn(
        "level", F.when(F.col("n") >= least_rows, 0).when(F.col("of_lang") >= least_rows, 1).otherwise(2))
    sizes = materialize(sizes, "group-sizes")
    rest = sizes.where("level = 2").agg(F.sum("n").alias("n")).first()["n"] or 0
    last = F.lit('["*"]') if rest >= least_rows else F.lit(None).cast("string")
    key = F.when(F.col("level") == 0, F.to_json(F.array("__lang", "__source"))).when(F.col("level") == 1, F.to_json(F.array("__lang"))).otherwise(last)
    groups = materialize(sizes.select("__lang", "__source", key.alias("g")).where("g is not null"), "groups")
    cloud = materialize(passed.join(groups, ["__lang", "__source"]).select("g", *names), "cloud")
    params = groups.join(fit_mcd(cloud, names, support, floors=FLOORS), "g").drop("g")
    judged = _distance(named.join(params, ["__lang", "__source"], "left"), names).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff))
    return judged.select(*held.columns, "d2", "kept")
