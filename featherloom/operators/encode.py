"""Binning, category encoding, filling and scaling."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions.numbers import ratio
from featherloom.functions.rows import numeric_columns
from featherloom.operators.categories import mode_of
from featherloom.operators.joins import top_entities
from featherloom.operators.ordered import group_quantiles, known_around, positions, running
from featherloom.operators.splits import hash_uniform
from featherloom.operators.stats import with_stats

# bins ------------------------------------------------------------------------------------


def _edges_below(x: Column, edges: list[Column]) -> Column:
    """Number of edges below the value; missing edges do not count."""
    return reduce(lambda a, b: a + b, [F.coalesce((x > e).cast("int"), F.lit(0)) for e in edges])


def equal_width_bin(df: DataFrame, col: str, out: str, bins: int = 10, right_closed: bool = True) -> DataFrame:
    """Bin 0 .. bins-1 between the column's minimum and maximum.

    Right-closed bins count the inner edges below the value; left-closed ones count those at or
    below it, so the maximum falls in the last bin either way.
    """
    d = with_stats(df, name="__b", lo=F.min(col), hi=F.max(col))
    lo, hi = F.col("__b.lo"), F.col("__b.hi")
    edges = [lo + (hi - lo) * i / float(bins) for i in range(1, bins)]
    x = F.col(col)
    n = F.when(x.isNotNull(), _edges_below(x, edges)) if right_closed else reduce(lambda a, b: a + b, [(x >= e).cast("int") for e in edges])
    return d.withColumn(out, n).drop("__b")


def labelled_bin(col: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins ``(edge[i], edge[i+1]]`` with labels; null outside."""
    out = F.lit(None).cast("string")
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        out = F.when((col > lo) & (col <= hi), F.lit(label)).otherwise(out)
    return out


def quantile_edges(df: DataFrame, col: str, parts: int) -> DataFrame:
    """One row with the sorted distinct quantile edges as array ``edges``."""
    probs = {f"q{i}": i / parts for i in range(parts + 1)}
    return group_quantiles(df, [], col, probs).select(F.array_sort(F.array_distinct(F.array(*probs))).alias("edges"))


def quantile_bin(df: DataFrame, col: str, out: str, parts: int = 10, source: DataFrame | None = None) -> DataFrame:
    """Right-closed quantile bins from 0, equal edges merged; the lowest value belongs to bin 0."""
    edges = quantile_edges(source if source is not None else df, col, parts).scalar()
    x = F.col(col).cast("double")
    marks = [F.get("__e", F.lit(i)) for i in range(1, parts + 1)]
    return df.withColumn("__e", edges).withColumn(out, F.when(x.isNotNull(), _edges_below(x, marks))).drop("__e")


# categories ------------------------------------------------------------------------------


def one_hot(col: str, values: list, prefix: str) -> list[Column]:
    return [(F.col(col) == v).cast("int").alias(f"{prefix}_{v}") for v in values]


def sorted_codes(train: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Dictionary of the distinct values, coded 0, 1, ... in sorted order."""
    values = train.where(F.col(col).isNotNull()).select(col).distinct()
    return positions(values, [], [col], "__p").select(col, (F.col("__p") - 1).alias(code))


def first_seen_codes(df: DataFrame, col: str, order: str, code: str = "code") -> DataFrame:
    """Dictionary coded by first appearance in ``order`` (unique)."""
    first = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(order).alias("__o"))
    return positions(first, [], ["__o"], "__p").select(col, (F.col("__p") - 1).alias(code))


def encode_with(df: DataFrame, codes: DataFrame, col: str, out: str, code: str = "code") -> DataFrame:
    """Codes of a dictionary; values it does not hold become -1."""
    d = df.join(codes.select(col, F.col(code).alias("__c")), col, "left")
    return d.withColumn(out, F.coalesce("__c", F.lit(-1).cast("long"))).drop("__c")


def keep_top(df: DataFrame, col: str, n: int, other: str = "other") -> DataFrame:
    """The n most frequent values stay, the rest becomes ``other``."""
    top = top_entities(df, col, n).select(F.col(col).alias("__kept"))
    return df.join(top, F.col(col) == F.col("__kept"), "left").withColumn(col, F.coalesce("__kept", F.lit(other))).drop("__kept")


def map_values(col: Column, mapping: dict) -> Column:
    """Literal dictionary lookup; unmapped values become null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col)


def _smoothed(n: Column, s: Column, ss: Column, gn: Column, gs: Column, gss: Column) -> Column:
    """Empirical-Bayes mean from counts, sums and sums of squares of a category and of all rows."""
    mean, overall = s / n, gs / gn
    spread, within = gss / gn - overall * overall, F.greatest(ss / n - mean * mean, F.lit(0.0))
    weight = ratio(spread * n, spread * n + within)
    return F.coalesce(weight * mean + (1 - weight) * overall, overall)


def _sums(target: str) -> list[Column]:
    y = F.col(target).cast("double")
    return [F.count(y).cast("double").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("ss")]


def target_encode_out_of_fold(df: DataFrame, col: str, target: str, fold: str, out: str) -> DataFrame:
    """Smoothed target mean of a category over the other folds.

    Sums per (value, fold) are taken once; "all but my fold" is the value's total minus its fold's
    part, so the number of folds does not add passes. A value seen in no other fold gets their mean.
    """
    part = df.groupBy(col, fold).agg(*_sums(target))
    total = part.groupBy(F.col(col).alias("__v")).agg(*[F.sum(c).alias(f"t_{c}") for c in ("n", "s", "ss")])
    by_fold = part.groupBy(F.col(fold).alias("__f")).agg(*[F.sum(c).alias(f"f_{c}") for c in ("n", "s", "ss")])
    by_fold = with_stats(by_fold, name="__g", **{c: F.sum(f"f_{c}") for c in ("n", "s", "ss")})
    rest = {c: F.col(f"t_{c}") - F.col(c) for c in ("n", "s", "ss")}
    all_rest = {c: F.col(f"__g.{c}") - F.col(f"f_{c}") for c in ("n", "s", "ss")}
    codes = part.join(total, F.col(col).eqNullSafe(F.col("__v"))).join(by_fold, F.col(fold) == F.col("__f"))
    none = rest["n"] <= 0
    value = F.when(none, all_rest["s"] / all_rest["n"]).otherwise(
        _smoothed(*[F.when(~none, rest[c]) for c in ("n", "s", "ss")], *[all_rest[c] for c in ("n", "s", "ss")]))
    codes = codes.select(F.col(col).alias("__v"), F.col(fold).alias("__f"), value.alias(out))
    return df.join(codes, F.col(col).eqNullSafe(F.col("__v")) & (F.col(fold) == F.col("__f")), "left").drop("__v", "__f")


def target_encode(train: DataFrame, df: DataFrame, col: str, target: str, out: str) -> DataFrame:
    """Smoothed target mean per category learned on all of ``train``; unseen values get the overall mean."""
    per_value = train.groupBy(F.col(col).alias("__v")).agg(*_sums(target))
    d = df.join(per_value, F.col(col).eqNullSafe(F.col("__v")), "left")
    d = with_stats(d, train.select(F.col(target).cast("double").alias("__y")), "__g",
                   n=F.count("__y").cast("double"), s=F.sum("__y"), ss=F.sum(F.col("__y") * F.col("__y")))
    g = [F.col(f"__g.{c}") for c in ("n", "s", "ss")]
    return d.withColumn(out, _smoothed(F.col("n"), F.col("s"), F.col("ss"), *g)).drop("__v", "__g", "n", "s", "ss")


def class_weights_by_bin(df: DataFrame, bin_col: str, label: str, out: str, min_zeros: int = 1) -> DataFrame:
    """Weight n0/n1 of the row's bin for class 1 when the bin has enough zeros, else 1."""
    y = F.col(label)
    counts = df.groupBy(F.col(bin_col).alias("__b")).agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    weight = F.when((y == 1) & (F.col("n0") >= min_zeros), F.col("n0") / F.col("n1")).otherwise(F.lit(1.0))
    return df.join(counts, F.col(bin_col).eqNullSafe(F.col("__b"))).withColumn(out, weight).drop("__b", "n0", "n1")


def keyword_rules(text: Column, rules: list[tuple[str, int]], default: int = -1) -> Column:
    """Ordered pattern rules on lower-case text; the last matching rule wins."""
    out = F.lit(default)
    for pattern, cluster in rules:
        out = F.when(F.coalesce(F.lower(text).rlike(pattern), F.lit(False)), F.lit(cluster)).otherwise(out)
    return out


def override_by_word(df: DataFrame, text: str, rules: DataFrame, key: str, out: str) -> DataFrame:
    """Cluster of the highest-priority rule whose word occurs in the text, by joining words with a
    rules table ``(word, priority, cluster)``; null when none does."""
    words = df.select(key, F.explode(F.array_distinct(F.split(F.lower(F.col(text)), r"\W+"))).alias("word"))
    hits = words.join(rules, "word").groupBy(key).agg(F.max_by("cluster", F.struct("priority", "cluster")).alias(out))
    return df.join(hits, key, "left")


# fills -----------------------------------------------------------------------------------


def fill_by_name(df: DataFrame, time_default: str = "2024-01-01", other_number: float | None = None) -> DataFrame:
    """Counts, sums, maxima and day columns get 0, ``*_time`` columns a date, other numbers a sentinel."""
    numbers = set(numeric_columns(df))
    out = {}
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name.startswith(("num_", "sum_", "max_", "days_")):
            out[f.name] = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif f.name.endswith("_time"):
            out[f.name] = F.coalesce(c, F.lit(time_default).cast(f.dataType))
        elif other_number is not None and f.name in numbers:
            out[f.name] = F.coalesce(c, F.lit(other_number).cast(f.dataType))
    return df.withColumns(out)


def fill_mean_with_flag(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean in place of missing values and a flag ``NA_<column>``."""
    d = with_stats(df, name="__m", **{c: F.avg(c) for c in cols})
    new = {f"NA_{c}": F.col(c).isNull().cast("int") for c in cols}
    new |= {c: F.coalesce(F.col(c).cast("double"), F.col(f"__m.{c}")) for c in cols}
    return d.withColumns(new).drop("__m")


def fill_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact median in place of missing numbers; all columns are located in one pass."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols]
    medians = group_quantiles(df.select(F.inline(F.array(*cells))), ["column"], "x", {"m": 0.5})
    found = medians.agg(F.map_from_entries(F.collect_list(F.struct("column", "m")))).scalar()  # one entry per column
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.try_element_at(found, F.lit(c))) for c in cols})


def fill_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value in place of missing ones."""
    out = df
    for c in cols:
        mode = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).agg(mode_of(c)).scalar()
        out = out.withColumn(c, F.coalesce(F.col(c), mode))
    return out


# scaling ---------------------------------------------------------------------------------


def standard_scale(df: DataFrame, cols: list[str], source: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = {f"m_{c}": F.avg(c) for c in cols} | {f"s_{c}": F.stddev_pop(c) for c in cols}
    d = with_stats(df, source, "__z", **stats)
    scaled = {
        c: F.when(F.col(f"__z.s_{c}") == 0, 0.0).otherwise(ratio(F.col(c) - F.col(f"__z.m_{c}"), F.col(f"__z.s_{c}"))) for c in cols
    }
    return d.withColumns(scaled).drop("__z")


def min_max_scale(df: DataFrame, cols: list[str], source: DataFrame | None = None) -> DataFrame:
    stats = {f"lo_{c}": F.min(c) for c in cols} | {f"hi_{c}": F.max(c) for c in cols}
    d = with_stats(df, source, "__z", **stats)
    scaled = {c: F.coalesce(ratio(F.col(c) - F.col(f"__z.lo_{c}"), F.col(f"__z.hi_{c}") - F.col(f"__z.lo_{c}")), F.lit(0.0)) for c in cols}
    return d.withColumns(scaled).drop("__z")


def uniform_quantiles(train: DataFrame, df: DataFrame, col: str, out: str) -> DataFrame:
    """Position of a value in the training distribution, from 0 to 1.

    A training value sits at the mean of its ranks; values in between are interpolated, values
    outside are clamped.
    """
    x = F.col(col).cast("double")
    freq = train.where(F.col(col).isNotNull()).groupBy(x.alias("__x")).agg(F.count(F.lit(1)).alias("__n"))
    run = running(freq, [], ["__x"], {"__hi": ("sum", F.col("__n"))}, totals=True)
    place = ratio((2 * F.col("__hi") - F.col("__n") - 1).cast("double"), (2 * (F.col("__hi_total") - 1)).cast("double"))
    marks = run.select("__x", place.alias("__u"), F.lit(0).alias("__side"))
    both = df.withColumns({"__x": x, "__side": F.lit(1)}).unionByName(marks, allowMissingColumns=True)
    d = known_around(both, [], ["__x", "__side"], {"x": F.col("__x"), "u": F.col("__u")}, F.col("__side") == 0)
    share = F.coalesce(ratio(F.col("__x") - F.col("prev_x"), F.col("next_x") - F.col("prev_x")), F.lit(0.0))
    value = (F.when(F.col("prev_x") == F.col("__x"), F.col("prev_u")).when(F.col("prev_x").isNull(), 0.0)
             .when(F.col("next_x").isNull(), 1.0).otherwise(F.col("prev_u") + share * (F.col("next_u") - F.col("prev_u"))))
    return d.where(F.col("__side") == 1).select(*df.columns, F.when(F.col("__x").isNotNull(), value).alias(out))


def shadow_features(df: DataFrame, key: str, seed: int = 0, levels: tuple[int, ...] = (200, 4)) -> DataFrame:
    """Noise columns without information: one normal and one uniform integer per number of levels."""
    u1, u2 = hash_uniform([key], seed), hash_uniform([key], seed + 1)
    new = {"shadow_normal": F.sqrt(-2 * F.ln(u1)) * F.cos(2 * math.pi * u2)}
    for i, n in enumerate(levels):
        new[f"shadow_{n}"] = F.floor(hash_uniform([key], seed + 2 + i) * n).cast("int")
    return df.withColumns(new)
