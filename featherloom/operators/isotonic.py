"""Isotonic regression without gathering the pooled points.

The fit of a score is the slope of the greatest convex minorant of the points (rows so far, label sum so far), that is, of their lower hull.
A hull is mergeable: chunks of the ordered scores give local hulls, and only their corners can be corners of the whole. A corner of the
whole with supporting slope m is a corner of its local hull with that slope, so the work can be cut by slope: a task that gets, of every
chunk, the corners whose slopes meet its slope range finds the pieces of the whole hull in that range, exactly and on its own. Slope
ranges hold a bounded number of local corners plus one or two per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.operators.ordered import CHUNK_ROWS, known_around, running
from featherloom.session import materialize

CORNERS = 1 << 18  # local corners per slope range


def _lower_hull(n: list, s: list) -> list[int]:
    """Indices of the corners of the lower hull of points in ascending ``n``; points on an edge are no corners."""
    kept: list[int] = []
    for i in range(len(n)):
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            if (s[b] - s[a]) * (n[i] - n[b]) < (s[i] - s[b]) * (n[b] - n[a]):
                break
            kept.pop()
        kept.append(i)
    return kept


def _exact(values) -> list:
    """Whole numbers as Python integers, whose products are exact."""
    out = values.tolist()
    return [int(v) for v in out] if all(float(v).is_integer() for v in out) else out


def _chunk_hull(rows):
    import numpy as np

    rows = rows.sort_values("n")
    kept = _lower_hull(rows["n"].tolist(), _exact(rows["s"]))
    out = rows.iloc[kept]
    slope = np.diff(out["s"].to_numpy("float64")) / np.diff(out["n"].to_numpy("float64"))
    return out.assign(lo=np.concatenate([[-np.inf], slope]), hi=np.concatenate([slope, [np.inf]]))


def _by_range(cuts: list[float]):
    """Each corner once for every slope range that its slopes meet."""

    def run(batches):
        import numpy as np

        for rows in batches:
            first = np.searchsorted(cuts, rows["lo"].to_numpy(), "left")
            last = np.searchsorted(cuts, rows["hi"].to_numpy(), "right")
            times = last - first + 1
            out = rows.drop(columns=["lo", "hi"]).loc[rows.index.repeat(times)]
            step = np.arange(len(out)) - np.repeat(np.cumsum(times) - times, times)
            yield out.assign(part=np.repeat(first, times) + step)

    return run


def _range_edges(cuts: list[float]):
    def run(rows):
        import numpy as np

        rows = rows.sort_values("n")
        at = rows["part"].iloc[0]
        low = cuts[at - 1] if at else -np.inf
        high = cuts[at] if at < len(cuts) else np.inf
        out = rows.iloc[_lower_hull(rows["n"].tolist(), _exact(rows["s"]))]
        n, s = out["n"].to_numpy(), out["s"].to_numpy("float64")
        slope = np.diff(s) / np.diff(n)
        mine = (slope >= low) & (slope < high)
        edges = out.iloc[1:][mine]
        return edges.assign(value=slope[mine])

    return run


def fit(df: DataFrame, score: str, label: str, keys: list[str] | None = None, weight: Column | None = None,
        chunk_rows: int = CHUNK_ROWS, corners: int = CORNERS) -> DataFrame:
    """The non-decreasing step function of the score with the least squared error, per key: ``(keys, score, fitted)``, one row per score.

    Rows with a null or NaN score or label, or a weight that is null or not above 0, do not count; ties of the score are one point. An empty table fits
    nothing. Whole-number labels are pooled exactly, others with rounding errors of doubles.
    """
    keys = list(keys or [])
    w = (weight if weight is not None else F.lit(1)).cast("double")
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    d = df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], x.alias("__x"), y.alias("__y"), w.alias("__w"))
    d = d.where("NOT isnan(__x) AND NOT isnan(__y) AND __w > 0 AND __x IS NOT NULL AND __y IS NOT NULL AND NOT isnan(__w)")
    ks = [f"__k{i}" for i in range(len(keys))]
    points = d.groupBy(*ks, "__x").agg(F.sum("__w").alias("__n"), F.sum(F.col("__w") * F.col("__y")).alias("__s"))
    line = running(points, ks, ["__x"], {"n": ("sum", F.col("__n")), "s": ("sum", F.col("__s")), "at": ("count", F.lit(1))}, chunk_rows=chunk_rows)
    line = materialize(line, "isotonic-points")
    # the hull starts at (0, 0) of every key
    start = line.where("at = 1").select(*ks, F.lit(0.0).alias("n"), F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("chunk"))
    chunked = line.select(*ks, "n", "s", F.floor((F.col("at") - 1) / chunk_rows).cast("long").alias("chunk")).unionByName(start)
    key_fields = [f.simpleString().replace(":", " ", 1) for f in chunked.select(*ks).schema.fields]
    shape = ", ".join([*key_fields, "n double", "s double", "chunk long", "lo double", "hi double"])
    local = materialize(chunked.groupBy(*ks, "chunk").applyInPandas(_chunk_hull, shape), "isotonic-corners")
    # slope cuts: quantiles of the local slopes, one number per `corners` of them
    parts = -(-local.count() // corners)
    inner = local.where("hi < double('infinity')")
    cuts = sorted(set(inner.approxQuantile("hi", [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []

    shape = ", ".join([*key_fields, "n double", "s double", "part long"])
    spread = local.select(*ks, "n", "s", "lo", "hi").mapInPandas(_by_range(cuts), shape)
    shape = ", ".join([*key_fields, "n double", "value double"])
    edges = spread.groupBy(*ks, "part").applyInPandas(lambda rows: _range_edges(cuts)(rows)[[*ks, "n", "value"]], shape)
    # an edge ends at the last score of its block: every score takes the next end at or after it
    ends = edges.select(*[F.col(k).alias(f"__e{k}") for k in ks], F.col("n").alias("__end"), "value")
    on = F.col("n") == F.col("__end")
    for k in ks:
        on = on & F.col(k).eqNullSafe(F.col(f"__e{k}"))
    marked = line.join(ends, on, "left").select(*ks, "__x", "value")
    out = known_around(marked, ks, ["__x"], {"value": F.col("value")}, F.col("value").isNotNull(), chunk_rows=chunk_rows)
    return out.select(*[F.col(k).alias(n) for k, n in zip(ks, keys)], F.col("__x").alias(score), F.col("next_value").alias("fitted"))


def predict(fitted: DataFrame, df: DataFrame, score: str, out: str, keys: list[str] | None = None) -> DataFrame:
    """``df`` with the fitted value of its score: between two fitted scores on the line between them, beyond the ends the end value.

    Each distinct score is placed once among the fitted ones and joined back. Null or NaN scores and keys without a fit get null.
    """
    keys = list(keys or [])
    ks = [f"__k{i}" for i in range(len(keys))]
    named = [F.col(k).alias(n) for k, n in zip(keys, ks)]
    x = F.col(score).cast("double")
    asked = df.select(*named, x.alias("__x")).where("__x IS NOT NULL AND NOT isnan(__x)").distinct().withColumn("fitted", F.lit(None).cast("double"))
    known = fitted.select(*named, x.alias("__x"), "fitted")
    here = known.unionByName(asked).groupBy(*ks, "__x").agg(F.max("fitted").alias("fitted"))
    d = known_around(here, ks, ["__x"], {"x": F.col("__x"), "y": F.col("fitted")}, F.col("fitted").isNotNull())
    wide = F.col("next_x") - F.col("prev_x")
    between = F.col("prev_y") + (F.col("next_y") - F.col("prev_y")) * ((F.col("__x") - F.col("prev_x")) / wide)
    value = F.when(wide > 0, between).otherwise(F.coalesce("prev_y", "next_y"))
    table = d.select(*[F.col(k).alias(f"__r{k}") for k in ks], F.col("__x").alias("__rx"), value.alias(out))
    on = x == F.col("__rx")
    for k, n in zip(keys, ks):
        on = on & df[k].eqNullSafe(F.col(f"__r{n}"))
    return df.join(table, on, "left").select(*df.columns, out)


def out_of_fold(df: DataFrame, score: str, label: str, fold: str, out: str) -> DataFrame:
    """``df`` with the calibrated score from the fit of all other folds.

    Scores are counted per fold first; every count goes to the other folds' fits, so counts are copied, not rows.
    """
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    usable = df.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    counts = usable.groupBy(F.col(fold).alias("__own"), x.alias("__score"), y.alias("__label")).agg(F.count("*").alias("__rows"))
    # struct items, so that a null fold is a fold too
    folds = df.agg(F.collect_set(F.struct(F.col(fold).alias("f"))).alias("f")).scalar()
    others = counts.withColumn("__other", F.explode(F.array_except(folds, F.array(F.struct(F.col("__own").alias("f"))))))
    train = others.withColumn("__fold", F.col("__other")["f"]).groupBy("__fold", "__score", "__label").agg(F.sum("__rows").alias("__rows"))
    fits = fit(train, "__score", "__label", ["__fold"], F.col("__rows"))
    d = df.withColumns({"__fold": F.col(fold), "__score": x})
    return predict(fits, d, "__score", out, ["__fold"]).drop("__fold", "__score")
