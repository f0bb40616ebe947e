"""Exact quantiles of whole columns: a sketch brackets each one, and only values inside the brackets are counted."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # a sketch misses a rank by at most 1 / ACCURACY of the rows
INSIDE = 1 << 20  # distinct values of a bracket that are ranked at once


def _sketch(values: dict[int, Column], wanted: list[tuple[int, float, float]], rows: DataFrame) -> list[tuple[float, float]]:
    """Values at the two shares of each (column, share, share), from one pass of mergeable sketches."""
    aggs = [F.percentile_approx(values[c], [a, b], ACCURACY).alias(f"b{i}") for i, (c, a, b) in enumerate(wanted)]
    got = rows.agg(*aggs).first()
    return [tuple(got[f"b{i}"]) for i in range(len(wanted))]


def column_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """For each column the values at the given shares, exact, with linear interpolation between neighbours; nulls do not count.

    A first pass of sketches gives, for each share, two values between which the searched ranks lie. A second pass counts the rows below and
    inside; only the values inside are shuffled, each once per task with its count. Brackets that still hold more than INSIDE rows of different
    values are sketched again, each time within the bracket, so no task ranks an unbounded part. A bracket that misses its ranks is widened. The
    result is one number per share, so it is returned to the driver. A column without values gives None.
    """
    names = list(wanted)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    value = {i: F.col(f"c{i}") for i in range(len(names))}
    jobs = [(i, p) for i, c in enumerate(names) for p in wanted[c]]
    head = rows.agg(*[F.count(value[i]).alias(f"n{i}") for i in value], *[F.min(value[i]).alias(f"lo{i}") for i in value],
                    *[F.max(value[i]).alias(f"hi{i}") for i in value],
                    *[F.percentile_approx(value[i], [max(0.0, p - 2 / ACCURACY), min(1.0, p + 2 / ACCURACY)], ACCURACY).alias(f"b{j}") for j, (i, p) in enumerate(jobs)]).first()
    found: dict[int, float | None] = {}
    rank, bracket = {}, {}
    for j, (i, p) in enumerate(jobs):
        n = head[f"n{i}"]
        if not n:
            found[j] = None
            continue
        at = p * (n - 1)
        rank[j] = (math.floor(at), math.ceil(at), at - math.floor(at))
        lo, hi = head[f"b{j}"]
        bracket[j] = (head[f"lo{i}"] if p <= 2 / ACCURACY else lo, head[f"hi{i}"] if p >= 1 - 2 / ACCURACY else hi)
    while bracket:
        counts = rows.agg(*[x for j, (lo, hi) in bracket.items() for x in (
            F.count_if(value[jobs[j][0]] < lo).alias(f"below{j}"), F.count_if(value[jobs[j][0]].between(lo, hi)).alias(f"inside{j}"))]).first()
        ready, narrow = {}, {}
        for j, (lo, hi) in bracket.items():
            below, inside = counts[f"below{j}"], counts[f"inside{j}"]
            first, last, part = rank[j]
            i = jobs[j][0]
            if below > first or below + inside <= last:
                bracket[j] = (head[f"lo{i}"] if below > first else lo, head[f"hi{i}"] if below + inside <= last else hi)
            elif lo == hi:
                found[j] = lo
            elif inside <= INSIDE:
                ready[j] = below
            else:
                narrow[j] = (below, inside)
        if narrow:
            shares = {j: (max(0.0, (rank[j][0] - below) / inside - 2 / ACCURACY), min(1.0, (rank[j][1] - below + 1) / inside + 2 / ACCURACY)) for j, (below, inside) in narrow.items()}
            inner = {j: F.when(value[jobs[j][0]].between(*bracket[j]), value[jobs[j][0]]) for j in narrow}
            for j, cut in zip(narrow, _sketch(inner, [(j, *shares[j]) for j in narrow], rows)):
                if cut == bracket[j]:  # two values hold nearly all rows: no narrower bracket, and few values to rank
                    ready[j] = narrow[j][0]
                else:
                    bracket[j] = cut
        if ready:
            picked = F.array(*[F.when(value[jobs[j][0]].between(*bracket[j]), F.struct(F.lit(j).alias("j"), value[jobs[j][0]].alias("v"))) for j in ready])
            inside = rows.select(F.explode(F.array_compact(picked)).alias("x")).groupBy("x.j", "x.v").agg(F.count("*").alias("n"))
            upto = F.sum("n").over(Window.partitionBy("j").orderBy("v"))
            below, first, last = (F.element_at(F.create_map(*[F.lit(y) for j in ready for y in (j, at(j))]), F.col("j")) for at in (
                lambda j: ready[j], lambda j: rank[j][0], lambda j: rank[j][1]))
            end = below + F.col("upto")
            start = end - F.col("n")
            ranked = inside.withColumn("upto", upto).where(((start <= first) & (first < end)) | ((start <= last) & (last < end)))
            ends: dict[int, list[float]] = {}
            for r in ranked.orderBy("j", "v").collect():  # two rows a share at most
                ends.setdefault(r["j"], []).append(r["v"])
            for j, v in ends.items():
                found[j] = v[0] + (v[-1] - v[0]) * rank[j][2]
        bracket = {j: b for j, b in bracket.items() if j not in found}
    out: dict[str, list[float | None]] = {c: [] for c in names}
    for j, (i, _) in enumerate(jobs):
        out[names[i]].append(found[j])
    return out
