"""Joins. Broadcast or shuffle is left to Spark's own size estimates and run-time statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.operators.ordered import known_around
from featherloom.operators.stats import join_groups


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest in ``order``; combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return picked.select(*keys, *[F.col("__first")[c].alias(c) for c in rest])


def left_lookup(
    df: DataFrame, right: DataFrame, left_key: str, right_key: str, dedupe_by: list[str] | None = None
) -> DataFrame:
    """Left join on differently named keys; ``dedupe_by`` keeps one right row per key.

    Without it rows fan out, and a hot key may sit on the right. A left join cannot split that side at
    run time, an inner join can, so matched and unmatched rows are joined apart.
    """
    on = F.col(left_key) == F.col(right_key)
    if dedupe_by:
        return df.join(first_per_key(right, [right_key], dedupe_by), on, "left")
    known = right.select(right_key).distinct()
    return df.join(right, on).unionByName(df.join(known, on, "left_anti"), allowMissingColumns=True)


def full_join(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Full join on ``key``; the other columns get the part's name as a suffix."""
    out = None
    for suffix, df in parts.items():
        d = df.withColumnsRenamed({c: f"{c}_{suffix}" for c in df.columns if c != key})
        out = d if out is None else out.join(d, key, "full")
    return out


def flag_members(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """1 where the key occurs in ``members``, else 0."""
    known = members.select(key).distinct().withColumn("__hit", F.lit(1))
    return df.join(known, key, "left").withColumn(flag, F.coalesce("__hit", F.lit(0))).drop("__hit")


def keys_not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.select(key).join(other.select(key), key, "left_anti").distinct()


def top_entities(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` keys with most rows; ties go to the smaller key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def share_of_total(counts: DataFrame, keys: list[str], n: str, share: str) -> DataFrame:
    """Each row's part of its key's total."""
    totals = counts.groupBy(*keys).agg(F.sum(n).alias("__total"))
    return join_groups(counts, totals, keys).withColumn(share, F.col(n) / F.col("__total")).drop("__total")


def neighbour_sum(cells: DataFrame, x: str, y: str, value: str, out: str) -> DataFrame:
    """Per grid cell, the sum of its (up to) eight neighbours: one join instead of eight."""
    around = [F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)]
    sent = cells.select(x, y, value, F.explode(F.array(*around)).alias("o")).select(
        (F.col(x) + F.col("o.dx")).alias(x), (F.col(y) + F.col("o.dy")).alias(y), F.col(value).alias("__v"))
    got = sent.groupBy(x, y).agg(F.sum("__v").alias(out))
    return cells.join(got, [x, y], "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


SMALL_LOOKUP = 1024  # rows of a lookup table that may travel as literals


def _small(table: DataFrame, order: str) -> list | None:
    """The table's rows in order if they are at most SMALL_LOOKUP, which is checked."""
    rows = table.limit(SMALL_LOOKUP + 1).collect()
    return sorted(rows, key=lambda r: r[order]) if len(rows) <= SMALL_LOOKUP else None


def _array(rows: list, table: DataFrame, name: str) -> Column:
    kind = table.schema[name].dataType
    return F.array(*[F.lit(r[name]).cast(kind) for r in rows])


def _passed(x: Column, marks: list[float], inclusive: bool) -> Column:
    """How many of the sorted marks lie below ``x`` (or at it), by binary search in a literal array."""
    at = F.array(*[F.lit(float(m)) for m in marks])

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        up = F.get(at, mid) <= x if inclusive else F.get(at, mid) < x
        open_ = s["lo"] < s["hi"]
        return F.struct(F.when(open_ & up, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(open_ & ~up, mid).otherwise(s["hi"]).alias("hi"))

    turns = F.sequence(F.lit(1), F.lit(max(1, len(marks)).bit_length() + 1))
    return F.aggregate(turns, F.struct(F.lit(0).alias("lo"), F.lit(len(marks)).alias("hi")), step, lambda s: s["lo"])


def nearest_lookup(df: DataFrame, value: str, table: DataFrame, centre: str, cols: Sequence[str]) -> DataFrame:
    """Add the centre and ``cols`` of the table row whose centre lies closest (ties: smaller centre, of
    equal centres the one with the smallest ``cols``); null without a value.

    A table of at most SMALL_LOOKUP centres is searched row by row, without moving a row of ``df``. For a larger one both sides are
    merged into one ordered line, where the closest centre is either the last one before or the first one after a row.
    """
    got = [centre, *cols]
    if cols:
        table = table.where(F.col(centre).isNotNull()).groupBy(centre).agg(F.min(F.struct(*cols)).alias("__c")).select(centre, *[F.col("__c")[c].alias(c) for c in cols])
    table = table.where(F.col(centre).isNotNull()).select(*got)
    rows = _small(table, centre)
    if rows:
        d = df.withColumn("__x", F.col(value).cast("double"))
        d = d.withColumn("__i", F.when(F.col("__x").isNotNull(), _passed(F.col("__x"), [r[centre] for r in rows], True)))
        cells = _array(rows, table, centre)
        before, after = (F.get(cells, F.col("__i") - 1).cast("double"), F.get(cells, F.col("__i")).cast("double"))
        pick = F.when(before.isNull() | ((after - F.col("__x")) < (F.col("__x") - before)), F.col("__i")).otherwise(F.col("__i") - 1)
        d = d.withColumn("__i", F.when(F.col("__i").isNotNull(), pick))
        return d.select(*df.columns, *[F.get(_array(rows, table, c), F.col("__i")).alias(c) for c in got])
    both = df.withColumns({"__side": F.lit(1), "__x": F.col(value).cast("double")}).unionByName(
        table.select(*got).withColumns({"__side": F.lit(0), "__x": F.col(centre).cast("double")}), allowMissingColumns=True)
    d = known_around(both, [], ["__x", "__side"], {c: F.col(c) for c in got}, F.col("__side") == 0)
    lo, hi = F.col(f"prev_{centre}"), F.col(f"next_{centre}")
    use_hi = lo.isNull() | ((hi - F.col("__x")) < (F.col("__x") - lo))
    picked = [F.when(F.col("__x").isNotNull(), F.when(use_hi, F.col(f"next_{c}")).otherwise(F.col(f"prev_{c}"))).alias(c) for c in got]
    return d.where(F.col("__side") == 1).select(*df.columns, *picked)


def range_lookup(df: DataFrame, value: str, bins: DataFrame, lo: str, hi: str, label: str) -> DataFrame:
    """Label of the right-closed bin ``(lo, hi]`` a value falls in; null outside all bins.

    Bins must not overlap. The bin of a value is the first one that ends at or after it. At most SMALL_LOOKUP bins are searched row by
    row, more of them in one ordered line with the rows.
    """
    few = _small(bins.where(F.col(hi).isNotNull()).select(lo, hi, label), hi)
    if few:
        x = F.col(value).cast("double")
        d = df.withColumn("__i", F.when(x.isNotNull(), _passed(x, [r[hi] for r in few], False)))
        inside = x > F.get(_array(few, bins, lo), F.col("__i"))
        return d.select(*df.columns, F.when(inside, F.get(_array(few, bins, label), F.col("__i"))).alias(label))
    rows = df.withColumns({"__side": F.lit(0), "__x": F.col(value).cast("double")})
    ends = bins.select(F.lit(1).alias("__side"), F.col(hi).cast("double").alias("__x"),
                       F.col(lo).alias("__lo"), F.col(label).alias("__label"))
    found = known_around(rows.unionByName(ends, allowMissingColumns=True), [], ["__x", "__side"],
                         {"lo": F.col("__lo"), "label": F.col("__label")}, F.col("__side") == 1)
    return found.where(F.col("__side") == 0).select(
        *df.columns, F.when(F.col("__x") > F.col("next_lo"), F.col("next_label")).alias(label))


def checked_pairs(true: DataFrame, pred: DataFrame, key: str) -> DataFrame:
    """Inner join that refuses sides whose keys do not match one to one."""
    t = true.groupBy(key).agg(F.count("*").alias("a"))
    p = pred.groupBy(key).agg(F.count("*").alias("b"))
    bad = t.join(p, key, "full").where(~(F.col("a").eqNullSafe(1) & F.col("b").eqNullSafe(1)))
    sample = bad.select(key).head(1)
    if sample:
        raise ValueError(f"key {sample[0][0]!r} is not present exactly once on both sides")
    return true.join(pred, key)


def weighted_blend(parts: list[tuple[DataFrame, float]], key: str, score: str) -> DataFrame:
    """Weighted sum of one score column over tables joined by key."""
    total: Column | None = None
    out = None
    for i, (df, weight) in enumerate(parts):
        d = df.select(key, F.col(score).alias(f"__s{i}"))
        out = d if out is None else out.join(d, key)
        term = F.col(f"__s{i}") * F.lit(weight)
        total = term if total is None else total + term
    return out.select(key, total.alias(score))
