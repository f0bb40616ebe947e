"""Mixing sources to target weights by exact budgets over a hash-random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.llm.common import number_rows, prefix_sums
from featherloom.session import materialize

WIDE = "decimal(38,0)"


def cycle_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` (source, source_size) with ``weight``: the weights in turn, by code point order of the source, null last."""
    numbered = number_rows(sources, [F.col("source").asc_nulls_last()], "__rank", "ranked")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("__rank", F.lit(len(weights))) + 1).cast("int"))
    return numbered.withColumn("weight", turn.cast("long")).drop("__rank")


def targets(sources: DataFrame, most: int) -> DataFrame:
    """Adds ``target``: shares of the total size by ``weight``, none above ``most`` times its source's size.

    The excess goes to the other sources by weight until none is above its limit: target = min(limit, level * weight), with the level at
    which the targets add up to the total. In the order of limit / weight the sources below the level come first, so prefix sums tell for
    each source whether the level passes it.
    """
    capped = sources.withColumn("__cap", (F.col("source_size") * F.lit(most)).cast("long"))
    ratio = F.col("__cap") / F.col("weight")
    runs = materialize(prefix_sums(capped, [], [ratio.asc(), F.col("source").asc_nulls_last()], {"__caps": "__cap", "__weights": "weight"}, "levels"), "levels")
    whole = runs.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    total, weight = whole["t"] or 0, whole["w"] or 0

    def wide(c: Column) -> Column:
        return c.cast(WIDE)

    # all limits up to here, and the rest at this source's level, stay within the total
    left = wide(F.lit(weight)) - wide(F.col("__weights"))
    full = (wide(F.col("__cap")) * left) <= (wide(F.lit(total)) - wide(F.col("__caps"))) * wide(F.col("weight"))
    runs = runs.withColumn("__full", full)
    rest = runs.where("__full").agg(F.sum("__cap").alias("c"), F.sum("weight").alias("w")).first()
    over, share = total - (rest["c"] or 0), max(weight - (rest["w"] or 0), 1)
    level = (F.lit(over) * F.col("weight")).cast("double") / F.lit(share)
    return runs.withColumn("target", F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(level)).drop(
        "__cap", "__caps", "__weights", "__full")


def plan(rows: DataFrame, most: int = 3, seed: int = 11, weights: tuple[int, ...] = (1, 2, 3), ties: list[str] | None = None) -> DataFrame:
    """How much of each row the mix takes. ``rows``: doc_id, source, size and further columns; ``size`` null counts as 0.

    Adds ``source_size``, ``target``, ``epochs`` (whole copies), ``part`` (size units of one more, cut-off copy) and ``before`` (size of the
    source's rows that come earlier in the random order). The order is that of an MD5 of doc_id and seed, so reruns agree; every source takes
    floor(target / source_size) copies of all its rows and cuts the next copy where its budget, rounded to a whole unit, is used up.
    A source without any size takes nothing. Rows with null doc_id or source are rows like others.
    """
    ties = ties or ["doc_id", "size"]
    rows = rows.withColumn("size", F.coalesce("size", F.lit(0)).cast("long")).withColumn(
        "__key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))))
    rows = rows.drop("source_size", "target", "epochs", "part", "before", "weight")
    sums = materialize(prefix_sums(rows, ["source"], [F.col("__key"), *[F.col(c).asc_nulls_first() for c in ties]], {"before": "size"}, "mix"), "mix")
    sources = targets(cycle_weights(sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights), most)
    sources = materialize(sources, "targets").withColumnRenamed("source", "__source")
    joined = sums.join(sources, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "__key", "weight")
    budget = F.round("target").cast("long")
    some = F.col("source_size") > 0
    joined = joined.withColumn("epochs", F.when(some, F.floor(budget / F.col("source_size")).cast("long")).otherwise(F.lit(0)))
    left = budget - F.col("epochs") * F.col("source_size")
    return joined.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before"))).cast("long"))


def mixed(docs: DataFrame, size: Column, most: int = 3, seed: int = 11) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the plan takes it.

    Documents stay whole: the one at a source's cut is taken once more if at least half of it lies before the cut. Rows without size are
    in no mix. The plan runs over narrow rows; texts are written once with a row id and joined by it.
    """
    held = materialize(docs.withColumn("__rid", F.monotonically_increasing_id()), "to-mix")
    narrow = plan(held.select("__rid", "doc_id", "source", size.alias("size")), most, seed, ties=["doc_id", "size", "__rid"])
    again = F.when((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size")), 1).otherwise(0)
    times = narrow.where("size > 0").select(F.col("__rid").alias("__r"), (F.col("epochs") + again).cast("int").alias("__times")).where("__times > 0")
    return held.join(times, F.col("__rid") == F.col("__r")).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)
