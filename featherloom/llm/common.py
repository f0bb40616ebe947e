"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featherloom.session import materialize, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than space and U+0009 to U+000D; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes the shuffle files of each write as soon as that write has ended."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession, size: str = "1m") -> Iterator[None]:
    """Inside, rows go to Python in Arrow batches of about ``size``: a large row goes alone, and neither side holds a whole partition."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and its path, for :func:`delete_table`."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing will read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ordered(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` dealt into ranges of ``order``, sorted within them and written, with ``__part`` and ``__at`` (place within the range).

    Rows that tie in every order column are interchangeable; a running row id as last range column still spreads them over ranges.
    """
    n = partitions(df.sparkSession)
    df = df.withColumn("__salt", F.monotonically_increasing_id())
    ranged = df.repartitionByRange(n, *order, F.col("__salt")).sortWithinPartitions(*order, F.col("__salt")).drop("__salt")
    at = F.monotonically_increasing_id()
    return materialize(ranged.withColumn("__id", at), label).withColumns(
        {"__part": F.shiftright("__id", 33).cast("int"), "__at": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__id")


def number_rows(df: DataFrame, order: list[Column], name: str, label: str = "numbered") -> DataFrame:
    """Adds ``name``: the row's place in the whole order, from 0, without gaps and without one task holding all rows."""
    placed = ordered(df, order, label)
    # one row per range, so at most as many as there are shuffle partitions: small enough to broadcast
    firsts = placed.groupBy("__part").agg(F.count("*").alias("__n")).withColumn(
        "__first", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))).select(
        "__part", F.coalesce("__first", F.lit(0)).alias("__first"))
    return placed.join(F.broadcast(firsts), "__part").withColumn(name, F.col("__first") + F.col("__at")).drop("__part", "__at", "__first")


def prefix_sums(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, str], label: str = "prefix") -> DataFrame:
    """Adds, for each ``new: value`` of ``sums``, the sum of ``value`` over the rows of the same keys that come before the row.

    A key's rows are dealt over ranges of the order, so a hot key is cut over many tasks: running sums inside a range, plus one
    total per (key, range) summed over the earlier ranges. Null keys are a key.
    """
    placed = ordered(df, [F.col(k).asc_nulls_last() for k in keys] + order, label)
    inside = Window.partitionBy("__part", *keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    totals = placed.groupBy("__part", *keys).agg(*[F.sum(v).alias(f"__t_{new}") for new, v in sums.items()]).select(
        "__part", *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"__t_{new}").over(earlier if keys else earlier_all()), zero).alias(f"__b_{new}") for new in sums])
    same = F.col("a.__part") == F.col("b.__part")
    for k in keys:
        same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.__k_{k}"))
    run = placed.withColumns({f"__r_{new}": F.coalesce(F.sum(v).over(inside), zero) for new, v in sums.items()})
    joined = run.alias("a").join(totals.alias("b"), same)
    kept = [F.col(f"a.{c}") for c in placed.columns if c not in ("__part", "__at")]
    return joined.select(*kept, *[(F.col(f"__r_{new}") + F.col(f"__b_{new}")).alias(new) for new in sums])


def earlier_all() -> Window:
    """Over one row per range."""
    return Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
