"""Structured Streaming jobs. They use the batch definitions of the same operators, write to file
sinks, and keep their progress in the shared checkpoint folder, so a lost executor or a restarted
driver continues where the job stopped."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from featherloom.functions.strings import int_between
from featherloom.operators.filters import drop_header_lines
from featherloom.operators.ordered import previous
from featherloom.plans.clicklog import predict
from featherloom.session import materialize


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_files(stream: DataFrame, path: str, progress: str, kind: str = "parquet", **options: str) -> None:
    """Process everything that is new since the last run, append the results to files, and stop.

    ``progress`` is the checkpoint folder that belongs to ``path``: give the same pair to every run, and a new pair for a new sink.
    """
    query = (stream.writeStream.format(kind).options(**options).option("checkpointLocation", progress)
             .outputMode("append").trigger(availableNow=True).start(path))
    query.awaitTermination()


def run_updates(stream: DataFrame, path: str, progress: str) -> None:
    """Process everything that is new and write the changed result rows of every micro-batch under ``path``.

    Groups that are still open are written too, so nothing waits for a watermark to pass; :func:`latest` gives each group's last state.
    A micro-batch that is repeated after a failure overwrites its own folder.
    """
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = (stream.writeStream.option("checkpointLocation", progress).outputMode("update")
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The last written row of every group under ``path``."""
    rest = [f.name for f in schema.fields if f.name not in keys]
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__r"))
    return last.select(*keys, *[F.col("__r")[c].alias(c) for c in rest]).select(*[f.name for f in schema.fields])


def filter_lines(lines: DataFrame, fields: list[str], first_field: str, field: str, low: int, high: int, drop: list[str]) -> DataFrame:
    """Tab-separated lines without the header, kept where ``low < int(field) < high``, without some fields.

    Works on a stream and on a batch.
    """
    body = drop_header_lines(lines, first_field)
    parts = F.split("value", "\t", -1)
    cols = {f: F.get(parts, F.lit(i)) for i, f in enumerate(fields)}
    rest = [F.coalesce(c, F.lit("")) for f, c in cols.items() if f not in drop]
    return body.where(int_between(cols[field], low, high)).select(F.concat_ws("\t", *rest).alias("value"))


def score_stream(model: PipelineModel, rows: DataFrame, key: str) -> DataFrame:
    return predict(model, rows, key)


def hourly_bars(events: DataFrame, ts: str, tie: str, value: str, late: str = "10 minutes") -> DataFrame:
    """Count and open/high/low/close per hour; an hour's state is dropped once the watermark has passed it."""
    when = F.struct(ts, tie)
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("w")).agg(
        F.count("*").alias("n"), F.min_by(value, when).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
        F.max_by(value, when).alias("close")).select(F.col("w.start").alias("start"), "n", "open", "high", "low", "close")


def enrich(events: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Stream joined to a static table."""
    return events.join(dimension, key)


def last_seen(events: DataFrame, key: str, ts: str, late: str = "10 minutes") -> DataFrame:
    """Last event time per key and day; combined on the map side, so a hot key is no bottleneck."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), key).agg(F.max(ts).alias("last_seen")).select(
        F.col("w.start").alias("day"), key, "last_seen")


def daily_counts(events: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """Events per key and day: the panes of :func:`sliding_from_panes`. An event touches the state of one pane."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), key).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("day"), key, "n")


def sliding_from_panes(panes: DataFrame, key: str, days: int) -> DataFrame:
    """Counts per key over windows of ``days`` days, one starting each day, from daily panes (day, key, n).

    A pane is part of ``days`` windows, so panes are copied that often, events never. Windows that are still open count what has come so far.
    """
    ends = F.explode(F.transform(F.sequence(F.lit(1), F.lit(days)), lambda i: F.col("day") + F.make_dt_interval(i)))
    return panes.select(key, "n", ends.alias("end")).groupBy("end", key).agg(F.sum("n").alias("n"))


def _gap_rows(rows: DataFrame, key: str, event_id: str) -> DataFrame:
    """Gaps of held rows to the row before, the last one already given out included; cut over tasks like any ordered operator."""
    d = previous(rows, [key], ["us", event_id], {"__us": F.col("us")})
    return d.where("held").select(key, event_id, ((F.col("us") - F.col("__us")) / 1e6).alias("gap_seconds"))


def run_event_gaps(events: DataFrame, path: str, progress: str, key: str, ts: str, event_id: str, late_seconds: float = 600.0) -> None:
    """Seconds from a key's previous event to each event, across micro-batches and runs.

    Events wait until the newest event is ``late_seconds`` ahead of them, so events that come out of order by less are put in order.
    What waits, and the last event given out per key, is written as ``path``/state; a repeated micro-batch overwrites its own folders.
    An event that comes later than that has no gap if all of its key's events given out so far are newer.
    """
    def step(batch_rows: DataFrame, batch: int) -> None:
        spark = batch_rows.sparkSession
        new = batch_rows.select(key, event_id, F.unix_micros(ts).alias("us"), F.lit(True).alias("held"))
        if batch:
            new = new.unionByName(spark.read.schema(new.schema).parquet(f"{path}/state/batch={batch - 1}"))
        rows = materialize(new, "gap-rows")
        newest = rows.agg(F.max("us").alias("m")).first()["m"]
        mark = F.lit(newest - int(late_seconds * 1e6) if newest is not None else 0)
        ready = rows.where((F.col("us") <= mark) | ~F.col("held"))
        _gap_rows(ready, key, event_id).write.mode("overwrite").parquet(f"{path}/gaps/batch={batch}")
        given = ready.groupBy(key).agg(F.max(F.struct("us", event_id)).alias("l")).select(key, f"l.{event_id}", "l.us", F.lit(False).alias("held"))
        rows.where((F.col("us") > mark) & F.col("held")).unionByName(given).write.mode("overwrite").parquet(f"{path}/state/batch={batch}")

    query = events.writeStream.option("checkpointLocation", progress).trigger(availableNow=True).foreachBatch(step).start()
    query.awaitTermination()


def event_gaps_now(spark: SparkSession, path: str, key: str, event_id: str) -> DataFrame:
    """All gaps given out so far and, as of now, those of the events that still wait."""
    gaps = spark.read.parquet(f"{path}/gaps")
    states = spark.read.parquet(f"{path}/state")
    waiting = states.where(F.col("batch") == states.agg(F.max("batch")).scalar()).drop("batch")
    return gaps.drop("batch").unionByName(_gap_rows(waiting, key, event_id))


# keyed state with timers -------------------------------------------------------------------

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_GAP = Row("key", "pane", "id", "us", "gap_seconds", "head", "late")


class PaneGaps(StatefulProcessor):
    """Holds a key's events of one pane until the watermark has passed the pane's end, then gives them out with their gaps.

    Events come as (key, pane, id, us); the first event of a pane has no gap yet (``head``), as the event before lies in another pane.
    """

    def __init__(self, waiting: T.StructType, pane_us: int):
        self.schema, self.pane_us = waiting, pane_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        pane = key[1]
        end_ms = None if pane is None else -(-(pane + 1) * self.pane_us // 1000)
        if end_ms is None or end_ms <= timerValues.getCurrentWatermarkInMs():
            for r in rows:
                yield _GAP(key[0], pane, r[2], r[3], None, False, True)
            return
        self.waiting.appendList([(r[3], r[2]) for r in rows])
        self.handle.registerTimer(end_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before = None
        for us, i in sorted((r[0], r[1]) for r in self.waiting.get()):
            yield _GAP(key[0], key[1], i, us, None if before is None else (us - before) / 1e6, before is None, False)
            before = us
        self.waiting.clear()

    def close(self) -> None:
        pass


def run_pane_gaps(events: DataFrame, path: str, progress: str, key: str, ts: str, event_id: str, late_seconds: int = 600,
                  pane_seconds: int = 86400) -> None:
    """Seconds from a key's previous event to each event, with keyed state and timers instead of rewritten state files.

    State is kept per (key, pane of ``pane_seconds``) in the state store and dropped when the pane's timer fires, so a batch touches the panes
    its events fall into and nothing else, and a hot key is spread over its panes. Take panes short enough for one key's events of one pane
    to fit a task. An event that comes after its pane was given out, or that has no time, gets no gap and is no other event's predecessor
    (``late``). Read the result with :func:`pane_gaps_now`.
    """
    spark, fields = events.sparkSession, events.schema
    pane_us = pane_seconds * 1_000_000
    us = F.unix_micros(ts)
    # the time column itself stays behind: with it Spark would drop late rows before the processor sees them
    rows = events.withWatermark(ts, f"{late_seconds} seconds").select(
        F.col(key).alias("key"), F.floor(us / F.lit(pane_us)).alias("pane"), F.col(event_id).alias("id"), us.alias("us"))
    waiting = T.StructType([T.StructField("us", T.LongType()), T.StructField("id", fields[event_id].dataType)])
    out = T.StructType([T.StructField("key", fields[key].dataType), T.StructField("pane", T.LongType()), T.StructField("id", fields[event_id].dataType),
                        T.StructField("us", T.LongType()), T.StructField("gap_seconds", T.DoubleType()), T.StructField("head", T.BooleanType()),
                        T.StructField("late", T.BooleanType())])
    old = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        run_to_files(rows.groupBy("key", "pane").transformWithState(PaneGaps(waiting, pane_us), out, "Append", "EventTime"), path, progress)
    finally:
        spark.conf.set(_STORE, old)


def pane_gaps_now(spark: SparkSession, path: str, progress: str, key: str, event_id: str) -> DataFrame:
    """All gaps as of now: those of closed panes, and of events that still wait in the state store.

    The first event of each pane is linked to the last one of the key's pane before; that pass handles one row per (key, pane).
    """
    given = spark.read.parquet(path)
    held = spark.read.format("statestore").option("stateVarName", "waiting").load(progress)
    held = held.select("key.key", "key.pane", "list_element.id", "list_element.us")
    w = Window.partitionBy("key", "pane").orderBy("us", "id")
    held = held.withColumn("__us", F.lag("us").over(w)).select(
        "key", "pane", "id", "us", ((F.col("us") - F.col("__us")) / 1e6).alias("gap_seconds"), F.col("__us").isNull().alias("head"), F.lit(False).alias("late"))
    rows = given.unionByName(held)
    ends = rows.where(~F.col("late")).groupBy("key", "pane").agg(
        F.min_by("id", F.struct("us", "id")).alias("id"), F.min("us").alias("us"), F.max("us").alias("last"))
    heads = previous(ends, ["key"], ["pane"], {"__us": F.col("last")})
    heads = heads.select("key", "id", ((F.col("us") - F.col("__us")) / 1e6).alias("gap_seconds"))
    rest = rows.where(~F.col("head")).select("key", "id", "gap_seconds")
    return rest.unionByName(heads).withColumnsRenamed({"key": key, "id": event_id})
