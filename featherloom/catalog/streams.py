"""Structured Streaming jobs (ST), run to completion over the stored tables."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from featherloom.catalog.base import Book, rnd
from featherloom.operators.models import fit_on, logistic_with_medians
from featherloom.plans import clicklog
from featherloom.session import scratch_path
from featherloom.streaming import jobs

book = Book()


def _result(t, stream, label):
    path = scratch_path(t.spark, label)
    jobs.run_to_files(stream, path, f"{path}-progress")
    return t.spark.read.schema(stream.schema).parquet(path)


def _latest(t, stream, label, keys):
    path = scratch_path(t.spark, label)
    jobs.run_updates(stream, path, f"{path}-progress")
    return jobs.latest(t.spark, path, stream.schema, keys)


def _events(t, files_per_batch=None):
    """The whole table as a stream of files."""
    path = scratch_path(t.spark, "events_in")
    t.events.write.parquet(path)
    return jobs.read_files(t.spark, path, t.events.schema, files_per_batch)


@book.add("st1_filter_lines", """
SELECT o_orderkey || chr(9) || coalesce(if1, '') AS value FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' || (o_custkey % 60) || ' ' WHEN 2 THEN (o_custkey % 60) || '.0' ELSE CAST(o_custkey % 60 AS VARCHAR) END AS if1 FROM orders)
WHERE regexp_full_match(if1, '\\s*[+-]?\\d+\\s*') AND TRY_CAST(trim(if1) AS BIGINT) > 20 AND TRY_CAST(trim(if1) AS BIGINT) < 40""")
def _(t):
    path = scratch_path(t.spark, "lines_in")
    n, k = (F.col("o_custkey") % 60).cast("string"), F.col("o_orderkey") % 5
    if1 = F.when(k == 0, "").when(k == 1, F.concat(F.lit(" "), n, F.lit(" "))).when(k == 2, F.concat(n, F.lit(".0"))).otherwise(n)
    t.orders.select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus", if1).alias("value")).write.text(path)
    lines = t.spark.readStream.text(path)
    kept = jobs.filter_lines(lines, ["id", "label", "if1"], "id", "if1", 20, 40, drop=["label"])
    return _result(t, kept, "lines_out")


@book.add("st2_filter_and_score")
def _(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).cast("string").alias("if1"), F.col("o_totalprice").alias("if2"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    model = logistic_with_medians(["if2"], "label").fit(rows)
    path = scratch_path(t.spark, "score_in")
    rows.drop("label").write.parquet(path)
    stream = jobs.read_files(t.spark, path, rows.drop("label").schema)
    return _result(t, jobs.score_stream(model, clicklog.keep_rows(stream), "id"), "score_out").withColumn("prob", rnd("prob"))


@book.add("st2_filter_and_score_line", """
WITH r AS (SELECT o_orderkey AS id, o_custkey % 50 AS if1, day(o_orderdate)::DOUBLE AS x, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM orders),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r)
SELECT id, round(a + b * x, 6) AS prob FROM r, m WHERE if1 > 20 AND if1 < 40""")
def _(t):
    rows = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).cast("string").alias("if1"),
                           F.dayofmonth("o_orderdate").cast("double").alias("if3"), (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    model = fit_on(["if3"], LinearRegression(featuresCol="features", labelCol="label", solver="normal"), rows)
    path = scratch_path(t.spark, "score_in")
    rows.drop("label").write.parquet(path)
    stream = jobs.read_files(t.spark, path, rows.drop("label").schema)
    return _result(t, jobs.score_stream(model, clicklog.keep_rows(stream), "id"), "score_out").withColumn("prob", rnd("prob"))


@book.add("st3_hourly_bars", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS start, count(*) AS n, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close
FROM events GROUP BY date_trunc('hour', ts)""")
def _(t):
    d = _latest(t, jobs.hourly_bars(_events(t), "ts", "event_id", "value"), "bars_out", ["start"])
    return d.withColumn("start", F.date_format("start", "yyyy-MM-dd HH"))


@book.add("st4_stream_static_enrichment", """
SELECT event_id, value, weight FROM events JOIN (SELECT event_type, count(*) AS weight FROM events GROUP BY 1) USING (event_type)""")
def _(t):
    dimension = t.events.groupBy("event_type").agg(F.count("*").alias("weight"))
    return _result(t, jobs.enrich(_events(t), dimension, "event_type").select("event_id", "value", "weight"), "enriched_out")


@book.add("st5_last_seen", """
SELECT user_id, epoch_us(max(ts)) AS last_us FROM events GROUP BY 1""")
def _(t):
    d = _latest(t, jobs.last_seen(_events(t), "user_id", "ts"), "seen_out", ["day", "user_id"])
    return d.groupBy("user_id").agg(F.unix_micros(F.max("last_seen")).alias("last_us"))


@book.add("st5_event_gaps", """
SELECT user_id, event_id, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS gap_seconds FROM events""")
def _(t):
    path = scratch_path(t.spark, "gaps_out")
    jobs.run_event_gaps(_events(t), path, f"{path}-progress", "user_id", "ts", "event_id")
    d = jobs.event_gaps_now(t.spark, path, "user_id", "event_id")
    return d.withColumn("gap_seconds", rnd("gap_seconds"))


@book.add("st5_pane_gaps", """
SELECT user_id, event_id, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS gap_seconds FROM events""")
def _(t):
    path = scratch_path(t.spark, "pane_gaps_out")
    jobs.run_pane_gaps(_events(t), path, f"{path}-progress", "user_id", "ts", "event_id")
    d = jobs.pane_gaps_now(t.spark, path, f"{path}-progress", "user_id", "event_id")
    return d.withColumn("gap_seconds", rnd("gap_seconds"))


@book.add("st6_sliding_counts", """
WITH e AS (SELECT user_id, unnest(generate_series(date_trunc('day', ts) + INTERVAL 1 DAY, date_trunc('day', ts) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS stop FROM events)
SELECT strftime(stop, '%Y-%m-%d') AS stop, user_id, count(*) AS n FROM e GROUP BY 1, 2""")
def _(t):
    panes = _latest(t, jobs.daily_counts(_events(t), "user_id", "ts"), "panes_out", ["day", "user_id"])
    d = jobs.sliding_from_panes(panes, "user_id", 30)
    return d.select(F.date_format("end", "yyyy-MM-dd").alias("stop"), "user_id", "n")
