"""Sources and sinks (S)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from featherloom.catalog.base import Book, Tables, cents, rnd
from featherloom.session import scratch_path
from featherloom.sources import files, generated, sinks

book = Book()


@book.add("s01_scan_part_files", """
SELECT o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY 1""")
def _(t: Tables):
    path = scratch_path(t.spark, "orders_parts")
    t.orders.write.partitionBy("o_orderpriority").parquet(path)
    got = files.read_parquet(t.spark, f"{path}/*/*.parquet")
    return got.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("n"), cents("o_totalprice").alias("total"))


@book.add("s02_read_parquet", "SELECT * FROM customer")
def _(t):
    return files.read_parquet(t.spark, f"{t.folder}/customer.parquet")


@book.add("s03_read_csv", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = scratch_path(t.spark, "customer_csv")
    sinks.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path)
    return files.read_csv(t.spark, path, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string")


@book.add("s04_read_csv_bad_cells", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END AS size FROM part""")
def _(t):
    path = scratch_path(t.spark, "part_csv")
    size = F.when(F.col("p_size") % 5 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    sinks.write_csv(t.part.select("p_partkey", size.alias("size")), path)
    return files.read_csv(t.spark, path, "p_partkey long, size int")


@book.add("s05_headerless_tsv", "SELECT o_orderkey AS id, o_orderstatus AS label, o_totalprice AS if1 FROM orders")
def _(t):
    path = scratch_path(t.spark, "orders_tsv")
    sinks.write_csv(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path, sep="\t", header=False)
    return files.read_headerless(t.spark, path, "id long, label string, if1 double")


@book.add("s06_headerless_pipe_latin1", "SELECT s_suppkey AS id, s_name || 'é' AS name, s_acctbal AS balance FROM supplier")
def _(t):
    path = scratch_path(t.spark, "supplier_pipe")
    rows = t.supplier.select("s_suppkey", F.concat("s_name", F.lit("é")), "s_acctbal")
    sinks.write_csv(rows, path, sep="|", header=False, encoding="ISO-8859-1")
    return files.read_headerless(t.spark, path, "id long, name string, balance double", "|", "ISO-8859-1")


@book.add("s07_vector_log", """
SELECT label AS arm, count(*) AS n, round(avg(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 6) AS mean_sum, round(avg(vec_id % 2), 6) AS mean_reward,
       CAST(max(len(embedding)) AS INT) AS dims
FROM embeddings GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "vector_log")
    vec = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), "  ")
    line = F.concat_ws(" ", F.col("label").cast("string"), (F.col("vec_id") % 2).cast("string"), vec)
    t.embeddings.select(line).write.text(path)
    log = files.read_vector_log(t.spark, path)
    return log.groupBy("arm").agg(
        F.count("*").alias("n"), rnd(F.avg(F.aggregate("features", F.lit(0.0), lambda a, x: a + x))).alias("mean_sum"),
        rnd(F.avg("reward")).alias("mean_reward"), F.max(F.size("features")).alias("dims"))


@book.add("s07_vector_log_all", """
SELECT label AS arm, CAST(i - 1 AS INT) AS pos, count(*) AS n, round(avg(embedding[i]::DOUBLE), 6) AS mean
FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY 1, 2""")
def _(t):
    path = scratch_path(t.spark, "vector_log")
    vec = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), "  ")
    line = F.concat_ws(" ", F.col("label").cast("string"), (F.col("vec_id") % 2).cast("string"), vec)
    t.embeddings.select(line).write.text(path)
    log = files.read_vector_log(t.spark, path).select("arm", F.posexplode("features").alias("pos", "x"))
    return log.groupBy("arm", "pos").agg(F.count("*").alias("n"), rnd(F.avg("x")).alias("mean"))


@book.add("s08_chunked_csv_predict", """
SELECT o_orderkey AS id, round(1 / (1 + exp(-(o_totalprice - 250000) / 100000)), 6) AS prob FROM orders""")
def _(t):
    path = scratch_path(t.spark, "orders_predict")
    sinks.write_csv(t.orders.select("o_orderkey", "o_totalprice"), path, sep="\t", header=False)
    rows = files.read_headerless(t.spark, path, "id long, price double")

    def score(batches):
        import numpy as np

        for batch in batches:
            p = 1.0 / (1.0 + np.exp(-(batch["price"] - 250000.0) / 100000.0))
            yield pd.DataFrame({"id": batch["id"], "prob": p})

    return rows.mapInPandas(score, "id long, prob double").select("id", rnd("prob").alias("prob"))


@book.add("s09_bom_header", "SELECT p_type AS name, count(*) AS n FROM part GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "bom_csv")
    named = t.part.select(F.col("p_type").alias(files.BOM + "name"), "p_partkey")
    sinks.write_csv(named, path)
    got = t.spark.read.option("header", True).csv(path)
    return files.strip_bom(got).groupBy("name").agg(F.count("*").alias("n"))


@book.add("s10_literal_table", """
SELECT weight, count(*) AS n FROM events
JOIN (VALUES ('click', 1), ('view', 2), ('signup', 3), ('purchase', 5)) w(event_type, weight) USING (event_type)
GROUP BY 1""")
def _(t):
    rows = [("click", 1), ("view", 2), ("signup", 3), ("purchase", 5)]
    weights = t.spark.createDataFrame(rows, "event_type string, weight int")
    return t.events.join(weights, "event_type").groupBy("weight").agg(F.count("*").alias("n"))


@book.add("s11_calendar", """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) lo, max(CAST(o_orderdate AS DATE)) hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
c AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(d.day AS VARCHAR) AS day, CASE WHEN isodow(d.day) <= 5 THEN 1 ELSE 0 END AS is_business_day,
  CASE WHEN isodow(d.day) = 4 AND day(d.day) BETWEEN 15 AND 21 THEN 1 ELSE 0 END AS is_third_thursday,
  coalesce(n, 0) AS n
FROM d LEFT JOIN c ON d.day = c.day""")
def _(t):
    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    days = generated.calendar(bounds, "lo", "hi").join(counts, "day", "left")
    return days.select(F.col("day").cast("string"), "is_business_day", "is_third_thursday",
                       F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@book.add("s12_integer_grid", """
WITH c AS (SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS x, hour(ts) AS y, count(*) AS n FROM events GROUP BY 1, 2),
g AS (SELECT x, y FROM (SELECT unnest(range(0, (SELECT max(x) + 1 FROM c))) AS x), (SELECT unnest(range(0, 24)) AS y))
SELECT g.x, g.y, coalesce(n, 0) AS n FROM g LEFT JOIN c ON g.x = c.x AND g.y = c.y""")
def _(t):
    cell = t.events.select(F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("long").alias("x"),
                           F.hour("ts").cast("long").alias("y"))
    counts = cell.groupBy("x", "y").agg(F.count("*").alias("n"))
    cells = generated.grid(cell.agg(F.max("x").alias("m")), F.col("m") + 1, F.lit(24))
    return cells.join(counts, ["x", "y"], "left").select("x", "y", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@book.add("s13_linspace", """
WITH b AS (SELECT min(o_totalprice) lo, max(o_totalprice) hi FROM orders)
SELECT CAST(i AS INT) AS i, round(lo + (hi - lo) * i / 10.0, 4) AS edge FROM b, range(0, 11) r(i)""")
def _(t):
    b = t.orders.agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    edges = b.select(F.posexplode(generated.linspace(F.col("lo"), F.col("hi"), 10)).alias("i", "edge"))
    return edges.select("i", rnd("edge", 4).alias("edge"))


@book.add("s14_write_csv", "SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem")
def _(t):
    path = scratch_path(t.spark, "lineitem_csv")
    sinks.write_csv(t.lineitem, path)
    got = files.read_csv(t.spark, path, t.lineitem.schema)
    return got.agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@book.add("s15_write_scores_tsv", """
SELECT doc_id || chr(9) || format('{:.6f}', (n_chars % 97 + 1) / 100.0::DOUBLE) AS line FROM documents""")
def _(t):
    path = scratch_path(t.spark, "scores_tsv")
    sinks.write_scores(t.documents.select("doc_id", ((F.col("n_chars") % 97 + 1) / 100.0).alias("p")), path, "doc_id", "p")
    return t.spark.read.text(path).select(F.col("value").alias("line"))


@book.add("s16_write_parquet", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    path = scratch_path(t.spark, "events_parquet")
    sinks.write_parquet(t.events.select("event_id", "user_id", "event_type", "value"), path)
    return files.read_parquet(t.spark, path)


@book.add("s17_write_parquet_chunks", "SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "lineitem_chunks")
    sinks.write_parquet(t.lineitem, path, rows_per_file=1_000_000)
    return files.read_parquet(t.spark, path).groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"))
