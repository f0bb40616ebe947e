"""Reshaping (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, Book, cents, rnd
from featherloom.operators import reshape as rs

book = Book()
STATUS = ["F", "O", "P"]


@book.add("r01_pivot_mean", "SELECT o_orderpriority, " + ", ".join(f"round(avg(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END), 3) AS {s}" for s in STATUS) + " FROM orders GROUP BY 1")
def _(t):
    d = rs.pivot_mean(t.orders, ["o_orderpriority"], "o_orderstatus", STATUS, "o_totalprice")
    return d.select("o_orderpriority", *[rnd(s, 3).alias(s) for s in STATUS])


TURNS = 8  # columns of the pivot; later turns are counted


@book.add("r02_pivot_unique_cells", "SELECT conv_id, " + ", ".join(f"max(CASE WHEN turn = {i} THEN role END) AS t{i}" for i in range(TURNS)) + f", count(*) FILTER (turn >= {TURNS} OR turn < 0) AS n_more FROM conversations GROUP BY 1")
def _(t):
    d = rs.pivot_unique(t.conversations, ["conv_id"], "turn", list(range(TURNS)), "role")
    more = t.conversations.groupBy("conv_id").agg(F.count_if(~F.col("turn").between(0, TURNS - 1)).alias("n_more"))
    return d.withColumnsRenamed({str(i): f"t{i}" for i in range(TURNS)}).join(more, "conv_id")


@book.add("r03_unpivot", "SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_tax']) AS variable, unnest([l_quantity, l_tax]) AS value FROM lineitem")
def _(t):
    return t.lineitem.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"], "variable", "value")


@book.add("r04_unstack_grid", "SELECT hour(ts) AS y, " + ", ".join(f"count(*) FILTER (WHERE isodow(ts) = {d + 1}) AS x{d}" for d in range(7)) + " FROM events GROUP BY 1")
def _(t):
    cells = t.events.select(F.hour("ts").alias("y"), F.weekday("ts").alias("x"))
    d = cells.groupBy("y").pivot("x", list(range(7))).count()
    return d.fillna(0).withColumnsRenamed({str(i): f"x{i}" for i in range(7)})


@book.add("r05_crosstab_by_row", "SELECT o_orderpriority, " + ", ".join(f"round(count(*) FILTER (WHERE o_orderstatus = '{s}') / count(*), 6) AS {s}" for s in STATUS) + " FROM orders GROUP BY 1")
def _(t):
    d = rs.crosstab_shares(t.orders, "o_orderpriority", "o_orderstatus", STATUS)
    return d.select("o_orderpriority", *[rnd(s).alias(s) for s in STATUS])


@book.add("r06_explode", "SELECT vec_id, CAST(i - 1 AS INT) AS i, round(embedding[i]::DOUBLE, 6) AS x FROM embeddings, range(1, 65) r(i)")
def _(t):
    return t.embeddings.select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x")).withColumn("x", rnd("x"))


@book.add("r07_two_level_select", """
SELECT p_brand, p_size, count(*) AS n FROM part WHERE p_brand <= 'Brand#2' AND p_size >= 20 AND p_size IN (20, 25, 30, 35) GROUP BY 1, 2""")
def _(t):
    d = t.part.where((F.col("p_brand") <= "Brand#2") & (F.col("p_size") >= 20) & F.col("p_size").isin(20, 25, 30, 35))
    return d.groupBy("p_brand", "p_size").agg(F.count("*").alias("n")).orderBy("p_size", "p_brand")


@book.add("r08_resample_monthly", """
WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, avg(o_totalprice) FILTER (o_orderstatus = 'P') AS mean FROM orders GROUP BY 1),
b AS (SELECT min(m) lo, max(m) hi FROM m)
SELECT strftime(g.m, '%Y-%m') AS month, round(mean, 6) AS mean FROM (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM b) g LEFT JOIN m ON m.m = g.m""")
def _(t):
    price = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))  # most months have no such order, so their mean is a gap
    d = t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.avg(price).alias("mean"))
    return rs.fill_periods(d, "m", "1 month").select(F.date_format("m", "yyyy-MM").alias("month"), rnd("mean").alias("mean"))


# every order counts; months without orders are gaps only where the table has some
@book.add("r08_resample_monthly_all", """
WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, avg(o_totalprice) AS mean FROM orders GROUP BY 1),
b AS (SELECT min(m) lo, max(m) hi FROM m)
SELECT strftime(g.m, '%Y-%m') AS month, round(mean, 6) AS mean FROM (SELECT unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM b) g LEFT JOIN m ON m.m = g.m""")
def _(t):
    d = t.orders.groupBy(F.date_trunc("month", "o_orderdate").alias("m")).agg(F.avg("o_totalprice").alias("mean"))
    return rs.fill_periods(d, "m", "1 month").select(F.date_format("m", "yyyy-MM").alias("month"), rnd("mean").alias("mean"))


@book.add("r09_resample_four_months", "SELECT year(o_orderdate) AS year, (month(o_orderdate) - 1) // 4 AS third, max(o_totalprice) AS top FROM orders GROUP BY 1, 2")
def _(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year"), rs.third_of_year(F.col("o_orderdate")).alias("third")).agg(F.max("o_totalprice").alias("top"))


@book.add("r10_ohlc_hourly", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS period, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close,
  CASE WHEN arg_max(value, (ts, event_id)) >= arg_min(value, (ts, event_id)) THEN 'green' ELSE 'red' END AS color FROM events GROUP BY 1""")
def _(t):
    return rs.ohlc(t.events, F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH"), "ts", "event_id", "value")


@book.add("r11_weekday_sum", "SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS wednesdays FROM orders WHERE isodow(o_orderdate) = 3")
def _(t):
    return t.orders.where(F.weekday("o_orderdate") == 2).agg(cents("o_totalprice").alias("wednesdays"))
