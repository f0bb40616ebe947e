"""User functions (UD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SCORED, SLOPE, Book, monthly_mean, rnd
from featherloom.functions import dates, rows
from featherloom.operators import categories as cat
from featherloom.operators import hooks
from featherloom.operators.aggregates import monthly_trend
from featherloom.operators.filters import apply_rule

book = Book()


@book.add("ud1_value_function", "SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM orders")
def _(t):
    return t.orders.select("o_orderkey", dates.season(F.month("o_orderdate")).alias("season"))


@book.add("ud2_row_function", "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN l_tax WHEN 'N' THEN l_discount END AS chosen FROM lineitem")
def _(t):
    name = F.when(F.col("l_returnflag") == "A", "l_tax").when(F.col("l_returnflag") == "N", "l_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", rows.pick_named(name, ["l_tax", "l_discount"]).alias("chosen"))


@book.add("ud3_group_aggregate", f"""WITH {ACTIONS}, c AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM (SELECT user_id, action, count(*) AS n FROM actions GROUP BY 1, 2)) SELECT user_id, round(-sum(p * ln(p)), 6) AS entropy FROM c GROUP BY 1""")
def _(t):
    return cat.category_profile(t.actions, ["user_id"], "action").select("user_id", rnd("entropy").alias("entropy"))


def _start(part):
    v = part["value"]
    mean = float(v.mean())
    return float(len(v)), mean, float(((v - mean) ** 2).sum()), float(v.max())


def _merge(a, b):
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n, max(a[3], b[3])


def _finish(s):
    return (s[2] / s[0]) ** 0.5 / s[1], s[3] / s[1]


def _spread(t):
    return hooks.fold_groups(t.events.select("user_id", "value"), ["user_id"], "n double, mean double, m2 double, top double", _start, _merge, _finish, "variation double, peak double")


@book.add("ud3_open_aggregate", "SELECT user_id, round(stddev_pop(value) / avg(value), 6) AS variation, round(max(value) / avg(value), 6) AS peak FROM events GROUP BY 1")
def _(t):
    return _spread(t).select("user_id", rnd("variation").alias("variation"), rnd("peak").alias("peak"))


@book.add("ud4_group_to_rows", f"""
WITH m AS (SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) AS x, {monthly_mean('o_totalprice')} AS y FROM orders GROUP BY 1, 2),
s AS (SELECT o_custkey, max(o_orderstatus) FILTER (WHERE rk = 1) AS top_1, max(o_orderstatus) FILTER (WHERE rk = 2) AS top_2 FROM (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderstatus) AS rk FROM orders GROUP BY 1, 2) GROUP BY 1)
SELECT o_custkey, {SLOPE} AS trend, any_value(top_1) AS top_1, any_value(top_2) AS top_2 FROM m JOIN s USING (o_custkey) GROUP BY 1""")
def _(t):
    trend = monthly_trend(t.orders, ["o_custkey"], "o_orderdate", "o_totalprice", "trend")
    return trend.join(cat.top_columns(t.orders, ["o_custkey"], "o_orderstatus", 2, "top"), "o_custkey")


@book.add("ud5_group_transform", "SELECT event_id, round(value / (stddev_pop(value) OVER (PARTITION BY user_id) / avg(value) OVER (PARTITION BY user_id)), 4) AS scaled FROM events")
def _(t):
    d = hooks.transform_groups(t.events, ["user_id"], _spread(t), scaled=F.col("value") / F.col("variation"))
    return d.select("event_id", rnd("scaled", 4).alias("scaled"))


@book.add("ud6_user_predicate", "SELECT event_id FROM events WHERE value > 50 AND event_type <> 'error'")
def _(t):
    return apply_rule(t.events, {"keep": lambda: (F.col("value") > 50) & (F.col("event_type") != "error")}, "keep").select("event_id")


@book.add("ud7_user_metric", f"WITH {SCORED} SELECT round(avg(abs(y - p1)), 6) AS mae, round(max(abs(y - p1)), 6) AS worst, round(avg(CASE WHEN (p1 >= 0.5) = (y = 1) THEN 1 ELSE 0 END), 6) AS accuracy FROM scored")
def _(t):
    y, p = F.col("y"), F.col("p1")
    return hooks.evaluate(t.scored, {"mae": rnd(F.avg(F.abs(y - p))), "worst": rnd(F.max(F.abs(y - p))), "accuracy": rnd(F.avg(((p >= 0.5) == (y == 1)).cast("int")))})


@book.add("ud8_lists_to_rows", "SELECT conv_id, turn, CAST(i AS INT) AS i, string_split(text, ' ')[i + 1] AS word FROM (SELECT conv_id, turn, text, unnest(range(len(string_split(text, ' ')))) AS i FROM conversations)")
def _(t):
    return t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", " ", -1)).alias("i", "word"))
