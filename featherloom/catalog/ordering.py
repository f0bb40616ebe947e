"""Window features (W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SCORED, Book, rnd
from featherloom.operators import windows as win
from featherloom.operators.metrics import auc
from featherloom.operators.ordered import positions
from featherloom.operators.stats import with_group_stats

book = Book()
BY_USER = "PARTITION BY user_id ORDER BY ts, event_id"
KEYS, ORDER = ["user_id"], ["ts", "event_id"]


def _events(t):
    return t.events.select("event_id", "user_id", "ts", "event_type", "value")


@book.add("w01_rolling_mean", f"SELECT event_id, round(avg(value) OVER ({BY_USER} ROWS 6 PRECEDING), 6) AS rolling_mean_7 FROM events")
def _(t):
    return win.rolling_stats(_events(t), KEYS, ORDER, "value", 7).select("event_id", rnd("rolling_mean_7").alias("rolling_mean_7"))


@book.add("w02_rolling_std", f"SELECT event_id, round(coalesce(stddev_samp(value) OVER ({BY_USER} ROWS 29 PRECEDING), 0), 6) AS rolling_std_30 FROM events")
def _(t):
    return win.rolling_stats(_events(t), KEYS, ORDER, "value", 30).select("event_id", rnd("rolling_std_30").alias("rolling_std_30"))


@book.add("w03_rolling_mean_full", f"""
SELECT event_id, CASE WHEN count(*) OVER ({BY_USER} ROWS 6 PRECEDING) = 7 THEN round(avg(value) OVER ({BY_USER} ROWS 6 PRECEDING), 6) END AS rolling_mean_7 FROM events""")
def _(t):
    return win.rolling_stats(_events(t), KEYS, ORDER, "value", 7, full=True).select("event_id", rnd("rolling_mean_7").alias("rolling_mean_7"))


@book.add("w04_rolling_mean_nulls", f"""
SELECT event_id, round(avg(v) OVER ({BY_USER} ROWS 2 PRECEDING), 6) AS rolling_mean_3 FROM (SELECT *, CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM events)""")
def _(t):
    d = _events(t).withColumn("v", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return win.rolling_stats(d, KEYS, ORDER, "v", 3).select("event_id", rnd("rolling_mean_3").alias("rolling_mean_3"))


GAPS = f"gaps AS (SELECT user_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER ({BY_USER})) / 1e6 AS g FROM events)"


@book.add("w05_gap_seconds", f"""WITH {GAPS}
SELECT user_id, round(avg(g), 3) AS mean_txn_diff, round(stddev_samp(g), 3) AS std_txn_diff, round(min(g), 6) AS min_txn_diff, round(max(g), 6) AS max_txn_diff FROM gaps GROUP BY 1""")
def _(t):
    d = win.gap_stats(_events(t), KEYS, "ts", "event_id")
    return d.select("user_id", *[rnd(f"{a}_txn_diff", n).alias(f"{a}_txn_diff") for a, n in (("mean", 3), ("std", 3), ("min", 6), ("max", 6))])


@book.add("w06_gap_days", f"""WITH {GAPS}
SELECT user_id, round(avg(g / 86400), 6) AS mean_interval_days, round(stddev_samp(g / 86400), 6) AS std_interval_days FROM gaps GROUP BY 1""")
def _(t):
    d = win.gap_stats(_events(t), KEYS, "ts", "event_id", 86400.0, "interval_days")
    return d.select("user_id", rnd("mean_interval_days").alias("mean_interval_days"), rnd("std_interval_days").alias("std_interval_days"))


SWITCH = f"""WITH {ACTIONS}, s AS (SELECT user_id, event_id, ts, cluster, lag(cluster) OVER ({BY_USER}) AS pv FROM actions),
g AS (SELECT user_id, trunc((epoch_us(ts) - lag(epoch_us(ts)) OVER ({BY_USER})) / 86400000000) AS days FROM s WHERE cluster <> pv) """


@book.add("w07_category_switches", SWITCH + """
SELECT user_id, CAST(coalesce(sum(abs(cluster - pv)), 0) AS BIGINT) AS abs_id_change, count(*) FILTER (WHERE cluster <> pv) AS switch_count FROM s GROUP BY 1""")
def _(t):
    return win.switch_stats(t.actions, KEYS, "ts", "event_id", "cluster").select("user_id", "abs_id_change", "switch_count")


@book.add("w08_days_between_switches", SWITCH + "SELECT user_id, round(avg(days), 6) AS mean_switch_days FROM g GROUP BY 1")
def _(t):
    return win.switch_stats(t.actions, KEYS, "ts", "event_id", "cluster").select("user_id", rnd("mean_switch_days").alias("mean_switch_days"))


@book.add("w09_zscore_outlier_share", """
WITH z AS (SELECT user_id, (value - avg(value) OVER (PARTITION BY user_id)) / stddev_pop(value) OVER (PARTITION BY user_id) AS z FROM events)
SELECT user_id, round(avg(CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END), 6) AS outlier_share, round(max(z), 6) AS max_z FROM z GROUP BY 1""")
def _(t):
    z = win.group_zscore(_events(t), KEYS, "value")
    return z.groupBy("user_id").agg(rnd(F.avg((F.abs("z") > 3).cast("int"))).alias("outlier_share"), rnd(F.max("z")).alias("max_z"))


@book.add("w10_group_value_to_rows", "SELECT event_id, max(value) OVER (PARTITION BY user_id) AS top, count(*) OVER (PARTITION BY user_id) AS n FROM events")
def _(t):
    return with_group_stats(_events(t), KEYS, top=F.max("value"), n=F.count("*")).select("event_id", "top", "n")


@book.add("w11_fill_negatives", """
SELECT event_id, round(CASE WHEN v < 0 THEN avg(CASE WHEN v >= 0 THEN v END) OVER (PARTITION BY user_id) ELSE v END, 6) AS filled FROM (SELECT *, value - 20 AS v FROM events)""")
def _(t):
    d = _events(t).withColumn("v", F.col("value") - 20)
    return win.fill_negatives(d, KEYS, "v", "filled").select("event_id", rnd("filled").alias("filled"))


@book.add("w12_drop_repeats", f"""
SELECT event_id, event_type FROM (SELECT *, lag(event_type) OVER ({BY_USER}) AS p FROM events) WHERE p IS NULL OR p <> event_type""")
def _(t):
    return win.drop_repeats(_events(t), KEYS, ORDER, "event_type").select("event_id", "event_type")


@book.add("w13_distance_to_previous_hit", f"""
WITH p AS (SELECT *, row_number() OVER ({BY_USER}) AS pos FROM events)
SELECT event_id, pos - coalesce(max(CASE WHEN event_type = 'error' THEN pos END) OVER ({BY_USER} ROWS UNBOUNDED PRECEDING), 0) AS distance FROM p""")
def _(t):
    return win.since_last(_events(t), KEYS, ORDER, F.col("event_type") == "error", "distance").select("event_id", "distance")


@book.add("w14_running_count", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS nth FROM conversations")
def _(t):
    d = positions(t.conversations.select("conv_id", "turn", "role"), ["conv_id", "role"], ["turn"])
    return d.select("conv_id", "turn", (F.col("pos") - 1).alias("nth"))


@book.add("w15_percent_rank_average", f"""WITH {SCORED}
SELECT doc_id, round((rank() OVER (ORDER BY p1) + (count(*) OVER (PARTITION BY p1) - 1) / 2) / count(*) OVER (), 6) AS pct FROM scored""")
def _(t):
    return win.mean_percent_rank(t.scored.select("doc_id", "p1"), "p1", "pct").select("doc_id", rnd("pct").alias("pct"))


@book.add("w16_min_max_scale", "SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6) AS scaled FROM orders")
def _(t):
    return win.min_max(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "scaled").select("o_orderkey", rnd("scaled").alias("scaled"))


@book.add("w17_interpolate", f"""
WITH p AS (SELECT event_id, user_id, ts, row_number() OVER ({BY_USER}) AS pos, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events),
k AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS lo,
  min(CASE WHEN v IS NOT NULL THEN pos END) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi FROM p)
SELECT k.event_id, round(coalesce(k.v, a.v + (b.v - a.v) * (k.pos - k.lo) / nullif(k.hi - k.lo, 0)::DOUBLE, a.v), 6) AS filled FROM k
LEFT JOIN p a ON a.user_id = k.user_id AND a.pos = k.lo LEFT JOIN p b ON b.user_id = k.user_id AND b.pos = k.hi""")
def _(t):
    d = _events(t).withColumn("v", F.when(F.col("event_id") % 3 == 0, F.col("value")))
    return win.interpolate(d, KEYS, ORDER, "v", "filled").select("event_id", rnd("filled").alias("filled"))


@book.add("w18_cumulative_product", f"SELECT event_id, round(exp(sum(ln(1 + value / 100000)) OVER ({BY_USER} ROWS UNBOUNDED PRECEDING)), 9) AS wealth FROM events")
def _(t):
    return win.cumulative_product(_events(t), KEYS, ORDER, 1 + F.col("value") / 100000, "wealth").select("event_id", rnd("wealth", 9).alias("wealth"))


@book.add("w19_percent_change", f"SELECT event_id, round(value / nullif(lag(value) OVER ({BY_USER}), 0) - 1, 6) + 0 AS change FROM events")
def _(t):
    return win.percent_change(_events(t), KEYS, ORDER, "value", "change").select("event_id", rnd("change").alias("change"))


ARMS = ["click", "purchase", "signup"]


@book.add("w20_selection_shares", "SELECT event_id, " + ", ".join(
    f"round(sum(CASE WHEN event_type = '{a}' THEN 1 ELSE 0 END) OVER w / count(*) OVER w, 6) AS share_{a}" for a in ARMS)
    + " FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")
def _(t):
    d = win.selection_shares(_events(t), ORDER, "event_type", ARMS)
    return d.select("event_id", *[rnd(f"share_{a}").alias(f"share_{a}") for a in ARMS])


@book.add("w21_replay_rate", """
SELECT event_id, round(avg(CASE WHEN value > 20 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS rate
FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE 'purchase' END AS chosen FROM events) WHERE chosen = event_type""")
def _(t):
    chosen = F.when(F.col("event_id") % 3 == 0, "click").when(F.col("event_id") % 3 == 1, "view").otherwise("purchase")
    d = _events(t).withColumns({"chosen": chosen, "reward": (F.col("value") > 20).cast("int")})
    return win.replay_rate(d, ORDER, "event_type", "chosen", "reward", "rate").select("event_id", rnd("rate").alias("rate"))


@book.add("w22_minimum_equal_gap", """
SELECT coalesce(min(event_id - p - 1), -1) AS min_gap FROM (SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)""")
def _(t):
    return win.min_equal_gap(t.events, "event_id", "user_id")


@book.add("w23_duplicated_rows", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_partkey, l_suppkey) > 1")
def _(t):
    return win.duplicated(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"])


AUC_SQL = """SELECT {keys} model, sum(CASE WHEN a.y = 1 THEN rk END) AS rs, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n"""


@book.add("w24_zone_models", f"""WITH {SCORED},
long AS (SELECT CAST(floor(x / 1000) AS BIGINT) AS zone, 'p1' AS model, y, p1 AS s FROM scored UNION ALL SELECT CAST(floor(x / 1000) AS BIGINT), 'p2', y, p2 FROM scored),
r AS (SELECT *, rank() OVER (PARTITION BY zone, model ORDER BY s) + (count(*) OVER (PARTITION BY zone, model, s) - 1) / 2 AS rk FROM long),
a AS (SELECT zone, model, sum(CASE WHEN y = 1 THEN rk END) AS rs, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM r GROUP BY 1, 2),
u AS (SELECT zone, model, (rs - p * (p + 1) / 2) / (p * n) AS auc FROM a WHERE p > 0 AND n > 0)
SELECT zone, arg_min(model, (-round(auc, 9), model)) AS best_model, round(max(auc), 6) AS auc FROM u GROUP BY 1""")
def _(t):
    from featherloom.plans.zones import zone_models

    d = zone_models(t.scored.select("x", "y", "p1", "p2"), "x", "y", ["p1", "p2"], width=1000)
    return d.select("zone", "best_model", rnd("auc").alias("auc"))
