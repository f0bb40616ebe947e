"""Aggregations (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SCORED, SLOPE, Book, cents, monthly_mean, rnd
from featherloom.functions.dates import whole_days
from featherloom.operators import aggregates as ag
from featherloom.operators import categories as cat
from featherloom.operators.ordered import group_quantiles
from featherloom.operators.stats import join_groups, with_stats
from featherloom.session import materialize

book = Book()
D2 = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
MODES = """counts AS (SELECT {key}, {val}, count(*) AS n FROM {src} WHERE {val} IS NOT NULL GROUP BY 1, 2)"""


@book.add("a01_global_stats", f"""
SELECT {D2.format('value')} AS total, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM events""")
def _(t):
    return t.events.agg(cents("value").alias("total"), F.min("value").alias("min"), F.max("value").alias("max"),
                        rnd(F.avg("value")).alias("mean"), rnd(F.stddev_samp("value")).alias("std"))


@book.add("a02_group_stats", f"""
SELECT o_custkey AS client, count(*) AS n, round(avg(o_totalprice), 6) AS mean, {D2.format('o_totalprice')} AS total,
  round(stddev_samp(o_totalprice), 2) AS std, min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy(F.col("o_custkey").alias("client")).agg(
        F.count("*").alias("n"), rnd(F.avg("o_totalprice")).alias("mean"), cents("o_totalprice").alias("total"),
        rnd(F.stddev_samp("o_totalprice"), 2).alias("std"), F.min("o_totalprice").alias("min"), F.max("o_totalprice").alias("max"))


@book.add("a03_distinct_count", "SELECT l_returnflag AS flag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.col("l_returnflag").alias("flag")).agg(
        F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"))


@book.add("a03_distinct_from_daily_sketches", """
SELECT l_returnflag AS flag, year(l_shipdate) AS year, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders, true AS parts_within, true AS orders_within
FROM lineitem GROUP BY 1, 2""")
def _(t):
    d = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("day"), F.year("l_shipdate").cast("long").alias("year"), "l_partkey", "l_orderkey")
    cols = ["l_partkey", "l_orderkey"]
    daily = materialize(ag.distinct_sketches(d, ["flag", "day"], cols), "sketches")
    yearly = ag.merged_distinct(daily.withColumn("year", F.year("day").cast("long")), ["flag", "year"], cols)
    exact = d.groupBy("flag", "year").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"))

    def within(name, col):
        return (F.abs(F.col(f"approx_{col}") - F.col(name)) < 0.03 * F.col(name)).alias(f"{name}_within")

    return exact.join(yearly, ["flag", "year"]).select("flag", "year", "parts", "orders", within("parts", "l_partkey"), within("orders", "l_orderkey"))


@book.add("a04_count_rows_and_values", f"WITH {ACTIONS} SELECT user_id, count(*) AS n, count(widget) AS n_widget FROM actions GROUP BY 1")
def _(t):
    return t.actions.groupBy("user_id").agg(F.count("*").alias("n"), F.count("widget").alias("n_widget"))


@book.add("a05_conditional_counts", f"""
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS orders,
  coalesce(CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS DOUBLE), 0) AS spent FROM events GROUP BY 1""")
def _(t):
    kind = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        F.count_if(kind == "click").alias("clicks"), F.count_if(kind == "purchase").alias("orders"),
        F.coalesce(cents(F.when(kind == "purchase", F.col("value"))), F.lit(0.0)).alias("spent"))


@book.add("a06_filtered_aggregates", """
SELECT user_id, count(value) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS recent, round(avg(value) FILTER (WHERE event_type <> 'error'), 6) AS mean_ok FROM events GROUP BY 1""")
def _(t):
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp")
    return t.events.groupBy("user_id").agg(
        F.count(F.when(late, F.col("value"))).alias("recent"),
        rnd(F.avg(F.when(F.col("event_type") != "error", F.col("value")))).alias("mean_ok"))


@book.add("a07_boolean_rate", "SELECT o_custkey, round(avg(CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END), 6) AS weekend_rate FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(rnd(F.avg((F.weekday("o_orderdate") >= 5).cast("int"))).alias("weekend_rate"))


@book.add("a08_first_last_days_since", """
SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us,
  CAST(trunc((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(min(ts))) / 86400000000) AS BIGINT) AS days_since_first,
  CAST(trunc((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 86400000000) AS BIGINT) AS days_since_last FROM events GROUP BY 1""")
def _(t):
    ref = F.lit("2024-02-01").cast("timestamp")
    d = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return d.select("user_id", F.unix_micros("a").alias("first_us"), F.unix_micros("b").alias("last_us"),
                    whole_days(ref, F.col("a")).alias("days_since_first"), whole_days(ref, F.col("b")).alias("days_since_last"))


PROFILE = f"""WITH {ACTIONS}, {MODES.format(key='user_id', val='cluster', src='actions')}
SELECT user_id, {{}} FROM counts GROUP BY 1"""


def _profile(t):
    return cat.category_profile(t.actions, ["user_id"], "cluster")


@book.add("a09_mode", PROFILE.format("CAST(arg_min(cluster, (-n, cluster)) AS INT) AS mode"))
def _(t):
    return _profile(t).select("user_id", "mode")


@book.add("a10_concentration", PROFILE.format("round(max(n) / sum(n), 6) AS concentration"))
def _(t):
    return _profile(t).select("user_id", rnd("concentration").alias("concentration"))


@book.add("a11_entropy_nats", f"""WITH {ACTIONS}, {MODES.format(key='user_id', val='cluster', src='actions')},
p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM counts) SELECT user_id, round(-sum(p * ln(p)), 6) + 0 AS entropy FROM p GROUP BY 1""")
def _(t):
    return _profile(t).select("user_id", rnd("entropy").alias("entropy"))


@book.add("a12_entropy_bits_eps", f"""WITH {ACTIONS}, {MODES.format(key='user_id', val='cluster', src='actions')},
p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM counts) SELECT user_id, round(-sum(p * log2(p + 1e-9)), 6) AS entropy FROM p GROUP BY 1""")
def _(t):
    return cat.entropy_bits(t.actions, ["user_id"], "cluster", "entropy").withColumn("entropy", rnd("entropy"))


@book.add("a13_stability", PROFILE.format("round((sum(n) - count(*)) / sum(n), 6) AS stability"))
def _(t):
    return _profile(t).select("user_id", rnd("stability").alias("stability"))


@book.add("a14_modal_share", f"""WITH {ACTIONS}, {MODES.format(key='user_id', val='widget', src='actions')},
m AS (SELECT user_id, arg_min(widget, (-n, widget)) AS mode FROM counts GROUP BY 1)
SELECT user_id, round(count(CASE WHEN widget = mode THEN 1 END) / count(*), 6) AS share FROM actions JOIN m USING (user_id) WHERE widget IS NOT NULL GROUP BY 1""")
def _(t):
    return cat.category_profile(t.actions, ["user_id"], "widget").select("user_id", rnd("concentration").alias("share"))


MODAL = f"""WITH {ACTIONS}, {MODES.format(key='user_id', val='cluster', src='actions')},
m AS (SELECT user_id, arg_min(cluster, (-n, cluster)) AS mode FROM counts GROUP BY 1) """


@book.add("a15_modal_vs_rest", MODAL + """SELECT user_id, round(avg(CASE WHEN cluster = mode THEN value END) - avg(CASE WHEN cluster <> mode THEN value END), 6) AS difference
FROM actions JOIN m USING (user_id) GROUP BY 1""")
def _(t):
    d = cat.measure_by_mode(t.actions, ["user_id"], "cluster", F.col("value"), "inside", "difference")
    return d.select("user_id", rnd("difference").alias("difference"))


@book.add("a16_modal_mean", MODAL + "SELECT user_id, round(avg(CASE WHEN cluster = mode THEN value END), 6) AS inside FROM actions JOIN m USING (user_id) GROUP BY 1")
def _(t):
    d = cat.measure_by_mode(t.actions, ["user_id"], "cluster", F.col("value"), "inside")
    return d.select("user_id", rnd("inside").alias("inside"))


RANKED = f"""WITH {ACTIONS}, {MODES.format(key='user_id', val='cluster', src='actions')},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, cluster) AS rk FROM counts) """


@book.add("a17_top_arrays", RANKED + """SELECT user_id, array_to_string(list(cluster ORDER BY rk), ',') AS top_values, array_to_string(list(n ORDER BY rk), ',') AS top_counts
FROM r WHERE rk <= 3 GROUP BY 1""")
def _(t):
    d = cat.top_arrays(t.actions, ["user_id"], "cluster", 3, "v", "c")
    return d.select("user_id", F.array_join(F.col("v").cast("array<string>"), ",").alias("top_values"),
                    F.array_join(F.col("c").cast("array<string>"), ",").alias("top_counts"))


@book.add("a18_top_columns", RANKED + """SELECT user_id, max(CASE WHEN rk = 1 THEN cluster END) AS top_1, max(CASE WHEN rk = 2 THEN cluster END) AS top_2 FROM r WHERE rk <= 2 GROUP BY 1""")
def _(t):
    return cat.top_columns(t.actions, ["user_id"], "cluster", 2, "top")


@book.add("a19_quantiles", """
SELECT user_id, round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.95), 6) AS q95 FROM events GROUP BY 1""")
def _(t):
    q = group_quantiles(t.events, ["user_id"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95})
    return q.select("user_id", *[rnd(c).alias(c) for c in ("q25", "q50", "q75", "q95")])


@book.add("a20_skewness", "SELECT user_id, round(skewness(value), 6) AS skew FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(rnd(ag.unbiased_skew("value")).alias("skew"))


@book.add("a21_monthly_trend", f"""
WITH m AS (SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) AS x, {monthly_mean('o_totalprice')} AS y FROM orders GROUP BY 1, 2)
SELECT o_custkey, {SLOPE} AS trend FROM m GROUP BY 1""")
def _(t):
    return ag.monthly_trend(t.orders, ["o_custkey"], "o_orderdate", "o_totalprice", "trend")


@book.add("a22_weekly_counts", """
WITH w AS (SELECT o_custkey, weekofyear(o_orderdate) AS w, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, round(avg(n), 6) AS mean_weekly, round(stddev_samp(n), 6) AS std_weekly, max(n) AS max_weekly FROM w GROUP BY 1""")
def _(t):
    d = ag.weekly_counts(t.orders, ["o_custkey"], "o_orderdate", "weekly")
    return d.select("o_custkey", rnd("mean_weekly").alias("mean_weekly"), rnd("std_weekly").alias("std_weekly"), "max_weekly")


@book.add("a23_category_shares", """
SELECT o_custkey, round(avg(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END), 6) AS share_O, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 6) AS share_F,
  round(avg(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END), 6) AS share_P FROM orders GROUP BY 1""")
def _(t):
    d = t.orders.groupBy("o_custkey").agg(*ag.category_shares("o_orderstatus", ["O", "F", "P"], "share"))
    return d.select("o_custkey", *[rnd(f"share_{v}").alias(f"share_{v}") for v in "OFP"])


@book.add("a24_pivot_counts_and_ratios", f"""WITH {ACTIONS}
SELECT user_id, {', '.join(f"count(*) FILTER (WHERE widget = {w}) AS widget_{w}_count, round(count(*) FILTER (WHERE widget = {w}) / count(*), 6) AS widget_{w}_ratio" for w in range(4))}
FROM actions WHERE widget IS NOT NULL GROUP BY 1""")
def _(t):
    from featherloom.plans.shop import widget_block

    d = widget_block(t.actions, [0, 1, 2, 3])
    return d.select("user_id", *[f"widget_{w}_count" for w in range(4)], *[rnd(f"widget_{w}_ratio").alias(f"widget_{w}_ratio") for w in range(4)])


@book.add("a25_ratio_with_epsilon", """
SELECT user_id, round(count(*) FILTER (WHERE isodow(ts) < 6) / (count(*) FILTER (WHERE isodow(ts) >= 6) + 1e-6), 4) AS weekday_weekend FROM events GROUP BY 1""")
def _(t):
    weekend = F.weekday("ts") >= 5
    return t.events.groupBy("user_id").agg(rnd(F.count_if(~weekend) / (F.count_if(weekend) + F.lit(1e-6)), 4).alias("weekday_weekend"))


@book.add("a26_span_and_rate", """
SELECT user_id, event_type, CAST(trunc((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS BIGINT) AS days,
  round(count(*) / nullif(trunc((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000), 0), 6) AS rate FROM events GROUP BY 1, 2""")
def _(t):
    days = whole_days(F.max("ts"), F.min("ts"))
    return t.events.groupBy("user_id", "event_type").agg(days.alias("days"), rnd(F.try_divide(F.count("*"), days)).alias("rate"))


@book.add("a27_value_counts", "SELECT value AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (SELECT l_returnflag || l_linestatus AS value FROM lineitem) GROUP BY 1")
def _(t):
    d = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("value"))
    return ag.value_counts(d, "value", "share").withColumn("share", rnd("share"))


@book.add("a28_group_by_bin", "SELECT CAST(floor(l_quantity / 10) AS BIGINT) AS bin, count(*) AS n, round(avg(l_extendedprice), 3) AS mean FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.floor(F.col("l_quantity") / 10).alias("bin")).agg(F.count("*").alias("n"), rnd(F.avg("l_extendedprice"), 3).alias("mean"))


@book.add("a29_sum_of_three_largest", """
SELECT user_id, round(sum(value), 2) AS top3 FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rn FROM events) WHERE rn <= 3 GROUP BY 1""")
def _(t):
    return ag.sum_of_largest(t.events, ["user_id"], "value", 3, "top3").withColumn("top3", rnd("top3", 2))


@book.add("a30_any_order_label", """
SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS target FROM events WHERE ts >= TIMESTAMP '2024-01-29' GROUP BY 1""")
def _(t):
    late = t.events.where(F.col("ts") >= F.lit("2024-01-29").cast("timestamp"))
    return late.groupBy("user_id").agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("target"))


@book.add("a31_label_balance", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2")
def _(t):
    return t.labels.groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@book.add("a32_level_sums", """
SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(grouping(o_orderpriority) AS INT) AS level, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderstatus, o_orderpriority))""")
def _(t):
    d = t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice")
    d = d.groupingSets([[d["status"]], [d["status"], d["priority"]]], d["status"], d["priority"])
    return d.agg(F.grouping("priority").cast("int").alias("level"), cents("o_totalprice").alias("total"))


@book.add("a33_smallest_column_sum", """
WITH s AS (SELECT sum(l_quantity) a, sum(l_discount) b, sum(l_tax) c FROM lineitem),
u AS (SELECT 'l_quantity' AS col, a AS total FROM s UNION ALL SELECT 'l_discount', b FROM s UNION ALL SELECT 'l_tax', c FROM s)
SELECT arg_min(col, total) AS column_name, round(min(total), 2) AS total FROM u""")
def _(t):
    sums = ag.column_sums(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    return sums.agg(F.min_by("column", "total").alias("column_name"), rnd(F.min("total"), 2).alias("total"))


@book.add("a33_largest_cells", """
SELECT l_orderkey, l_linenumber, col, cell FROM (SELECT l_orderkey, l_linenumber, unnest(['l_extendedprice', 'l_quantity']) AS col, unnest([l_extendedprice, l_quantity]) AS cell FROM lineitem)
ORDER BY cell DESC, l_orderkey, l_linenumber LIMIT 3""")
def _(t):
    long = t.lineitem.unpivot(["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_quantity"], "col", "cell")
    return long.orderBy(F.desc("cell"), "l_orderkey", "l_linenumber").limit(3)


@book.add("a34_day_of_maximum", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(CAST(arg_max(o_orderdate, (o_totalprice, -o_orderkey)) AS DATE) AS VARCHAR) AS day FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.to_date(F.max_by("o_orderdate", F.struct("o_totalprice", -F.col("o_orderkey")))).cast("string").alias("day"))


@book.add("a35_rows_seen_once", """
SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1""")
def _(t):
    return ag.rows_seen_once(t.lineitem, ["l_partkey", "l_suppkey"])


@book.add("a36_inverse_frequency", f"""WITH {SCORED}
SELECT lang, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1, round(count(*) FILTER (WHERE y = 0) / nullif(count(*) FILTER (WHERE y = 1), 0), 6) AS weight FROM scored GROUP BY 1""")
def _(t):
    n0, n1 = F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)
    return t.scored.groupBy("lang").agg(n0.alias("n0"), n1.alias("n1"), rnd(F.try_divide(n0, n1)).alias("weight"))


@book.add("a37_weighted_histogram", """
SELECT coalesce(b.bin, h.bin) AS bin, coalesce(w, 0) AS w FROM range(0, 60) b(bin) FULL JOIN (SELECT CAST(floor(value / 10) AS BIGINT) AS bin, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS w FROM events WHERE value IS NOT NULL GROUP BY 1) h ON h.bin = b.bin""")
def _(t):
    d = ag.histogram(t.events, F.floor(F.col("value") / 10), 60, F.col("value").cast("decimal(18,2)"))
    return d.select("bin", F.col("w").cast("double").alias("w"))


NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@book.add("a38_correlation_matrix", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for i, a in enumerate(NUM) for b in NUM[i + 1:]) + ") WHERE abs(r) > 0.0001")
def _(t):
    return ag.correlations(t.lineitem, NUM, above=0.0001).withColumn("r", rnd("r"))


@book.add("a39_correlation_with_target", "SELECT feature, round(r, 6) AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, corr({a}, l_extendedprice) AS r FROM lineitem" for a in ("l_quantity", "l_discount", "l_tax")) + ") ORDER BY abs(r) DESC LIMIT 2")
def _(t):
    return ag.correlations_with(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"], 2).withColumn("r", rnd("r"))


@book.add("a40_two_key_mean_and_median", """
SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 3) AS mean, round(median(l_quantity), 6) AS median FROM lineitem GROUP BY 1, 2""")
def _(t):
    keys = ["l_returnflag", "l_linestatus"]
    means = t.lineitem.groupBy(*keys).agg(rnd(F.avg("l_extendedprice"), 3).alias("mean"))
    return means.join(group_quantiles(t.lineitem, keys, "l_quantity", {"median": 0.5}), keys)


@book.add("a41_subset_vs_all_means", """
WITH a AS (SELECT avg(l_quantity) FILTER (WHERE l_returnflag = 'R') s1, avg(l_quantity) g1, avg(l_discount) FILTER (WHERE l_returnflag = 'R') s2, avg(l_discount) g2 FROM lineitem)
SELECT 'l_quantity' AS feature, round(s1, 6) AS subset_mean, round(g1, 6) AS global_mean, round(s1 - g1, 6) AS difference FROM a
UNION ALL SELECT 'l_discount', round(s2, 6), round(g2, 6), round(s2 - g2, 6) FROM a""")
def _(t):
    d = ag.subset_means(t.lineitem, F.col("l_returnflag") == "R", ["l_quantity", "l_discount"]).orderBy(F.abs("difference").desc())
    return d.select("feature", *[rnd(c).alias(c) for c in ("subset_mean", "global_mean", "difference")])


def _dump(t):
    return t.lineitem.select(F.col("l_suppkey").alias("tree_index"), F.col("l_returnflag").alias("split_feature"),
                             F.col("l_extendedprice").alias("split_gain"), F.col("l_linenumber").alias("node_depth"))


@book.add("a42_gain_share", """
SELECT split_feature, round(sum(g), 6) AS gain_share FROM (SELECT l_returnflag AS split_feature, l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey) AS g FROM lineitem) GROUP BY 1""")
def _(t):
    return ag.gain_share(_dump(t), "tree_index", "split_feature", "split_gain").withColumn("gain_share", rnd("gain_share"))


@book.add("a43_split_usage", f"""
SELECT l_returnflag AS split_feature, {', '.join(f"round(count(*) FILTER (WHERE l_linenumber = {d}) / pow(2, {d} - 1), 6) AS depth_{d}" for d in range(1, 8))} FROM lineitem GROUP BY 1""")
def _(t):
    d = ag.split_usage(_dump(t), "split_feature", "node_depth", list(range(1, 8)))
    return d.select("split_feature", *[rnd(f"depth_{i}").alias(f"depth_{i}") for i in range(1, 8)])


@book.add("a44_most_recent_value", f"WITH {ACTIONS} SELECT user_id, arg_max(cluster, (ts, event_id)) AS recent_cluster FROM actions GROUP BY 1")
def _(t):
    return t.actions.groupBy("user_id").agg(F.max_by("cluster", F.struct("ts", "event_id")).alias("recent_cluster"))


@book.add("a45_top_three_sum", RANKED + "SELECT user_id, CAST(sum(n) FILTER (WHERE rk <= 3) AS BIGINT) AS top3_sum, max(n) AS mode_count FROM r GROUP BY 1")
def _(t):
    d = cat.top_arrays(t.actions, ["user_id"], "cluster", 3, "v", "c")
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("user_id", total.alias("top3_sum"), F.get("c", F.lit(0)).alias("mode_count"))
