"""Joins (J). J14, a nearest-neighbour join, is registered with the kNN queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SCORED, SEARCHES, Book, cents, rnd
from featherloom.functions.dates import whole_days
from featherloom.operators import joins
from featherloom.operators.stats import join_groups

book = Book()


@book.add("j01_inner_fact_dimension", """
SELECT l_orderkey, l_linenumber, p_brand, p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    return t.lineitem.join(dim, "l_partkey").select("l_orderkey", "l_linenumber", "p_brand", "p_retailprice")


@book.add("j02_left", """
SELECT c_custkey, count(o_orderkey) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def _(t):
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), cents("o_totalprice").alias("total"))
    return t.customer.join(sums, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "total")


@book.add("j03_full_outer_suffixed", """
WITH a AS (SELECT user_id, count(*) n, max(value) top FROM events WHERE event_type = 'click' AND value > 40 GROUP BY 1),
b AS (SELECT user_id, count(*) n, max(value) top FROM events WHERE event_type = 'purchase' AND value > 80 GROUP BY 1)
SELECT coalesce(a.user_id, b.user_id) AS user_id, a.n AS n_click, a.top AS top_click, b.n AS n_order, b.top AS top_order
FROM a FULL JOIN b ON a.user_id = b.user_id""")
def _(t):
    def part(kind, floor):
        d = t.events.where((F.col("event_type") == kind) & (F.col("value") > floor))
        return d.groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").alias("top"))

    return joins.full_join({"click": part("click", 40), "order": part("purchase", 80)}, "user_id")


@book.add("j04_left_different_keys", """
SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def _(t):
    return joins.left_lookup(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey", "l_linenumber", "l_quantity")


@book.add("j04_left_deduped_right", """
SELECT c_custkey, s_suppkey, s_acctbal FROM customer LEFT JOIN
(SELECT * FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1) ON c_nationkey = s_nationkey""")
def _(t):
    d = joins.left_lookup(t.customer, t.supplier, "c_nationkey", "s_nationkey", dedupe_by=["s_suppkey"])
    return d.select("c_custkey", "s_suppkey", "s_acctbal")


@book.add("j05_star_chain", """
SELECT r_name, p_type, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(DISTINCT s_suppkey) AS suppliers
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def _(t):
    from featherloom.plans.star import denormalize

    d = denormalize(t.lineitem, t.orders, t.part, t.customer, t.supplier, t.nation, t.region)
    return d.groupBy("r_name", "p_type").agg(
        F.count("*").alias("n"), rnd(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.countDistinct("s_suppkey").alias("suppliers"))


@book.add("j06_member_flag", """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN 1 ELSE 0 END AS is_train FROM customer""")
def _(t):
    train = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.flag_members(t.customer, train, "c_custkey", "is_train").select("c_custkey", "is_train")


@book.add("j07_anti_ids", """
SELECT DISTINCT o_custkey AS id FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def _(t):
    ids = t.orders.withColumnRenamed("o_custkey", "id")
    return joins.keys_not_in(ids, ids.where("o_totalprice > 400000"), "id")


@book.add("j08_semi_top_entities", """
SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 20)""")
def _(t):
    return t.events.join(joins.top_entities(t.events, "user_id", 20), "user_id", "left_semi").select("event_id", "user_id")


@book.add("j09_group_count_back", """
SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_suppkey) AS merchant_freq,
  CASE WHEN count(*) OVER (PARTITION BY l_suppkey) > 600 THEN 1 ELSE 0 END AS is_popular FROM lineitem""")
def _(t):
    freq = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("merchant_freq"))
    d = join_groups(t.lineitem, freq, ["l_suppkey"])
    return d.select("l_orderkey", "l_linenumber", "merchant_freq", (F.col("merchant_freq") > 600).cast("int").alias("is_popular"))


@book.add("j10_share_of_total", f"""WITH {ACTIONS}
SELECT user_id, widget, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 6) AS share
FROM actions WHERE widget IS NOT NULL GROUP BY 1, 2""")
def _(t):
    counts = t.actions.where("widget is not null").groupBy("user_id", "widget").agg(F.count("*").alias("n"))
    return joins.share_of_total(counts, ["user_id"], "n", "share").withColumn("share", rnd("share"))


GRID = "cells AS (SELECT date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS x, hour(ts) AS y, count(*) AS n FROM events GROUP BY 1, 2)"


@book.add("j11_grid_neighbours", f"""WITH {GRID}
SELECT a.x, a.y, a.n, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS around FROM cells a LEFT JOIN cells b
ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) GROUP BY 1, 2, 3""")
def _(t):
    cells = t.events.groupBy(F.datediff("ts", F.lit("2024-01-01").cast("date")).cast("long").alias("x"),
                             F.hour("ts").cast("long").alias("y")).agg(F.count("*").alias("n"))
    return joins.neighbour_sum(cells, "x", "y", "n", "around")


@book.add("j12_nearest_centre", """
WITH c AS (SELECT min(o_totalprice) AS centre, o_custkey % 40 AS model FROM orders GROUP BY 2)
SELECT o_orderkey, arg_min(centre, (abs(centre - o_totalprice), centre)) AS centre, arg_min(model, (abs(centre - o_totalprice), centre, model)) AS model
FROM orders, c GROUP BY 1""")
def _(t):
    zones = t.orders.groupBy((F.col("o_custkey") % 40).alias("model")).agg(F.min("o_totalprice").alias("centre"))
    return joins.nearest_lookup(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", zones, "centre", ["model"]).drop("o_totalprice")


@book.add("j13_range_bins", """
WITH b AS (SELECT p_size * 1000.0::DOUBLE AS hi, (p_size - 0.75) * 1000.0::DOUBLE AS lo, 'size_' || p_size AS label FROM (SELECT DISTINCT p_size FROM part))
SELECT l_orderkey * 10 + l_linenumber AS line, label FROM lineitem LEFT JOIN b ON l_extendedprice > lo AND l_extendedprice <= hi""")
def _(t):
    sizes = t.part.select("p_size").distinct()
    bins = sizes.select(((F.col("p_size") - 0.75) * 1000.0).alias("lo"), (F.col("p_size") * 1000.0).alias("hi"),
                        F.concat(F.lit("size_"), F.col("p_size").cast("string")).alias("label"))
    lines = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), "l_extendedprice")
    return joins.range_lookup(lines, "l_extendedprice", bins, "lo", "hi", "label").select("line", "label")


@book.add("j15_blend_by_id", f"""WITH {SCORED} SELECT doc_id, round(0.65 * p1 + 0.35 * p2, 6) AS p FROM scored""")
def _(t):
    a = t.scored.select("doc_id", F.col("p1").alias("p"))
    b = t.scored.select("doc_id", F.col("p2").alias("p"))
    return joins.weighted_blend([(a, 0.65), (b, 0.35)], "doc_id", "p").withColumn("p", rnd("p"))


@book.add("j16_checked_pairs", f"""WITH {SCORED} SELECT doc_id, y, p1 FROM scored""")
def _(t):
    return joins.checked_pairs(t.scored.select("doc_id", "y"), t.scored.select("doc_id", "p1"), "doc_id")


@book.add("j17_search_matches", f"""WITH {ACTIONS}, {SEARCHES},
first_search AS (SELECT user_id, cluster, min(ts) AS first_ts FROM searches GROUP BY 1, 2)
SELECT user_id, count(DISTINCT CASE WHEN first_ts IS NOT NULL THEN cluster END) AS matching_clusters,
  round(avg(CAST(trunc((epoch_us(ts) - epoch_us(first_ts)) / 86400000000) AS BIGINT)), 6) AS mean_days
FROM actions LEFT JOIN first_search USING (user_id, cluster) GROUP BY 1""")
def _(t):
    from featherloom.plans.shop import search_matches

    return search_matches(t.actions, t.searches).withColumn("mean_days", rnd("mean_days"))


@book.add("j18_inner_predictions", f"""WITH {SCORED} SELECT doc_id, source, p1 FROM documents JOIN scored USING (doc_id)""")
def _(t):
    return t.documents.select("doc_id", "source").join(t.scored.select("doc_id", "p1"), "doc_id")
