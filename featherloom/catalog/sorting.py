"""Sort, limit and top-k (T) and set operations (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SCORED, Book, rnd
from featherloom.operators import reshape
from featherloom.operators.joins import keys_not_in, top_entities
from featherloom.operators.ordered import positions
from featherloom.operators.stats import with_stats

book = Book()


@book.add("t01_multi_key_sort", "SELECT o_orderkey, o_orderpriority, o_totalprice, row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS pos FROM orders")
def _(t):
    d = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    d = positions(d, [], ["o_orderpriority", "-o_totalprice", "o_orderkey"])
    return d.orderBy(F.asc("o_orderpriority"), F.desc_nulls_last("o_totalprice"), "o_orderkey")


@book.add("t02_sort_by_function", "SELECT event_id, value FROM events ORDER BY abs(value - 100) DESC, event_id LIMIT 50")
def _(t):
    return t.events.select("event_id", "value").orderBy(F.abs(F.col("value") - 100).desc(), "event_id").limit(50)


@book.add("t03_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 3")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(3)


@book.add("t03_rows_at_positions", "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders) WHERE pos IN (4, 5, 9)")
def _(t):
    d = positions(t.orders.select("o_orderkey", "o_totalprice"), [], ["o_orderkey"])
    return d.where(F.col("pos").isin(4, 5, 9)).drop("pos")


@book.add("t04_top_entities", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 25")
def _(t):
    return top_entities(t.lineitem, "l_partkey", 25)


@book.add("t05_top_per_group", "SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3")
def _(t):
    d = t.events.select("user_id", "event_id", "value")
    return reshape.top_per_group(d, ["user_id"], [F.desc("value"), F.asc("event_id")], 3).drop("rank")


@book.add("t06_worst_predictions", f"WITH {SCORED} SELECT doc_id, y, p1, round(abs(y - p1), 6) AS error FROM scored ORDER BY abs(y - p1) DESC, doc_id LIMIT 5")
def _(t):
    d = t.scored.select("doc_id", "y", "p1", F.abs(F.col("y") - F.col("p1")).alias("error"))
    return d.orderBy(F.desc("error"), "doc_id").limit(5).withColumn("error", rnd("error"))


@book.add("t07_top_words", r"""
SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(trim(text)), '[ \t\n\r\f\x0B]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1 ORDER BY n DESC, word LIMIT 30""")
def _(t):
    return reshape.top_words(t.documents, "text", 30)


@book.add("t08_top_features", """
SELECT p_type AS feature, round(avg(l_extendedprice), 3) AS importance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY avg(l_extendedprice) DESC, 1 LIMIT 3""")
def _(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    d = d.groupBy(F.col("p_type").alias("feature")).agg(F.avg("l_extendedprice").alias("importance"))
    return d.orderBy(F.desc("importance"), "feature").limit(3).withColumn("importance", rnd("importance", 3))


@book.add("u01_stack_with_flag", """
SELECT part, count(*) AS n, count(target) AS n_target FROM (SELECT 'train' AS part, o_orderkey, o_totalprice AS target FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL SELECT 'test', o_orderkey, NULL FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01') GROUP BY 1""")
def _(t):
    cut = F.lit("1999-01-01").cast("timestamp")
    train = t.orders.where(F.col("o_orderdate") < cut).select("o_orderkey", F.col("o_totalprice").alias("target"))
    test = t.orders.where(F.col("o_orderdate") >= cut).select("o_orderkey")
    both = reshape.stack_with_flag({"train": train, "test": test}, "part")
    return both.groupBy("part").agg(F.count("*").alias("n"), F.count("target").alias("n_target"))


@book.add("u02_fold_outputs", f"WITH {SCORED} SELECT doc_id, CAST(doc_id % 5 AS INT) AS fold, p1 FROM scored ORDER BY doc_id")
def _(t):
    # fold outputs are one table with a fold column, so nothing has to be stacked
    return t.scored.select("doc_id", (F.col("doc_id") % 5).cast("int").alias("fold"), "p1").orderBy("doc_id")


@book.add("u03_side_by_side", f"WITH {SCORED} SELECT d.doc_id, d.lang, s.p1 FROM documents d JOIN scored s ON d.doc_id = s.doc_id")
def _(t):
    return t.documents.select("doc_id", "lang").join(t.scored.select("doc_id", "p1"), "doc_id")


@book.add("u04_id_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def _(t):
    return t.documents.select("doc_id").subtract(t.labels.select("doc_id"))


@book.add("u05_value_intersection", "SELECT l_partkey AS id FROM lineitem INTERSECT SELECT o_custkey FROM orders")
def _(t):
    return t.lineitem.select(F.col("l_partkey").alias("id")).intersect(t.orders.select(F.col("o_custkey").alias("id")))


@book.add("u06_distinct_values", f"WITH {ACTIONS} SELECT DISTINCT widget FROM actions WHERE widget IS NOT NULL")
def _(t):
    return t.actions.where("widget is not null").select("widget").distinct()


@book.add("u07_first_row_per_subset", "SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1")
def _(t):
    d = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")
    return reshape.first_rows(d, ["o_custkey", "o_orderstatus"], ["o_orderkey"])


@book.add("u08_append_and_delete", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey <> 3 UNION ALL SELECT 99, 'NEW', 1")
def _(t):
    more = reshape.add_row(t.nation, {"n_nationkey": 99, "n_name": "NEW", "n_regionkey": 1})
    return reshape.remove_key(more, "n_nationkey", 3)
