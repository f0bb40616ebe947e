"""Sampling and splits (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import Book, uniform_sql
from featherloom.operators import splits as sp

book = Book()


def _o(t):
    return t.orders.select("o_orderkey", "o_orderstatus")


U = uniform_sql("o_orderkey", 11)


@book.add("x01_exact_split", f"SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (ORDER BY {U}, o_orderkey) <= floor((SELECT count(*) FROM orders) * (1 - 0.3::DOUBLE)) THEN 1 ELSE 0 END AS is_train FROM orders")
def _(t):
    return sp.exact_split(_o(t), "o_orderkey", 0.3, 11)


@book.add("x02_stratified_split", f"SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {U}, o_orderkey) <= floor(count(*) OVER (PARTITION BY o_orderstatus) * (1 - 0.2::DOUBLE)) THEN 1 ELSE 0 END AS is_train FROM orders")
def _(t):
    return sp.stratified_split(_o(t), "o_orderkey", "o_orderstatus", 0.2, 11)


@book.add("x03_random_folds", f"SELECT o_orderkey, o_orderstatus, CAST(floor({U} * 5) AS INT) AS fold FROM orders")
def _(t):
    return sp.random_folds(_o(t), "o_orderkey", 5, 11)


@book.add("x04_stratified_folds", "SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) % 5 AS INT) AS fold FROM orders")
def _(t):
    return sp.stratified_folds(_o(t), "o_orderkey", "o_orderstatus", 5)



@book.add("x05_sample_share", f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {U} < 0.25")
def _(t):
    return sp.sample_rows(_o(t), "o_orderkey", 0.25, 11)


@book.add("x04_shuffled_stratified_folds", f"SELECT o_orderkey, o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {U}, o_orderkey) - 1) % 5 AS INT) AS fold FROM orders")
def _(t):
    return sp.stratified_folds(_o(t), "o_orderkey", "o_orderstatus", 5, seed=11)


@book.add("x05_bootstrap_of_size", f"""
WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos, count(*) OVER () AS n FROM orders),
d AS (SELECT i AS draw, CAST(floor({uniform_sql('i', 11)} * (SELECT count(*) FROM orders)) AS BIGINT) + 1 AS pick FROM range(0, 2000) r(i))
SELECT draw, o_orderkey FROM d JOIN p ON pos = pick""")
def _(t):
    return sp.bootstrap_n(t.orders.select("o_orderkey"), "o_orderkey", 2000, 11)


DRAWS = "CASE " + " ".join(f"WHEN {U} < {e!r}::DOUBLE THEN {n}" for n, e in enumerate(sp.poisson_edges(0.8))) + f" ELSE {len(sp.poisson_edges(0.8))} END"


@book.add("x05_sample_with_replacement", f"SELECT o_orderkey, CAST({DRAWS} AS BIGINT) AS drawn FROM orders WHERE {DRAWS} > 0")
def _(t):
    d = sp.sample_rows(_o(t), "o_orderkey", 0.8, 11, replacement=True)
    return d.groupBy("o_orderkey").agg(F.count("*").alias("drawn"))


@book.add("x06_sample_n", f"SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {U}, o_orderkey LIMIT 500")
def _(t):
    return sp.sample_n(_o(t), "o_orderkey", 500, 11)


@book.add("x07_one_per_class", f"SELECT o_orderstatus, arg_min(o_orderkey, ({U}, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def _(t):
    return sp.one_per_class(_o(t), "o_orderkey", "o_orderstatus", 11)


@book.add("x08_group_folds", f"SELECT event_id, user_id, CAST(floor({uniform_sql('user_id', 3)} * 4) AS INT) AS fold FROM events")
def _(t):
    return sp.random_folds(t.events.select("event_id", "user_id"), "user_id", 4, 3)


@book.add("x08_time_folds", "SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) * 6 / (SELECT count(*) FROM events)) AS INT) AS fold FROM events")
def _(t):
    return sp.time_folds(t.events.select("event_id", "ts"), "ts", "event_id", 5).drop("ts")


@book.add("x09_shuffle", f"SELECT o_orderkey, row_number() OVER (ORDER BY {U}, o_orderkey) AS pos FROM orders")
def _(t):
    return sp.shuffled(t.orders.select("o_orderkey"), "o_orderkey", 11)


@book.add("x10_bernoulli_flag", f"SELECT o_orderkey, CASE WHEN {U} < 0.1 THEN 1 ELSE 0 END AS flag FROM orders")
def _(t):
    return t.orders.select("o_orderkey", sp.bernoulli("o_orderkey", 0.1, 11).alias("flag"))


@book.add("x11_capped_per_class", f"SELECT o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY {U}, o_orderkey) <= CASE o_orderstatus WHEN 'O' THEN 300 WHEN 'F' THEN 50 ELSE 0 END")
def _(t):
    return sp.capped_per_class(_o(t), "o_orderkey", "o_orderstatus", {"O": 300, "F": 50}, 11)
