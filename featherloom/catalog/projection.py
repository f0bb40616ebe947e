"""Projections, filters and predicates (P)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.catalog.base import ACTIONS, SCORED, Book, rnd
from featherloom.functions import dates, rows, strings
from featherloom.operators.filters import rows_within_quantiles

book = Book()


@book.add("p01_select_rename", "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), "o_totalprice").withColumnRenamed("o_totalprice", "amount")


@book.add("p02_derive_columns", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
  round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS gross FROM lineitem""")
def _(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    d = t.lineitem.withColumns({"net": rnd(net, 4), "gross": rnd(net * (1 + F.col("l_tax")), 6)})
    return d.select("l_orderkey", "l_linenumber", "net", "gross")


@book.add("p03_drop_columns", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    return t.events.drop("ts", "props")


@book.add("p04_select_by_type", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(t):
    return t.part.select(rows.columns_by_type(t.part, T.NumericType))


@book.add("p05_select_by_name", "SELECT o_orderkey, o_orderstatus, o_orderdate::DATE::VARCHAR AS day, o_orderpriority FROM orders")
def _(t):
    d = t.orders.select(rows.columns_by_name(t.orders, r"o_order"))
    return d.withColumn("day", F.to_date("o_orderdate").cast("string")).drop("o_orderdate")


@book.add("p06_clean_names", 'SELECT p_partkey AS "part_key", p_retailprice AS "price__usd_" FROM part')
def _(t):
    messy = t.part.select(F.col("p_partkey").alias("part key"), F.col("p_retailprice").alias("price (usd)"))
    return rows.clean_names(messy)


@book.add("p07_align_to_schema", "SELECT c_custkey, c_acctbal, 0::DOUBLE AS c_bonus FROM customer")
def _(t):
    return rows.align_to(t.customer, T.StructType.fromDDL("c_custkey long, c_acctbal double, c_bonus double"))


@book.add("p08_compare_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'A' AND l_discount < 0.05""")
def _(t):
    keep = (F.col("l_quantity") > 30) & (F.col("l_returnflag") == "A") & (F.col("l_discount") < 0.05)
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@book.add("p09_null_filter", f"""WITH {ACTIONS}
SELECT CASE WHEN widget IS NULL THEN 'missing' ELSE 'present' END AS part, count(*) AS n, count(widget) AS n_value FROM actions GROUP BY 1""")
def _(t):
    a = t.actions
    missing = a.where(F.col("widget").isNull()).withColumn("part", F.lit("missing"))
    present = a.where(F.col("widget").isNotNull()).withColumn("part", F.lit("present"))
    return missing.unionByName(present).groupBy("part").agg(F.count("*").alias("n"), F.count("widget").alias("n_value"))


@book.add("p10_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000")
def _(t):
    return t.orders.where(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


@book.add("p11_isin", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def _(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", "o_orderpriority")


@book.add("p12_day_window_closed", """
SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def _(t):
    return t.events.where(dates.day_window(F.col("ts"), "2024-01-20", 15)).select("event_id", "user_id", "value")


@book.add("p13_day_window_half_open", """
SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-06' AND CAST(ts AS DATE) < DATE '2024-01-21'""")
def _(t):
    return t.events.where(dates.half_open_window(F.col("ts"), "2024-01-21", 15)).select("event_id", "user_id", "value")


@book.add("p14_time_split", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS part, count(*) AS n,
  CAST(sum(CASE WHEN o_orderdate <> TIMESTAMP '1999-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS n_strict FROM orders GROUP BY 1""")
def _(t):
    from featherloom.operators.filters import time_split

    train, test = time_split(t.orders, "o_orderdate", "1999-01-01")
    strict_train, strict_test = time_split(t.orders, "o_orderdate", "1999-01-01", strict=True)

    def size(d, part, name):
        return d.groupBy(F.lit(part).alias("part")).agg(F.count("*").alias(name))

    n = size(train, "train", "n").unionByName(size(test, "test", "n"))
    strict = size(strict_train, "train", "n_strict").unionByName(size(strict_test, "test", "n_strict"))
    return n.join(strict, "part")


@book.add("p15_conditional_value", """
SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'large' END AS size FROM orders""")
def _(t):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when(p < 100000, "small").when(p < 300000, "middle").otherwise("large").alias("size"))


@book.add("p16_null_out_of_range", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS quantity FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when((q < 5) | (q > 45), None).otherwise(q).alias("quantity"))


@book.add("p17_replace_and_map", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'look' ELSE event_type END AS replaced,
  CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 3 END AS mapped FROM events""")
def _(t):
    codes = F.create_map(F.lit("click"), F.lit(1), F.lit("purchase"), F.lit(3))
    d = t.events.select("event_id", F.col("event_type").alias("replaced"), codes[F.col("event_type")].alias("mapped"))
    return d.replace({"view": "look"}, subset=["replaced"])


IF1_SQL = """SELECT *, CASE l_linenumber % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' || CAST(CAST(l_quantity AS INT) AS VARCHAR) || ' '
  WHEN 2 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) || '.0' WHEN 3 THEN 'abc' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS if1 FROM lineitem"""


def _with_if1(t):
    q, k = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 6
    text = (F.when(k == 0, None).when(k == 1, F.concat(F.lit(" "), q, F.lit(" ")))
            .when(k == 2, F.concat(q, F.lit(".0"))).when(k == 3, "abc").otherwise(q))
    return t.lineitem.withColumn("if1", text)


@book.add("p18_parse_guarded_predicate", f"""
SELECT l_orderkey, l_linenumber, if1 FROM ({IF1_SQL})
WHERE regexp_full_match(if1, '\\s*[+-]?\\d+\\s*') AND TRY_CAST(trim(if1) AS BIGINT) > 20 AND TRY_CAST(trim(if1) AS BIGINT) < 40""")
def _(t):
    return _with_if1(t).where(strings.int_between(F.col("if1"), 20, 40)).select("l_orderkey", "l_linenumber", "if1")


@book.add("p19_predicate_by_name", """
SELECT 'large' AS rule, count(*) AS n FROM orders WHERE o_totalprice > 300000
UNION ALL SELECT 'urgent', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(t):
    from featherloom.operators.filters import apply_rule

    rules = {"large": lambda: F.col("o_totalprice") > 300000, "urgent": lambda: F.col("o_orderpriority") == "1-URGENT"}
    parts = [apply_rule(t.orders, rules, name).groupBy(F.lit(name).alias("rule")).agg(F.count("*").alias("n")) for name in rules]
    return parts[0].unionByName(parts[1])


@book.add("p20_skip_header_lines", "SELECT o_orderkey || chr(9) || o_orderstatus AS line FROM orders")
def _(t):
    from featherloom.operators.filters import drop_header_lines
    from featherloom.session import scratch_path

    path = scratch_path(t.spark, "headed_lines")
    t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus").write.options(sep="\t", header=True).csv(path)
    return drop_header_lines(t.spark.read.text(path), "id").select(F.col("value").alias("line"))


@book.add("p21_rule_flag", "SELECT event_id, CASE WHEN value < 5 THEN 1 ELSE 0 END AS hard_call FROM events")
def _(t):
    return t.events.select("event_id", (F.col("value") < 5).cast("int").alias("hard_call"))


@book.add("p22_quantile_row_filter", """
WITH q AS (SELECT quantile_cont(l_quantity, 0.99) a, quantile_cont(l_extendedprice, 0.99) b, quantile_cont(l_tax, 0.99) c FROM lineitem),
k AS (SELECT DISTINCT l_suppkey FROM lineitem, q WHERE l_quantity <= a AND l_extendedprice <= b AND l_tax <= c)
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM k)""")
def _(t):
    d = rows_within_quantiles(t.lineitem, "l_suppkey", ["l_quantity", "l_extendedprice", "l_tax"], 0.99)
    return d.select("l_orderkey", "l_linenumber", "l_suppkey")


@book.add("p23_range_between_columns", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity * 1000 <= l_extendedprice")
def _(t):
    return t.lineitem.where(F.col("l_quantity") * 1000 <= F.col("l_extendedprice")).select("l_orderkey", "l_linenumber")


@book.add("p24_interactions", """
SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS quantity_x_discount, round(l_quantity * l_tax, 6) AS quantity_x_tax FROM lineitem""")
def _(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", rnd(q * F.col("l_discount")).alias("quantity_x_discount"),
                             rnd(q * F.col("l_tax")).alias("quantity_x_tax"))


@book.add("p25_polynomial", """
SELECT l_orderkey, l_linenumber, round(q * q, 6) AS q_sq, round(d * d, 6) AS d_sq, round(q * d, 6) AS q_x_d, round(q * q * q, 6) AS q_cube,
  round(d * d * d, 6) AS d_cube, round(q * q * d, 6) AS q_sq_x_d, round(q * d * d, 6) AS q_x_d_sq
FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d FROM lineitem)""")
def _(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"))
    return d.select("l_orderkey", "l_linenumber", *[rnd(c).alias(n) for n, c in rows.polynomial(["q", "d"], 3).items()])


@book.add("p26_pair_arithmetic", """
SELECT l_orderkey, l_linenumber, round(q + d, 6) AS q_plus_d, round(q - d, 6) + 0 AS q_minus_d, round(q * d, 6) + 0 AS q_times_d,
  round(q / (d + 1e-6), 4) + 0 AS q_over_d, CASE WHEN q * q - d * d >= 0 THEN round(sqrt(q * q - d * d), 6) END AS q_root_d
FROM (SELECT l_orderkey, l_linenumber, l_quantity - 20 AS q, l_discount * 100 AS d FROM lineitem)""")
def _(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 20).alias("q"), (F.col("l_discount") * 100).alias("d"))
    forms = rows.pair_arithmetic(["q", "d"])
    return d.select("l_orderkey", "l_linenumber", *[rnd(c, 4 if "over" in n else 6).alias(n) for n, c in forms.items()])


@book.add("p27_row_mean_subtraction", """
SELECT l_orderkey, l_linenumber, round(l_discount - (l_discount + l_tax) / 2, 6) + 0 AS discount, round(l_tax - (l_discount + l_tax) / 2, 6) + 0 AS tax FROM lineitem""")
def _(t):
    mean = rows.row_mean(["l_discount", "l_tax"])
    return t.lineitem.select("l_orderkey", "l_linenumber", rnd(F.col("l_discount") - mean).alias("discount"), rnd(F.col("l_tax") - mean).alias("tax"))


NULLED = """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 END AS a, CASE WHEN event_id % 3 = 0 THEN 1 END AS b,
  CASE WHEN event_id % 5 = 0 THEN 1 END AS c, CASE WHEN event_id % 7 = 0 THEN 1 END AS d FROM events"""


@book.add("p28_nth_null_label", f"""
SELECT event_id, list_filter([CASE WHEN a IS NULL THEN 'a' END, CASE WHEN b IS NULL THEN 'b' END, CASE WHEN c IS NULL THEN 'c' END,
  CASE WHEN d IS NULL THEN 'd' END], lambda x: x IS NOT NULL)[3] AS third_null FROM ({NULLED})""")
def _(t):
    d = t.events.select("event_id", *[F.when(F.col("event_id") % m == 0, 1).alias(n) for n, m in zip("abcd", (2, 3, 5, 7))])
    return d.select("event_id", rows.nth_null_label(list("abcd"), 3).alias("third_null"))


MODELS = ["m1", "m2", "m3", "m4"]
MODEL_SQL = """SELECT doc_id, (n_chars % 97 + 1) / 100.0::DOUBLE AS m1, (n_chars % 41 + 1) / 50.0::DOUBLE AS m2,
  (n_chars % 13 + 1) / 20.0::DOUBLE AS m3, (n_chars % 7 + 1) / 10.0::DOUBLE AS m4, CAST(n_chars % 4 AS INT) AS pick FROM documents"""


def model_table(t):
    n = F.col("n_chars")
    return t.documents.select(
        "doc_id", *[((n % m + 1) / F.lit(float(s))).alias(c) for c, m, s in zip(MODELS, (97, 41, 13, 7), (100, 50, 20, 10))],
        (n % 4).cast("int").alias("pick"))


@book.add("p29_row_stats", f"""
SELECT doc_id, round((m1 + m2 + m3 + m4) / 4, 6) AS mean, least(m1, m2, m3, m4) AS min, greatest(m1, m2, m3, m4) AS max,
  round(list_median([m1, m2, m3, m4]), 6) AS median, round(list_stddev_samp([m1, m2, m3, m4]), 6) AS std FROM ({MODEL_SQL})""")
def _(t):
    return model_table(t).select(
        "doc_id", rnd(rows.row_mean(MODELS)).alias("mean"), rows.row_min(MODELS).alias("min"), rows.row_max(MODELS).alias("max"),
        rnd(rows.row_median(MODELS)).alias("median"), rnd(rows.row_std(MODELS)).alias("std"))


@book.add("p30_row_rank", f"""
SELECT doc_id, 1 + (CAST(m2 < m1 AS INT) + CAST(m3 < m1 AS INT) + CAST(m4 < m1 AS INT)) + (CAST(m2 = m1 AS INT) + CAST(m3 = m1 AS INT) + CAST(m4 = m1 AS INT)) / 2.0::DOUBLE AS rank_m1,
  1 + (CAST(m2 < m4 AS INT) + CAST(m3 < m4 AS INT) + CAST(m1 < m4 AS INT)) + (CAST(m2 = m4 AS INT) + CAST(m3 = m4 AS INT) + CAST(m1 = m4 AS INT)) / 2.0::DOUBLE AS rank_m4 FROM ({MODEL_SQL})""")
def _(t):
    return model_table(t).select("doc_id", rows.row_rank(MODELS, "m1").alias("rank_m1"), rows.row_rank(MODELS, "m4").alias("rank_m4"))


@book.add("p31_abs_differences", f"""
SELECT doc_id, round(abs(m1 - m2), 6) AS abs_m1_m2, round(abs(m1 - m3), 6) AS abs_m1_m3, round(abs(m2 - m3), 6) AS abs_m2_m3 FROM ({MODEL_SQL})""")
def _(t):
    return model_table(t).select("doc_id", *[rnd(c).alias(n) for n, c in rows.abs_differences(MODELS[:3]).items()])


@book.add("p32_row_entropy", f"""
SELECT doc_id, round(-(m1 / s * ln(m1 / s) + m2 / s * ln(m2 / s) + m3 / s * ln(m3 / s) + m4 / s * ln(m4 / s)), 6) AS entropy
FROM (SELECT *, m1 + m2 + m3 + m4 AS s FROM ({MODEL_SQL}))""")
def _(t):
    return model_table(t).select("doc_id", rnd(rows.row_entropy(MODELS)).alias("entropy"))


@book.add("p33_pick_named_column", f"""
SELECT doc_id, CASE pick WHEN 0 THEN m1 WHEN 1 THEN m2 WHEN 2 THEN m3 ELSE m4 END AS chosen FROM ({MODEL_SQL})""")
def _(t):
    selector = F.concat(F.lit("m"), (F.col("pick") + 1).cast("string"))
    return model_table(t).select("doc_id", rows.pick_named(selector, MODELS).alias("chosen"))


def _pair_sql():
    out = []
    for a in "qd":
        for b in "qd":
            out += [f"round({a}+{b},6)+0 AS {a}_plus_{b}", f"round({a}-{b},6)+0 AS {a}_minus_{b}", f"round({a}*{b},6)+0 AS {a}_times_{b}",
                    f"round(ln(1+abs({a}))-ln(1+abs({b})),6)+0 AS {a}_log_{b}", f"round(sqrt(abs({a}))-sqrt(abs({b})),6)+0 AS {a}_sqrt_{b}",
                    f"round(abs({a}-{b}),6)+0 AS {a}_abs_diff_{b}"]
        out += [f"round(sin({a}),6)+0 AS {a}_sin", f"round(cos({a}),6)+0 AS {a}_cos"]
    return ", ".join(out)


@book.add("p34_pair_functions", f"""
SELECT l_orderkey, l_linenumber, {_pair_sql()}
FROM (SELECT l_orderkey, l_linenumber, l_quantity - 20 AS q, l_discount * 100 AS d FROM lineitem)""")
def _(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 20).alias("q"), (F.col("l_discount") * 100).alias("d"))
    return d.select("l_orderkey", "l_linenumber", *[rnd(c).alias(n) for n, c in rows.pair_functions(["q", "d"]).items()])
