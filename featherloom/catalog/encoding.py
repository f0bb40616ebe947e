"""Encoding and preparation (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SCORED, Book, rnd, uniform_sql
from featherloom.functions.strings import join_text
from featherloom.operators import encode as enc
from featherloom.operators.ordered import positions
from featherloom.operators.rules import match_rules

book = Book()
AMOUNTS = "a AS (SELECT o_orderkey, o_totalprice AS x, (SELECT min(o_totalprice) FROM orders) AS lo, (SELECT max(o_totalprice) FROM orders) AS hi FROM orders)"


def _edges_sql(op):
    return " + ".join(f"CAST(x {op} lo + (hi - lo) * {i} / 10.0::DOUBLE AS INT)" for i in range(1, 10))


@book.add("e01_equal_width_right", f"WITH {AMOUNTS} SELECT o_orderkey, {_edges_sql('>')} AS bin FROM a")
def _(t):
    return enc.equal_width_bin(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "bin").drop("o_totalprice")


@book.add("e02_equal_width_left", f"WITH {AMOUNTS} SELECT o_orderkey, {_edges_sql('>=')} AS bin FROM a")
def _(t):
    return enc.equal_width_bin(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "bin", right_closed=False).drop("o_totalprice")


@book.add("e03_labelled_bins", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'low' WHEN l_quantity <= 20 THEN 'middle' WHEN l_quantity <= 45 THEN 'high' END AS band FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", enc.labelled_bin(F.col("l_quantity"), [0, 10, 20, 45], ["low", "middle", "high"]).alias("band"))


DECILES = """q AS (SELECT list_sort(list_distinct(quantile_cont({x}, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM {src})"""


@book.add("e04_quantile_bins", f"WITH {DECILES.format(x='l_quantity', src='lineitem')} SELECT l_orderkey, l_linenumber, CAST(greatest(len(list_filter(e, lambda v: v < l_quantity)) - 1, 0) AS INT) AS decile FROM lineitem, q")
def _(t):
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return enc.quantile_bin(d, "l_quantity", "decile").drop("l_quantity")


@book.add("e05_one_hot", "SELECT event_id, " + ", ".join(f"CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END AS is_{v}" for v in ("click", "view", "purchase")) + " FROM events")
def _(t):
    return t.events.select("event_id", *enc.one_hot("event_type", ["click", "view", "purchase"], "is"))


@book.add("e06_label_encode", """
WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part WHERE p_size <= 3))
SELECT p_partkey, coalesce(code, -1) AS brand_code FROM part LEFT JOIN c USING (p_brand)""")
def _(t):
    codes = enc.sorted_codes(t.part.where("p_size <= 3"), "p_brand")
    return enc.encode_with(t.part.select("p_partkey", "p_brand"), codes, "p_brand", "brand_code").drop("p_brand")


@book.add("e07_factorize", """
WITH c AS (SELECT p_name, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS code FROM part GROUP BY 1) SELECT p_partkey, code FROM part JOIN c USING (p_name)""")
def _(t):
    codes = enc.first_seen_codes(t.part, "p_name", "p_partkey")
    return enc.encode_with(t.part.select("p_partkey", "p_name"), codes, "p_name", "code").drop("p_name")


@book.add("e08_ordinal_encode", """
WITH c AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS code FROM (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02'))
SELECT event_id, coalesce(code, -1) AS code FROM events LEFT JOIN c USING (user_id)""")
def _(t):
    codes = enc.sorted_codes(t.events.where(F.col("ts") < F.lit("2024-01-02").cast("timestamp")), "user_id")
    return enc.encode_with(t.events.select("event_id", "user_id"), codes, "user_id", "code").drop("user_id")


EB = "CASE WHEN {n} IS NULL OR {n} = 0 THEN {gs} / {gn} ELSE coalesce((({gss}/{gn} - ({gs}/{gn})**2) * {n}) / nullif((({gss}/{gn} - ({gs}/{gn})**2) * {n}) + greatest({ss}/{n} - ({s}/{n})**2, 0), 0) * ({s}/{n}) + (1 - (({gss}/{gn} - ({gs}/{gn})**2) * {n}) / nullif((({gss}/{gn} - ({gs}/{gn})**2) * {n}) + greatest({ss}/{n} - ({s}/{n})**2, 0), 0)) * ({gs}/{gn}), {gs}/{gn}) END"


@book.add("e09_target_encode_out_of_fold", f"""
WITH d AS (SELECT o_orderkey, o_custkey AS v, o_orderkey % 5 AS f, o_totalprice / 1000 AS y FROM orders),
p AS (SELECT v, f, count(*)::DOUBLE n, sum(y) s, sum(y * y) ss FROM d GROUP BY 1, 2), tv AS (SELECT v, sum(n) n, sum(s) s, sum(ss) ss FROM p GROUP BY 1),
tf AS (SELECT f, sum(n) n, sum(s) s, sum(ss) ss FROM p GROUP BY 1), g AS (SELECT sum(n) n, sum(s) s, sum(ss) ss FROM p),
r AS (SELECT p.v, p.f, tv.n - p.n AS n, tv.s - p.s AS s, tv.ss - p.ss AS ss, g.n - tf.n AS gn, g.s - tf.s AS gs, g.ss - tf.ss AS gss FROM p JOIN tv USING (v) JOIN tf ON tf.f = p.f, g)
SELECT d.o_orderkey, round({EB.format(n='r.n', s='r.s', ss='r.ss', gn='gn', gs='gs', gss='gss')}, 6) AS encoded FROM d JOIN r ON r.v = d.v AND r.f = d.f""")
def _(t):
    d = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 5).alias("fold"), (F.col("o_totalprice") / 1000).alias("y"))
    return enc.target_encode_out_of_fold(d, "o_custkey", "y", "fold", "encoded").select("o_orderkey", rnd("encoded").alias("encoded"))


@book.add("e09_target_encode_test", f"""
WITH tr AS (SELECT o_custkey AS v, o_totalprice / 1000 AS y FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
p AS (SELECT v, count(*)::DOUBLE n, sum(y) s, sum(y * y) ss FROM tr GROUP BY 1), g AS (SELECT count(*)::DOUBLE gn, sum(y) gs, sum(y * y) gss FROM tr)
SELECT o_orderkey, round({EB.format(n='n', s='s', ss='ss', gn='gn', gs='gs', gss='gss')}, 6) AS encoded FROM orders LEFT JOIN p ON v = o_custkey, g WHERE o_orderdate >= TIMESTAMP '1996-01-01'""")
def _(t):
    cut = F.lit("1996-01-01").cast("timestamp")
    d = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", (F.col("o_totalprice") / 1000).alias("y"))
    out = enc.target_encode(d.where(F.col("o_orderdate") < cut), d.where(F.col("o_orderdate") >= cut), "o_custkey", "y", "encoded")
    return out.select("o_orderkey", rnd("encoded").alias("encoded"))


@book.add("e10_category_combinations", """
WITH c AS (SELECT o_orderkey, o_orderstatus || '_' || o_orderpriority || '_' || year(o_orderdate) AS combo FROM orders),
k AS (SELECT combo, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS code FROM c GROUP BY 1) SELECT o_orderkey, combo, code FROM c JOIN k USING (combo)""")
def _(t):
    d = t.orders.select("o_orderkey", join_text("_", F.col("o_orderstatus"), F.col("o_orderpriority"), F.year("o_orderdate")).alias("combo"))
    return enc.encode_with(d, enc.first_seen_codes(d, "combo", "o_orderkey"), "combo", "code")


@book.add("e11_pair_top_n", """
WITH c AS (SELECT p_partkey, p_brand || '_' || p_type AS pair FROM part), k AS (SELECT pair FROM c GROUP BY 1 ORDER BY count(*) DESC, pair LIMIT 20)
SELECT p_partkey, CASE WHEN pair IN (SELECT pair FROM k) THEN pair ELSE 'other' END AS pair FROM c""")
def _(t):
    d = t.part.select("p_partkey", join_text("_", F.col("p_brand"), F.col("p_type")).alias("pair"))
    return enc.keep_top(d, "pair", 20)


@book.add("e12_class_weights_by_bin", f"""WITH {SCORED}, {DECILES.format(x='x', src='scored')},
b AS (SELECT doc_id, y, greatest(len(list_filter(e, lambda v: v < x)) - 1, 0) AS bin FROM scored, q)
SELECT doc_id, round(CASE WHEN y = 1 AND count(*) FILTER (WHERE y = 0) OVER (PARTITION BY bin) >= 3
  THEN count(*) FILTER (WHERE y = 0) OVER (PARTITION BY bin) / count(*) FILTER (WHERE y = 1) OVER (PARTITION BY bin) ELSE 1 END, 6) AS weight FROM b""")
def _(t):
    d = enc.quantile_bin(t.scored.select("doc_id", "y", "x"), "x", "bin")
    return enc.class_weights_by_bin(d, "bin", "y", "weight", min_zeros=3).select("doc_id", rnd("weight").alias("weight"))


@book.add("e12_class_weights_by_category", f"""WITH {SCORED}, top AS (SELECT lang FROM scored WHERE y = 1 GROUP BY 1 ORDER BY count(*) DESC, lang LIMIT 2),
b AS (SELECT doc_id, y, CASE WHEN lang IN (SELECT lang FROM top) THEN lang ELSE 'other' END AS bin FROM scored)
SELECT doc_id, round(CASE WHEN y = 1 AND count(*) FILTER (WHERE y = 0) OVER (PARTITION BY bin) >= 1 THEN count(*) FILTER (WHERE y = 0) OVER (PARTITION BY bin) / count(*) FILTER (WHERE y = 1) OVER (PARTITION BY bin) ELSE 1 END, 6) AS weight FROM b""")
def _(t):
    from featherloom.operators.joins import top_entities

    s = t.scored.select("doc_id", "y", "lang")
    top = top_entities(s.where("y = 1"), "lang", 2).select(F.col("lang").alias("kept"))
    d = s.join(top, F.col("lang") == F.col("kept"), "left").withColumn("bin", F.coalesce("kept", F.lit("other")))
    return enc.class_weights_by_bin(d, "bin", "y", "weight").select("doc_id", rnd("weight").alias("weight"))


@book.add("e13_dictionary", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS code FROM orders")
def _(t):
    return t.orders.select("o_orderkey", enc.map_values(F.col("o_orderstatus"), {"O": 0, "F": 1}).alias("code"))


@book.add("e14_fill_constant", f"WITH {ACTIONS} SELECT event_id, coalesce(widget, -1) AS widget, coalesce(CASE WHEN action <> 'error' THEN action END, 'missing') AS action FROM actions")
def _(t):
    d = t.actions.select("event_id", "widget", F.when(F.col("action") != "error", F.col("action")).alias("action"))
    return d.fillna({"widget": -1, "action": "missing"})


@book.add("e15_fill_by_name", """
SELECT user_id, coalesce(num_big, 0) AS num_big, strftime(coalesce(last_big_time, TIMESTAMP '2024-01-01'), '%Y-%m-%d') AS last_day, coalesce(round(ratio, 6), -999) AS ratio FROM (
SELECT user_id, nullif(count(*) FILTER (WHERE value > 150), 0) AS num_big, max(ts) FILTER (WHERE value > 150) AS last_big_time, avg(value) FILTER (WHERE value > 150) AS ratio FROM events GROUP BY 1)""")
def _(t):
    big = F.col("value") > 150
    d = t.events.groupBy("user_id").agg(
        F.nullif(F.count_if(big), F.lit(0)).alias("num_big"), F.max(F.when(big, F.col("ts"))).alias("last_big_time"), F.avg(F.when(big, F.col("value"))).alias("ratio"))
    d = enc.fill_by_name(d.withColumn("ratio", rnd("ratio")), other_number=-999.0)
    return d.select("user_id", "num_big", F.date_format("last_big_time", "yyyy-MM-dd").alias("last_day"), "ratio")


@book.add("e16_fill_mean_with_flag", f"WITH {ACTIONS}, a AS (SELECT event_id, CASE WHEN widget IS NOT NULL THEN value END AS x FROM actions) SELECT event_id, round(coalesce(x, avg(x) OVER ()), 6) AS x, CASE WHEN x IS NULL THEN 1 ELSE 0 END AS NA_x FROM a")
def _(t):
    d = t.actions.select("event_id", F.when(F.col("widget").isNotNull(), F.col("value")).alias("x"))
    return enc.fill_mean_with_flag(d, ["x"]).withColumn("x", rnd("x"))


@book.add("e17_fill_median_and_mode", f"""WITH {ACTIONS}, a AS (SELECT event_id, CASE WHEN widget IS NOT NULL THEN value END AS x, widget FROM actions),
m AS (SELECT widget AS mode FROM a WHERE widget IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, widget LIMIT 1)
SELECT event_id, round(coalesce(x, (SELECT median(x) FROM a)), 6) AS x, coalesce(widget, (SELECT mode FROM m)) AS widget FROM a""")
def _(t):
    d = t.actions.select("event_id", F.when(F.col("widget").isNotNull(), F.col("value")).alias("x"), "widget")
    return enc.fill_mode(enc.fill_median(d, ["x"]), ["widget"]).withColumn("x", rnd("x"))


@book.add("e18_standard_scale", "SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS z FROM orders")
def _(t):
    return enc.standard_scale(t.orders.select("o_orderkey", F.col("o_totalprice").alias("z")), ["z"]).withColumn("z", rnd("z"))


@book.add("e19_min_max_scale", "SELECT l_orderkey, l_linenumber, round((l_tax - min(l_tax) OVER ()) / (max(l_tax) OVER () - min(l_tax) OVER ()), 6) AS l_tax, round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity FROM lineitem")
def _(t):
    d = enc.min_max_scale(t.lineitem.select("l_orderkey", "l_linenumber", "l_tax", "l_quantity"), ["l_tax", "l_quantity"])
    return d.withColumns({"l_tax": rnd("l_tax"), "l_quantity": rnd("l_quantity")})


@book.add("e20_uniform_quantiles", """
WITH tr AS (SELECT l_extendedprice AS x FROM lineitem WHERE l_returnflag = 'A'),
m AS (SELECT x, (2 * sum(count(*)) OVER (ORDER BY x) - count(*) - 1) / (2 * (sum(count(*)) OVER () - 1))::DOUBLE AS u FROM tr GROUP BY 1),
r AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS x FROM lineitem WHERE l_returnflag <> 'A')
SELECT l_orderkey, l_linenumber, round(CASE WHEN a.x = r.x THEN a.u WHEN a.x IS NULL THEN 0 WHEN b.x IS NULL THEN 1 ELSE a.u + (r.x - a.x) / nullif(b.x - a.x, 0) * (b.u - a.u) END, 6) AS u
FROM r ASOF LEFT JOIN m a ON r.x >= a.x ASOF LEFT JOIN m b ON r.x <= b.x""")
def _(t):
    train = t.lineitem.where("l_returnflag = 'A'")
    rest = t.lineitem.where("l_returnflag <> 'A'").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return enc.uniform_quantiles(train, rest, "l_extendedprice", "u").select("l_orderkey", "l_linenumber", rnd("u").alias("u"))


RULES = [("the", 1), ("ing", 2), ("tion", 3), ("der|die|das", 4), ("eaux", 5)]


@book.add("e21_keyword_rules", "SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN {c}" for p, c in reversed(RULES)) + " ELSE -1 END AS cluster FROM documents")
def _(t):
    return t.documents.select("doc_id", enc.keyword_rules(F.col("text"), RULES).alias("cluster"))


# every different word of the benchmark is a rule: its place in the alphabet is the priority; every third one must start a word
RULE_SQL = r"""words AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS needs FROM benchmark),
rules AS (SELECT row_number() OVER (ORDER BY needs) AS priority, needs FROM words WHERE length(needs) >= 2),
r AS (SELECT priority, needs, CASE WHEN priority % 3 = 0 THEN '(^| )' || needs END AS pattern, CAST(priority * 7919 % 20 AS INT) AS cluster FROM rules)"""


def rule_table(t):
    words = t.benchmark.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("needs")).where("length(needs) >= 2").distinct()
    d = positions(words, [], ["needs"], "priority")
    return d.select("priority", "needs", F.when(F.col("priority") % 3 == 0, F.concat(F.lit("(^| )"), "needs")).alias("pattern"),
                    (F.col("priority") * 7919 % 20).cast("int").alias("cluster"))


@book.add("e21_rule_table", f"""WITH {RULE_SQL}, h AS (SELECT doc_id, arg_max(cluster, priority) AS cluster FROM documents JOIN r
  ON contains(lower(text), needs) AND (pattern IS NULL OR regexp_matches(lower(text), pattern)) GROUP BY 1)
SELECT doc_id, coalesce(cluster, -1) AS cluster FROM documents LEFT JOIN h USING (doc_id)""")
def _(t):
    return match_rules(t.documents.select("doc_id", "text"), "text", rule_table(t)).select("doc_id", "cluster")


@book.add("e22_word_overrides", r"""
WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+')) AS word FROM documents),
r AS (SELECT * FROM (VALUES ('the', 1, 10), ('and', 2, 11), ('is', 3, 12), ('der', 4, 13), ('le', 5, 14)) r(word, priority, cluster))
SELECT d.doc_id, h.cluster FROM documents d LEFT JOIN (SELECT doc_id, arg_max(cluster, (priority, cluster)) AS cluster FROM w JOIN r USING (word) GROUP BY 1) h USING (doc_id)""")
def _(t):
    rules = t.spark.createDataFrame([("the", 1, 10), ("and", 2, 11), ("is", 3, 12), ("der", 4, 13), ("le", 5, 14)], "word string, priority int, cluster int")
    return enc.override_by_word(t.documents.select("doc_id", "text"), "text", rules, "doc_id", "cluster").select("doc_id", "cluster")


@book.add("e23_shadow_features", f"""SELECT o_orderkey, round(sqrt(-2 * ln({uniform_sql('o_orderkey', 7)})) * cos(2 * pi() * {uniform_sql('o_orderkey', 8)}), 6) + 0 AS shadow_normal,
  CAST(floor({uniform_sql('o_orderkey', 9)} * 200) AS INT) AS shadow_200, CAST(floor({uniform_sql('o_orderkey', 10)} * 4) AS INT) AS shadow_4 FROM orders""")
def _(t):
    return enc.shadow_features(t.orders.select("o_orderkey"), "o_orderkey", seed=7).withColumn("shadow_normal", rnd("shadow_normal"))
