"""Scalar functions (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, Book, rnd
from featherloom.functions import arrays, dates, numbers, strings
from featherloom.operators import reshape
from featherloom.operators.quantiles import column_quantiles
from featherloom.operators.stats import with_stats

book = Book()


@book.add("f01_zero_pad", "SELECT p_partkey, CASE WHEN length(p_size::VARCHAR) >= 4 THEN p_size::VARCHAR ELSE lpad(p_size::VARCHAR, 4, '0') END AS code, CASE WHEN length(p_partkey::VARCHAR) >= 3 THEN p_partkey::VARCHAR ELSE lpad(p_partkey::VARCHAR, 3, '0') END AS long_code FROM part")
def _(t):
    return t.part.select("p_partkey", strings.zero_pad(F.col("p_size"), 4).alias("code"), strings.zero_pad(F.col("p_partkey"), 3).alias("long_code"))


@book.add("f02_digits_and_slices", """
SELECT o_orderkey, CAST(substr(c, 1, 1) AS INT) AS digit_0, CAST(substr(c, 4, 1) AS INT) AS digit_3, substr(c, 1, 2) AS pair_01, substr(c, 2, 2) AS pair_12, substr(c, 3, 2) AS pair_23, substr(c, 1, 3) AS triplet_012, substr(c, 2, 3) AS triplet_123
FROM (SELECT o_orderkey, lpad((o_custkey % 10000)::VARCHAR, 4, '0') AS c FROM orders)""")
def _(t):
    c = strings.zero_pad(F.col("o_custkey") % 10000, 4)
    cuts = {"pair_01": (0, 2), "pair_12": (1, 3), "pair_23": (2, 4), "triplet_012": (0, 3), "triplet_123": (1, 4)}
    return t.orders.select("o_orderkey", *[strings.slice_text(c, i, i + 1).cast("int").alias(f"digit_{i}") for i in (0, 3)],
                           *[strings.slice_text(c, a, b).alias(n) for n, (a, b) in cuts.items()])


@book.add("f03_split_to_columns", "SELECT p_partkey, split_part(p_name, ' ', 1) AS first, nullif(split_part(p_name, ' ', 2), '') AS second, CASE WHEN len(string_split(p_name, ' ')) > 2 THEN split_part(p_name, ' ', 3) END AS third FROM part")
def _(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", *[strings.split_part(n, " ", i).alias(c) for i, c in enumerate(("first", "second", "third"))])


@book.add("f04_capitalize", "SELECT p_partkey, upper(substr(p_name, 1, 1)) || lower(substr(p_name, 2)) AS name, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS type FROM part")
def _(t):
    return t.part.select("p_partkey", strings.capitalize(F.col("p_name")).alias("name"), strings.capitalize(F.col("p_type")).alias("type"))


@book.add("f05_extract_letters", r"SELECT page_id, trim(regexp_extract(replace(url, 'http://', '<'), '([a-zA-Z\s]+)', 1)) AS word FROM pages")
def _(t):
    return t.pages.select("page_id", strings.letters(F.replace("url", F.lit("http://"), F.lit("<"))).alias("word"))


@book.add("f06_contains_any", "SELECT doc_id, regexp_matches(lower(text), '(^| )(the|der|le) ') AS hit FROM documents")
def _(t):
    return t.documents.select("doc_id", strings.contains_any(F.col("text"), "(^| )(the|der|le) ").alias("hit"))


@book.add("f07_text_measures", r"SELECT doc_id, regexp_matches(text, '[0-9]') AS has_digit, length(text) AS chars, len(string_split(text, ' ')) AS words FROM documents")
def _(t):
    x = F.col("text")
    return t.documents.select("doc_id", strings.has_digit(x).alias("has_digit"), F.char_length(x).alias("chars"), strings.word_count(x).alias("words"))


@book.add("f08_join_text", f"WITH {ACTIONS} SELECT event_id, action || '_' || coalesce(widget::VARCHAR, 'nan') || '_' || cluster AS combo FROM actions")
def _(t):
    return t.actions.select("event_id", strings.join_text("_", F.col("action"), F.col("widget"), F.col("cluster")).alias("combo"))


@book.add("f09_fixed_decimals", "SELECT l_orderkey, l_linenumber, format('{:.6f}', l_discount) AS text FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.format_string("%.6f", F.col("l_discount")).alias("text"))


@book.add("f10_date_parts", "SELECT event_id, hour(ts) AS hour, day(ts) AS day, month(ts) AS month, isodow(ts) - 1 AS weekday, weekofyear(ts) AS week FROM events")
def _(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.hour(ts).alias("hour"), F.dayofmonth(ts).alias("day"), F.month(ts).alias("month"),
                           dates.weekday(ts).alias("weekday"), F.weekofyear(ts).alias("week"))


@book.add("f11_weekend_flag", "SELECT event_id, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM events")
def _(t):
    return t.events.select("event_id", dates.is_weekend(F.col("ts")).cast("int").alias("is_weekend"))


@book.add("f12_day_part_profiles", """
SELECT event_id, CASE WHEN h >= 5 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 17 THEN 'day' WHEN h >= 17 AND h < 22 THEN 'evening' ELSE 'night' END AS client,
  CASE WHEN h BETWEEN 5 AND 12 THEN 'morning' WHEN h BETWEEN 12 AND 17 THEN 'day' WHEN h BETWEEN 17 AND 22 THEN 'evening' ELSE 'night' END AS client_closed,
  CASE WHEN h <= 6 THEN 'night' WHEN h <= 12 THEN 'morning' WHEN h <= 18 THEN 'afternoon' ELSE 'evening' END AS session,
  CASE WHEN h >= 6 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 18 THEN 'day' ELSE 'rest' END AS shop FROM (SELECT event_id, hour(ts) AS h FROM events)""")
def _(t):
    return t.events.select("event_id", *[dates.day_part(F.col("ts"), p).alias(p) for p in dates.DAY_PARTS])


@book.add("f13_part_of_month", "SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 10 THEN 'early' WHEN day(o_orderdate) <= 20 THEN 'middle' ELSE 'late' END AS part FROM orders")
def _(t):
    return t.orders.select("o_orderkey", dates.part_of_month(F.col("o_orderdate")).alias("part"))


@book.add("f14_season", "SELECT o_orderkey, CASE WHEN m IN (12, 1, 2) THEN 'winter' WHEN m IN (3, 4, 5) THEN 'spring' WHEN m IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season FROM (SELECT o_orderkey, month(o_orderdate) AS m FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", dates.season(F.month("o_orderdate")).alias("season"))


@book.add("f15_holiday_flag", "SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) IN (DATE '1998-01-01', DATE '1998-05-01', DATE '1998-12-25') THEN 1 ELSE 0 END AS is_holiday FROM orders")
def _(t):
    days = ["1998-01-01", "1998-05-01", "1998-12-25"]
    return t.orders.select("o_orderkey", dates.on_dates(F.col("o_orderdate"), days).cast("int").alias("is_holiday"))


@book.add("f16_time_differences", """
SELECT event_id, round(s, 6) AS seconds, s / 60 AS minutes, s / 3600 AS hours, CAST(trunc(s / 86400) AS BIGINT) AS days
FROM (SELECT event_id, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 1e6 AS s FROM events)""")
def _(t):
    ref, ts = F.lit("2024-02-01").cast("timestamp"), F.col("ts")
    s = dates.seconds_between(ref, ts)
    return t.events.select("event_id", rnd(s).alias("seconds"), (s / 60).alias("minutes"), (s / 3600).alias("hours"), dates.whole_days(ref, ts).alias("days"))


@book.add("f17_same_day", "SELECT event_id, CASE WHEN CAST(ts AS DATE) = CAST(ts + INTERVAL 6 HOUR AS DATE) THEN 1 ELSE 0 END AS same_day FROM events")
def _(t):
    return t.events.select("event_id", (F.to_date("ts") == F.to_date(F.col("ts") + F.expr("interval 6 hours"))).cast("int").alias("same_day"))


@book.add("f18_session_flags", """
SELECT event_id, round((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400, 9) AS fraction, CASE WHEN hour(ts) BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS business,
  CASE WHEN hour(ts) IN (0, 1, 2, 3) THEN 1 ELSE 0 END AS midnight, CAST(hour(ts + INTERVAL 5 HOUR) - hour(ts) AS INT) AS hour_diff FROM events""")
def _(t):
    ts = F.col("ts")
    later = ts + F.expr("interval 5 hours")
    return t.events.select("event_id", rnd(dates.fraction_of_day(ts), 9).alias("fraction"), F.hour(ts).between(9, 18).cast("int").alias("business"),
                           F.hour(ts).isin(0, 1, 2, 3).cast("int").alias("midnight"), (F.hour(later) - F.hour(ts)).alias("hour_diff"))


@book.add("f19_month_ordinal", "SELECT o_orderkey, year(o_orderdate) * 12 + month(o_orderdate) AS ordinal, strftime(o_orderdate, '%Y-%m') AS label FROM orders")
def _(t):
    return t.orders.select("o_orderkey", dates.month_ordinal(F.col("o_orderdate")).alias("ordinal"), F.date_format("o_orderdate", "yyyy-MM").alias("label"))


@book.add("f20_seconds_since_minimum", "SELECT event_id, round((epoch_us(ts) - epoch_us(min(ts) OVER ())) / 1e6, 6) AS seconds FROM events")
def _(t):
    d = with_stats(t.events.select("event_id", "ts"), lo=F.min("ts"))
    return d.select("event_id", rnd(dates.seconds_between(F.col("ts"), F.col("stats.lo"))).alias("seconds"))


@book.add("f21_cyclic_encoding", "SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0 AS hour_cos FROM events")
def _(t):
    s, c = numbers.cyclic(F.hour("ts"), 24)
    return t.events.select("event_id", rnd(s).alias("hour_sin"), rnd(c).alias("hour_cos"))


@book.add("f22_signed_log_and_powers", "SELECT event_id, round(sign(x) * ln(1 + abs(x)), 6) + 0 AS signed_log, round(x * x, 4) AS sq, round(x * x * x, 4) + 0 AS cube FROM (SELECT event_id, value - 20 AS x FROM events)")
def _(t):
    x = F.col("value") - 20
    return t.events.select("event_id", rnd(numbers.signed_log(x)).alias("signed_log"), rnd(x * x, 4).alias("sq"), rnd(x * x * x, 4).alias("cube"))


@book.add("f23_guarded_log", "SELECT event_id, CASE WHEN x IS NOT NULL THEN round(ln(greatest(x, 1e-10)), 6) END AS log FROM (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN value - 10 END AS x FROM events)")
def _(t):
    x = F.when(F.col("event_id") % 9 != 0, F.col("value") - 10)
    return t.events.select("event_id", rnd(numbers.guarded_log(x)).alias("log"))


@book.add("f24_clip", "SELECT event_id, greatest(5, least(100, value)) AS fixed, round(least(greatest(value, (SELECT quantile_cont(value, 0.01) FROM events)), (SELECT quantile_cont(value, 0.99) FROM events)), 6) AS clipped FROM events")
def _(t):
    lo, hi = (F.lit(x).cast("double") for x in column_quantiles(t.events, {"value": [0.01, 0.99]})["value"])
    return t.events.select("event_id", numbers.clip(F.col("value"), 5.0, 100.0).alias("fixed"), rnd(numbers.clip(F.col("value"), lo, hi)).alias("clipped"))


@book.add("f25_rounding", """
SELECT event_id, round_even(x, 0) + 0 AS half_even, CAST(floor(x) AS BIGINT) AS floor, CAST(ceil(x) AS BIGINT) AS ceil, trunc(x) + 0 AS toward_zero, sign(x) * ceil(abs(x)) + 0 AS away FROM (SELECT event_id, value - 20 AS x FROM events)""")
def _(t):
    x = F.col("value") - 20
    return t.events.select("event_id", F.bround(x, 0).alias("half_even"), F.floor(x).alias("floor"), F.ceil(x).alias("ceil"),
                           (numbers.toward_zero(x) + 0).alias("toward_zero"), (numbers.away_from_zero(x) + 0).alias("away"))


@book.add("f26_infinite_to_null", "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN value END AS x FROM events")
def _(t):
    x = F.when(F.col("event_id") % 10 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return t.events.select("event_id", x.alias("x")).select("event_id", numbers.finite(F.col("x")).alias("x"))


@book.add("f27_safe_ratio", "SELECT l_orderkey, l_linenumber, round(l_tax / nullif(l_discount, 0), 6) AS ratio FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", rnd(numbers.ratio(F.col("l_tax"), F.col("l_discount"))).alias("ratio"))


@book.add("f28_array_access", "SELECT vec_id, array_to_string(list_transform(embedding[1:3], lambda x: format('{:.4f}', x::DOUBLE)), ',') AS head, CAST(len(embedding) AS INT) AS n, round(embedding[64]::DOUBLE, 6) AS last, list_contains(embedding[1:3], embedding[2]) AS has FROM embeddings")
def _(t):
    e = F.col("embedding")
    head = F.transform(arrays.head(e, 3), lambda x: F.format_string("%.4f", x.cast("double")))
    return t.embeddings.select("vec_id", F.array_join(head, ",").alias("head"), F.size(e).alias("n"), rnd(F.get(e, F.lit(63)).cast("double")).alias("last"),
                               F.array_contains(arrays.head(e, 3), F.get(e, F.lit(1))).alias("has"))


@book.add("f29_array_to_columns", "SELECT doc_id, w[1] AS word_1, w[2] AS word_2, w[3] AS word_3 FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)")
def _(t):
    return t.documents.select("doc_id", *arrays.spread(F.split("text", " ", -1), ["word_1", "word_2", "word_3"]))


@book.add("f30_explode_structs", f"WITH {ACTIONS} SELECT user_id, cluster, count(*) AS n FROM actions GROUP BY 1, 2")
def _(t):
    from featherloom.operators.categories import top_arrays

    d = top_arrays(t.actions, ["user_id"], "cluster", 7, "v", "c")
    rows = d.select("user_id", F.explode(F.arrays_zip("v", "c")).alias("s"))
    return rows.select("user_id", F.col("s.v").alias("cluster"), F.col("s.c").alias("n"))


@book.add("f31_arg_max", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS best FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", arrays.arg_max(F.col("embedding")).alias("best"))


@book.add("f32_nearest_element", "SELECT vec_id, round(list_min(list_transform(embedding, lambda x: abs(x::DOUBLE - 0.05))), 6) AS distance FROM embeddings")
def _(t):
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select("vec_id", rnd(F.abs(arrays.nearest(e, F.lit(0.05)) - 0.05)).alias("distance"))


@book.add("f33_vector_equality", "SELECT vec_id, vec_id % 3 <> 0 AS close, vec_id % 3 = 2 AS equal FROM embeddings")
def _(t):
    e = F.col("embedding").cast("array<double>")
    step = F.when(F.col("vec_id") % 3 == 0, 0.5).when(F.col("vec_id") % 3 == 1, 1e-10).otherwise(0.0)
    d = t.embeddings.select("vec_id", e.alias("a"), step.alias("s")).withColumn("b", F.transform("a", lambda x: x + F.col("s")))
    return d.select("vec_id", arrays.all_close(F.col("a"), F.col("b")).alias("close"), arrays.all_equal(F.col("a"), F.col("b")).alias("equal"))


@book.add("f34_match_code", f"WITH {ACTIONS} SELECT event_id, CASE WHEN widget IS NULL THEN -1 WHEN widget = cluster THEN 1 ELSE 0 END AS code FROM actions")
def _(t):
    return t.actions.select("event_id", numbers.match_code(F.col("widget"), F.col("cluster")).alias("code"))


@book.add("f35_log_transform_and_back", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS y, round(o_totalprice, 2) AS back FROM orders")
def _(t):
    y = F.log1p("o_totalprice")
    return t.orders.select("o_orderkey", rnd(y).alias("y"), rnd(F.expm1(y), 2).alias("back"))
