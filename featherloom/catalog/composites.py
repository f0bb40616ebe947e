"""Composite feature jobs (C)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, PRODUCTS, SEARCHES, SLOPE, TXNS, Book, cents, monthly_mean, rnd
from featherloom.plans import client, passengers, rules, sessions, shop
from featherloom.plans.star import denormalize

book = Book()
CUT, LOOKBACK, MONTH, WEEK = "2024-01-21", 15, 10, 5


def _rounded(df: DataFrame, places: int = 6, exact: tuple[str, ...] = ()) -> DataFrame:
    """Presentation for comparison: rounded doubles, times as microseconds, arrays as text."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind == "double" and f.name not in exact:
            c = rnd(c, places)
        elif kind == "timestamp":
            c = F.unix_micros(c)
        elif kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def _win(cut, days):
    return f"CAST(ts AS DATE) BETWEEN DATE '{cut}' - {days + 1} AND DATE '{cut}' - 1"


def _days(a, b):
    return f"CAST(trunc((epoch_us({a}) - epoch_us({b})) / 86400000000) AS BIGINT)"


def _money(expr):
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


SHOP = f"WITH {ACTIONS}, {PRODUCTS}, {SEARCHES}"


def actions_sql(cut, tag=""):
    cols = []
    for a, s in shop.ACTION_TYPES.items():
        flt = f"FILTER (WHERE action = '{a}')"
        cols += [f"count(*) {flt} AS num_products_{s}", f"coalesce(CAST(sum(CAST(price AS DECIMAL(18,2))) {flt} AS DOUBLE), 0) AS sum_price_{s}", f"max(price) {flt} AS max_price_{s}",
                 f"epoch_us(max(ts) {flt}) AS last_{s}_time", f"epoch_us(min(ts) {flt}) AS first_{s}_time"]
    days = [f"CAST(trunc((epoch_us(TIMESTAMP '{cut}') - {w}_{s}_time) / 86400000000) AS BIGINT) AS days_since_{w}_{s}" for s in shop.ACTION_TYPES.values() for w in ("last", "first")]
    wide = []
    for a, s in shop.ACTION_TYPES.items():
        flt = f"FILTER (WHERE action = '{a}')"
        wide += [f"count(*) {flt} AS num_{s}_clusters", f"CAST(arg_min(cluster, (-n, cluster)) {flt} AS INT) AS main_{s}_cluster", f"round(max(n) {flt} / sum(n) {flt}, 6) AS {s}_cluster_concentration"]
    return f"""w{tag} AS (SELECT a.user_id, a.ts, a.event_id, a.action, a.product_id, a.widget, p.price, p.cluster, p.brand, p.category FROM actions a JOIN products p USING (product_id) WHERE {_win(cut, LOOKBACK)}),
c{tag} AS (SELECT user_id, action, cluster, count(*) AS n FROM w{tag} GROUP BY 1, 2, 3), wide{tag} AS (SELECT user_id, {', '.join(wide)} FROM c{tag} GROUP BY 1),
base{tag} AS (SELECT user_id, {', '.join(cols)} FROM w{tag} GROUP BY 1), act{tag} AS (SELECT *, {', '.join(days)} FROM base{tag} JOIN wide{tag} USING (user_id))"""


@book.add("c01_action_features", f"{SHOP}, {actions_sql(CUT)} SELECT * FROM act")
def _(t):
    return _rounded(shop.action_features(t.actions, t.products, CUT, LOOKBACK))


WINDOWS = (5, 10, 15)


def windows_sql(cut):
    cols = ", ".join(
        f"count(*) FILTER (WHERE action = 'click' AND {_win(cut, d)}) AS num_products_click_last_{i}, coalesce(CAST(sum(CAST(price AS DECIMAL(18,2))) FILTER (WHERE action = 'purchase' AND {_win(cut, d)}) AS DOUBLE), 0) AS sum_price_order_last_{i}"
        for i, d in enumerate(WINDOWS, 1))
    return f"SELECT user_id, {cols} FROM actions JOIN products USING (product_id) WHERE {_win(cut, max(WINDOWS))} GROUP BY 1"


@book.add("c02_recent_windows", f"{SHOP} {windows_sql(CUT)}")
def _(t):
    return shop.recent_windows(t.actions, t.products, CUT, list(WINDOWS))


def search_sql(cut, tag=""):
    o = "(PARTITION BY user_id ORDER BY ts, doc_id)"
    return f"""s{tag} AS (SELECT * FROM searches WHERE {_win(cut, LOOKBACK)}), sc{tag} AS (SELECT user_id, cluster, count(*) AS n FROM s{tag} GROUP BY 1, 2),
sr{tag} AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, cluster) AS rk, n / sum(n) OVER (PARTITION BY user_id) AS p FROM sc{tag}),
sp{tag} AS (SELECT user_id, count(*) AS num_search_clusters, CAST(max(cluster) FILTER (WHERE rk = 1) AS INT) AS main_search_cluster, max(n) AS search_cluster_count, round(max(n) / sum(n), 6) AS search_cluster_concentration,
  round(-sum(p * ln(p)), 6) + 0 AS search_cluster_entropy, round((sum(n) - count(*)) / sum(n), 6) AS search_cluster_stability,
  array_to_string(list(cluster ORDER BY rk) FILTER (WHERE rk <= 3), ',') AS top3_search_clusters, array_to_string(list(n ORDER BY rk) FILTER (WHERE rk <= 3), ',') AS top3_search_counts FROM sr{tag} GROUP BY 1),
sm{tag} AS (SELECT user_id, CAST(arg_min(cluster, (-n, cluster)) AS INT) AS recent_search_cluster FROM (SELECT user_id, cluster, count(*) AS n FROM s{tag} WHERE {_win(cut, MONTH)} GROUP BY 1, 2) GROUP BY 1),
sl{tag} AS (SELECT *, lag(cluster) OVER {o} AS pv FROM s{tag}),
sd{tag} AS (SELECT user_id, round(avg(g), 6) AS search_mean_cluster_switch_days FROM (SELECT user_id, trunc((epoch_us(ts) - lag(epoch_us(ts)) OVER {o}) / 86400000000) AS g FROM sl{tag} WHERE cluster <> pv) GROUP BY 1),
sb{tag} AS (SELECT s.user_id, count(query) AS num_search, count(DISTINCT query) AS unique_search_queries, count(query) FILTER (WHERE {_win(cut, MONTH)}) AS num_search_last_month,
  count(query) FILTER (WHERE {_win(cut, WEEK)}) AS num_search_last_week, round(count(*) / nullif({_days('max(ts)', 'min(ts)')}, 0), 6) AS search_daily_rate, round(avg(length(query)), 6) AS search_mean_query_len,
  epoch_us(max(ts)) AS last_search_time, epoch_us(min(ts)) AS first_search_time, {_days(f"TIMESTAMP '{cut}'", 'max(ts)')} AS days_since_last_search, {_days(f"TIMESTAMP '{cut}'", 'min(ts)')} AS days_since_first_search,
  round(avg(length(query)) FILTER (WHERE s.cluster = sp.main_search_cluster) - avg(length(query)) FILTER (WHERE s.cluster <> sp.main_search_cluster), 6) AS search_main_cluster_query_len_diff
  FROM s{tag} s JOIN sp{tag} sp ON sp.user_id = s.user_id GROUP BY 1),
sx{tag} AS (SELECT user_id, CAST(coalesce(sum(abs(cluster - pv)), 0) AS BIGINT) AS search_cluster_id_change, count(*) FILTER (WHERE cluster <> pv) AS search_cluster_switches FROM sl{tag} GROUP BY 1),
srch{tag} AS (SELECT * FROM sb{tag} JOIN sp{tag} USING (user_id) LEFT JOIN sm{tag} USING (user_id) LEFT JOIN sx{tag} USING (user_id) LEFT JOIN sd{tag} USING (user_id))"""


@book.add("c03_search_features", f"{SHOP}, {search_sql(CUT)} SELECT * FROM srch")
def _(t):
    return _rounded(shop.search_features(t.searches, CUT, LOOKBACK, MONTH, WEEK))


def product_sql(cut, tag=""):
    return f"""pr{tag} AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, cluster) AS rk, n / sum(n) OVER (PARTITION BY user_id) AS p FROM (SELECT user_id, cluster, count(*) AS n FROM w{tag} GROUP BY 1, 2)),
pp{tag} AS (SELECT user_id, count(*) AS num_product_clusters, CAST(max(cluster) FILTER (WHERE rk = 1) AS INT) AS main_product_cluster, max(n) AS product_cluster_count, round(max(n) / sum(n), 6) AS product_cluster_concentration,
  round(-sum(p * ln(p)), 6) + 0 AS product_cluster_entropy, round((sum(n) - count(*)) / sum(n), 6) AS product_cluster_stability,
  array_to_string(list(cluster ORDER BY rk) FILTER (WHERE rk <= 3), ',') AS top3_product_clusters, array_to_string(list(n ORDER BY rk) FILTER (WHERE rk <= 3), ',') AS top3_product_counts FROM pr{tag} GROUP BY 1),
prod{tag} AS (SELECT * FROM pp{tag} JOIN (SELECT user_id, CAST(arg_max(cluster, (ts, event_id)) AS INT) AS recent_product_cluster FROM w{tag} GROUP BY 1) USING (user_id))"""


@book.add("c04_product_cluster_features", f"{SHOP}, {actions_sql(CUT)}, {product_sql(CUT)} SELECT * FROM prod")
def _(t):
    return _rounded(shop.product_cluster_features(t.actions, t.products, CUT, LOOKBACK))


RECENT = f"""m AS (SELECT user_id, ts, action, price, p.cluster FROM actions a JOIN products p USING (product_id) WHERE CAST(ts AS DATE) >= DATE '{CUT}' - {MONTH} AND CAST(ts AS DATE) < DATE '{CUT}'),
mc AS (SELECT user_id, count(*) AS unique_clusters, round(max(n) / sum(n), 6) AS main_cluster_ratio FROM (SELECT user_id, cluster, count(*) AS n FROM m GROUP BY 1, 2) GROUP BY 1),
mb AS (SELECT user_id, count(*) AS total_actions, count(*) FILTER (WHERE action = 'click') AS clicks, count(*) FILTER (WHERE action = 'view') AS favorites, count(*) FILTER (WHERE action = 'signup') AS cart_adds,
  {_money('price')} AS total_spent, round(avg(price), 6) AS avg_price, CAST(DATE '{CUT}' - CAST(max(ts) AS DATE) AS INT) AS days_since_last_action, {_days('max(ts)', 'min(ts)')} AS active_days,
  round(count(*) / nullif({_days('max(ts)', 'min(ts)')}, 0), 6) AS daily_actions_rate, round(count(*) FILTER (WHERE action = 'signup') / count(*), 6) AS cart_add_ratio, round(count(*) FILTER (WHERE action = 'view') / count(*), 6) AS favorite_ratio FROM m GROUP BY 1)"""


@book.add("c05_recent_activity", f"{SHOP}, {RECENT} SELECT * FROM mb JOIN mc USING (user_id)")
def _(t):
    return _rounded(shop.recent_activity(t.actions, t.products, CUT, MONTH))


@book.add("c06_widget_block", f"{SHOP} SELECT user_id, " + ", ".join(
    f"count(*) FILTER (WHERE widget = {w}) AS widget_{w}_count, round(count(*) FILTER (WHERE widget = {w}) / count(*), 6) AS widget_{w}_ratio" for w in range(4)) + f" FROM actions WHERE widget IS NOT NULL AND {_win(CUT, LOOKBACK)} GROUP BY 1")
def _(t):
    return _rounded(shop.widget_block(t.actions.where(shop._before(CUT, LOOKBACK)), [0, 1, 2, 3]))


def patterns_sql(cut):
    return f"""WITH d AS (SELECT user_id, ts, hour(ts) AS h, isodow(ts) >= 6 AS we, price FROM actions LEFT JOIN products USING (product_id) WHERE ts < TIMESTAMP '{cut}'),
e AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM (SELECT user_id, h, count(*) AS n FROM d GROUP BY 1, 2)), he AS (SELECT user_id, round(-sum(p * ln(p)), 6) + 0 AS hour_entropy FROM e GROUP BY 1)
SELECT user_id, round(count(*) FILTER (WHERE h >= 6 AND h < 12) / count(*), 6) AS morning_activity_ratio, round(count(*) FILTER (WHERE h >= 12 AND h < 18) / count(*), 6) AS day_activity_ratio,
  round(count(*) FILTER (WHERE we) / count(*), 6) AS weekend_activity_ratio, round(count(*) FILTER (WHERE NOT we) / (count(*) FILTER (WHERE we) + 1e-6), 6) AS weekday_weekend_ratio,
  round(coalesce(sum(price) FILTER (WHERE h >= 6 AND h < 12), 0) / (count(*) FILTER (WHERE h >= 6 AND h < 12) + 1e-6), 6) AS morning_avg_spend, any_value(hour_entropy) AS hour_entropy FROM d JOIN he USING (user_id) GROUP BY 1"""


@book.add("c07_time_patterns", f"{SHOP} SELECT * FROM ({patterns_sql(CUT)})")
def _(t):
    return _rounded(shop.time_patterns(t.actions, t.products, CUT))


def brands_sql(cut):
    return f"""WITH d AS (SELECT user_id, brand, category, price FROM actions LEFT JOIN products USING (product_id) WHERE ts < TIMESTAMP '{cut}'),
b AS (SELECT user_id, count(*) AS unique_brands, max(n) AS top FROM (SELECT user_id, brand, count(*) AS n FROM d WHERE brand IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT user_id, count(*) AS unique_categories, max(n) AS favorite_category_count, arg_min(category, (-n, category)) AS main FROM (SELECT user_id, category, count(*) AS n FROM d WHERE category IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT user_id, any_value(unique_brands) AS unique_brands, round(any_value(top) / count(*), 6) AS favorite_brand_ratio, any_value(unique_categories) AS unique_categories, any_value(favorite_category_count) AS favorite_category_count,
  round(avg(price) FILTER (WHERE category = main), 6) AS main_category_avg_price FROM d JOIN b USING (user_id) JOIN c USING (user_id) GROUP BY 1"""


@book.add("c08_brand_category", f"{SHOP} SELECT * FROM ({brands_sql(CUT)})")
def _(t):
    return _rounded(shop.brand_category(t.actions, t.products, CUT))


def search_text_sql(cut):
    return f"""SELECT user_id, round(avg(len(string_split(query, ' '))), 6) AS avg_query_length, round(count(*) FILTER (WHERE regexp_matches(query, '[0-9]')) / count(*), 6) AS numeric_query_ratio,
  count(*) FILTER (WHERE length(query) > 200) AS long_queries_count FROM searches WHERE ts < TIMESTAMP '{cut}' GROUP BY 1"""


@book.add("c09_search_text", f"{SHOP} SELECT * FROM ({search_text_sql(CUT)})")
def _(t):
    return _rounded(shop.search_text(t.searches, CUT, long_chars=200))


def label_sql(first, last, tag=""):
    return f"lab{tag} AS (SELECT user_id, max(CASE WHEN action = 'purchase' THEN 1 ELSE 0 END) AS target FROM actions WHERE CAST(ts AS DATE) BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY 1)"


def funnel_sql(cut, tag=""):
    return f"""fun{tag} AS (SELECT lab.user_id, target, hour(make_timestamp(last_click_time)) AS last_click_hour, isodow(make_timestamp(last_order_time)) - 1 AS last_order_weekday,
  CAST(trunc((last_order_time - last_click_time) / 86400000000) AS BIGINT) AS click_to_order_days, CAST(trunc((last_favorite_time - last_click_time) / 86400000000) AS BIGINT) AS click_to_favorite_days,
  CASE WHEN main_search_cluster = main_product_cluster THEN 1 WHEN main_search_cluster <> main_product_cluster THEN 0 ELSE -1 END AS main_cluster_match,
  CASE WHEN main_product_cluster IS NOT NULL AND list_contains(string_split(top3_search_clusters, ','), CAST(main_product_cluster AS VARCHAR)) THEN 1 ELSE 0 END AS product_cluster_in_search_top3,
  coalesce(round(num_products_order / nullif(num_products_click, 0), 6), 0) AS click_to_order_rate, coalesce(round(num_products_to_cart / nullif(num_products_click, 0), 6), 0) AS click_to_cart_rate,
  CASE WHEN days_since_first_click > 10 THEN 1 ELSE 0 END AS is_long_term_user, CASE WHEN days_since_last_click < 7 THEN 1 ELSE 0 END AS is_active_user,
  coalesce(round(sum_price_order / nullif(days_since_first_order, 0), 6), 0) AS spending_rate
  FROM lab{tag} lab LEFT JOIN act{tag} USING (user_id) LEFT JOIN srch{tag} USING (user_id) LEFT JOIN prod{tag} USING (user_id))"""


FUNNEL = ["user_id", "target", "last_click_hour", "last_order_weekday", "click_to_order_days", "click_to_favorite_days", "main_cluster_match", "product_cluster_in_search_top3",
          "click_to_order_rate", "click_to_cart_rate", "is_long_term_user", "is_active_user", "spending_rate"]


def _all(cut, first, last, tag=""):
    return ", ".join([label_sql(first, last, tag), actions_sql(cut, tag), search_sql(cut, tag), product_sql(cut, tag), funnel_sql(cut, tag)])


@book.add("c10_funnel_columns", f"{SHOP}, {_all(CUT, '2024-01-21', '2024-01-30')} SELECT * FROM fun")
def _(t):
    label = shop.purchase_label(t.actions, "2024-01-21", "2024-01-30")
    return _rounded(shop.user_features(label, t.actions, t.products, t.searches, CUT, LOOKBACK, MONTH, WEEK).select(*FUNNEL))


@book.add("c11_purchase_label", f"{SHOP}, {label_sql('2024-01-28', '2024-01-30')} SELECT target, count(*) AS users FROM lab GROUP BY 1")
def _(t):
    return shop.purchase_label(t.actions, "2024-01-28", "2024-01-30").groupBy("target").agg(F.count("*").alias("users"))


TWO = [("2024-01-17", "2024-01-17", "2024-01-20"), ("2024-01-21", "2024-01-21", "2024-01-24")]
TWO_COLS = ["num_products_click", "sum_price_order", "days_since_last_order", "num_search", "main_product_cluster"]


@book.add("c12_two_cutoffs", f"{SHOP}, " + ", ".join(_all(c, a, b, f"_{i}") for i, (c, a, b) in enumerate(TWO)) + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS cutoff, f.user_id, f.target, f.spending_rate, {', '.join(TWO_COLS)} FROM fun_{i} f LEFT JOIN act_{i} USING (user_id) LEFT JOIN srch_{i} USING (user_id) LEFT JOIN prod_{i} USING (user_id)" for i, (c, _, _) in enumerate(TWO)))
def _(t):
    parts = []
    for cut, first, last in TWO:
        label = shop.purchase_label(t.actions, first, last)
        d = shop.user_features(label, t.actions, t.products, t.searches, cut, LOOKBACK, MONTH, WEEK)
        parts.append(d.select(F.lit(cut).alias("cutoff"), "user_id", "target", rnd("spending_rate").alias("spending_rate"), *TWO_COLS))
    return parts[0].unionByName(parts[1])


def _whole_sql(i, cut):
    more = [windows_sql(cut), patterns_sql(cut), brands_sql(cut), search_text_sql(cut)]
    joins = " ".join(f"LEFT JOIN {b}_{i} USING (user_id)" for b in ("act", "srch", "prod")) + " " + " ".join(f"LEFT JOIN ({q}) USING (user_id)" for q in more)
    return f"SELECT '{cut}' AS cutoff, * FROM fun_{i} {joins}"


@book.add("c12_whole_user_table", f"{SHOP}, " + ", ".join(_all(c, a, b, f"_{i}") for i, (c, a, b) in enumerate(TWO)) + " " + " UNION ALL ".join(_whole_sql(i, c) for i, (c, _, _) in enumerate(TWO)))
def _(t):
    parts = []
    for cut, first, last in TWO:
        d = shop.whole_user_table(shop.purchase_label(t.actions, first, last), t.actions, t.products, t.searches, cut, LOOKBACK, MONTH, WEEK, list(WINDOWS), long_chars=200)
        # the recent and widget blocks have their own queries (c05, c06)
        shown = [b.columns for b in (
            shop.action_features(t.actions, t.products, cut, LOOKBACK), shop.search_features(t.searches, cut, LOOKBACK, MONTH, WEEK),
            shop.product_cluster_features(t.actions, t.products, cut, LOOKBACK), *shop.more_blocks(t.actions, t.products, t.searches, cut, list(WINDOWS), 200))]
        names = dict.fromkeys([*FUNNEL, *[c for b in shown for c in b]])
        parts.append(_rounded(d.select(F.lit(cut).alias("cutoff"), *names)))
    return parts[0].unionByName(parts[1])


HOLIDAYS = ["1998-01-01", "1998-05-01", "1998-12-25"]
ROWS = f"""WITH {TXNS}, b AS (SELECT min(amount) AS lo, max(amount) AS hi FROM txns), f AS (SELECT merchant, count(*) AS merchant_freq FROM txns GROUP BY 1),
rws AS (SELECT t.*, merchant_freq, CASE WHEN merchant_freq > 652 THEN 1 ELSE 0 END AS is_popular, hour(ts) AS hour, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN CAST(ts AS DATE) IN ({', '.join(f"DATE '{d}'" for d in HOLIDAYS)}) THEN 1 ELSE 0 END AS is_holiday, substr(mcc, 1, 2) AS mcc_pair, substr(mcc, 1, 3) AS mcc_triplet,
  CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'morning' WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'day' WHEN hour(ts) >= 17 AND hour(ts) < 22 THEN 'evening' ELSE 'night' END AS time_of_day,
  {' + '.join(f'CAST(amount > lo + (hi - lo) * {i} / 10.0::DOUBLE AS INT)' for i in range(1, 10))} AS amount_bin FROM txns t JOIN f USING (merchant), b) """


def _share(col, values, prefix):
    quote = (lambda v: f"'{v}'") if isinstance(values[0], str) else str
    return ", ".join(f"round(avg(CASE WHEN {col} = {quote(v)} THEN 1 ELSE 0 END), 6) AS {prefix}_{v}" for v in values)


def _top(col, name):
    return f"""{name} AS (SELECT client, max({col}) FILTER (WHERE rk = 1) AS top_{name}_1, max({col}) FILTER (WHERE rk = 2) AS top_{name}_2, round(max(n) / sum(n), 6) AS share_{name}, round(-sum(p * log2(p + 1e-9)), 6) + 0 AS bits_{name},
 round(-sum(p * ln(p)), 6) + 0 AS nats_{name} FROM (SELECT client, {col}, count(*) AS n, row_number() OVER (PARTITION BY client ORDER BY count(*) DESC, {col}) AS rk, count(*) / sum(count(*)) OVER (PARTITION BY client) AS p FROM rws GROUP BY 1, 2) GROUP BY 1)"""


CLIENT = ROWS + f""", {_top('mcc', 'mcc')}, {_top('merchant', 'merchant')}, {_top('time_of_day', 'tod')},
wk AS (SELECT client, round(avg(n), 6) AS mean_weekly_txn, round(stddev_samp(n), 6) AS std_weekly_txn, max(n) AS max_weekly_txn FROM (SELECT client, weekofyear(ts), count(*) AS n FROM rws GROUP BY 1, 2) GROUP BY 1),
tr AS (SELECT client, {SLOPE} AS amount_trend FROM (SELECT client, year(ts) * 12 + month(ts) AS x, {monthly_mean('amount')} AS y FROM rws GROUP BY 1, 2) GROUP BY 1),
gp AS (SELECT client, round(avg(g), 4) AS mean_txn_diff, round(stddev_samp(g), 4) AS std_txn_diff, round(min(g), 4) AS min_txn_diff, round(max(g), 4) AS max_txn_diff FROM (SELECT client, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY client ORDER BY ts, txn_id)) / 1e6 AS g FROM rws) GROUP BY 1),
bs AS (SELECT client, count(amount) AS count_amount, round(avg(amount), 6) AS avg_amount, {_money('amount')} AS total_amount, round(stddev_samp(amount), 4) AS std_amount, min(amount) AS min_amount, max(amount) AS max_amount,
  count(DISTINCT mcc) AS unique_mccs, count(DISTINCT merchant) AS unique_merchants, count(DISTINCT mcc_pair) AS unique_mcc_pairs, count(DISTINCT mcc_triplet) AS unique_mcc_triplets, epoch_us(min(ts)) AS first_txn, epoch_us(max(ts)) AS last_txn,
  round(avg(merchant_freq), 4) AS mean_merchant_freq, max(merchant_freq) AS max_merchant_freq, round(avg(is_popular), 6) AS popular_merchant_rate, round(avg(is_weekend), 6) AS weekend_rate, round(avg(is_holiday), 6) AS holiday_rate,
  {_share('time_of_day', client.PARTS, 'tod')}, {_share('amount_bin', list(range(10)), 'amount_bin')}, round(avg(hour), 6) AS mean_hour, round(stddev_samp(hour), 6) AS std_hour, round(skewness(amount), 6) AS amount_skew,
  round(median(amount), 4) AS amount_median, round(quantile_cont(amount, 0.25), 4) AS amount_q25, round(quantile_cont(amount, 0.75), 4) AS amount_q75,
  CAST(trunc((epoch_us((SELECT max(ts) FROM rws)) - epoch_us(max(ts))) / 86400000000) AS BIGINT) AS days_since_last_txn FROM rws GROUP BY 1)
SELECT bs.*, wk.* EXCLUDE client, tr.amount_trend, gp.* EXCLUDE client, top_mcc_1, top_mcc_2, top_merchant_1, top_merchant_2, top_tod_1, top_tod_2, bits_mcc AS mcc_entropy, bits_merchant AS merchant_entropy, share_mcc AS top_mcc_share, share_merchant AS top_merchant_share
FROM bs JOIN wk USING (client) JOIN tr USING (client) JOIN gp USING (client) JOIN mcc USING (client) JOIN merchant USING (client) JOIN tod USING (client)"""

PLACES = {c: 4 for c in ("std_amount", "mean_merchant_freq", "mean_txn_diff", "std_txn_diff", "min_txn_diff", "max_txn_diff", "amount_median", "amount_q25", "amount_q75",
                         "recent_amount_mean", "recent_amount_std")}


def _present(d):
    return _rounded(d.withColumns({c: rnd(c, n) for c, n in PLACES.items() if c in d.columns}), exact=("amount_trend",))


@book.add("c13_client_features", CLIENT)
def _(t):
    d = client.client_features(client.transaction_columns(t.txns, HOLIDAYS, popular=652))
    return _present(d)


GROUPS = {"retail": ["0101", "0505", "1010"], "transport": ["0202", "2020"], "online": ["0303", "3030", "3131"]}


@book.add("c14_client_optional", ROWS + f""", {_top('mcc', 'mcc')}, {_top('merchant', 'merchant')}, {_top('time_of_day', 'tod')},
z AS (SELECT client, round(avg(CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END), 6) AS amount_outlier_ratio FROM (SELECT client, (amount - avg(amount) OVER (PARTITION BY client)) / nullif(stddev_pop(amount) OVER (PARTITION BY client), 0) AS z FROM rws) GROUP BY 1),
gp AS (SELECT client, round(avg(g), 6) AS mean_interval_days, round(stddev_samp(g), 6) AS std_interval_days FROM (SELECT client, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY client ORDER BY ts, txn_id)) / 86400e6 AS g FROM rws) GROUP BY 1),
rc AS (SELECT client, count(amount) AS recent_txn_count, round(avg(amount), 4) AS recent_amount_mean, round(stddev_samp(amount), 4) AS recent_amount_std FROM rws WHERE ts >= (SELECT max(ts) FROM rws) - INTERVAL 14 DAY GROUP BY 1),
gr AS (SELECT client, {', '.join(f"round(avg(CASE WHEN mcc IN ({', '.join(repr(v) for v in vs)}) THEN 1 ELSE 0 END), 6) AS {n}_ratio" for n, vs in GROUPS.items())} FROM rws GROUP BY 1)
SELECT gr.*, mean_interval_days, std_interval_days, amount_outlier_ratio, nats_mcc AS mcc_entropy, nats_merchant AS merchant_entropy, nats_tod AS tod_entropy, recent_txn_count, recent_amount_mean, recent_amount_std
FROM gr JOIN gp USING (client) JOIN z USING (client) JOIN mcc USING (client) JOIN merchant USING (client) JOIN tod USING (client) LEFT JOIN rc USING (client)""")
def _(t):
    return _present(client.optional_features(client.transaction_columns(t.txns, HOLIDAYS, popular=652), GROUPS))


def _calendar_sql(ts, p):
    return f"""hour({ts}) AS {p}_hour, isodow({ts}) - 1 AS {p}_day_of_week, day({ts}) AS {p}_day_of_month, month({ts}) AS {p}_month, weekofyear({ts}) AS {p}_week_of_year, CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS {p}_is_weekend,
  CASE WHEN hour({ts}) <= 6 THEN 'night' WHEN hour({ts}) <= 12 THEN 'morning' WHEN hour({ts}) <= 18 THEN 'afternoon' ELSE 'evening' END AS {p}_time_of_day,
  CASE WHEN month({ts}) IN (12, 1, 2) THEN 'winter' WHEN month({ts}) IN (3, 4, 5) THEN 'spring' WHEN month({ts}) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS {p}_season,
  round(sin(2 * pi() * hour({ts}) / 24), 6) + 0 AS {p}_hour_sin, round(cos(2 * pi() * hour({ts}) / 24), 6) + 0 AS {p}_hour_cos,
  round(sin(2 * pi() * (isodow({ts}) - 1) / 7), 6) + 0 AS {p}_day_of_week_sin, round(cos(2 * pi() * (isodow({ts}) - 1) / 7), 6) + 0 AS {p}_day_of_week_cos"""


@book.add("c15_session_features", f"""
WITH d AS (SELECT event_id, date_trunc('second', ts) AS o, date_trunc('second', ts) + to_seconds(CAST((event_id * 37) % 1500 - 200 AS BIGINT)) AS e, ((event_id * 37) % 1500 - 200)::DOUBLE AS s FROM events),
q AS (SELECT list_sort(list_distinct(quantile_cont(s, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM d)
SELECT event_id, s AS time_to_order_seconds, round(s / 60, 8) AS time_to_order_minutes, round(s / 3600, 8) AS time_to_order_hours, s * s AS ttos_sq, s * s * s AS ttos_cube, round(sign(s) * ln(1 + abs(s)), 6) + 0 AS ttos_log,
  CASE WHEN abs(s) <= 60 THEN 1 ELSE 0 END AS ttos_short, CASE WHEN abs(s) > 60 AND abs(s) <= 300 THEN 1 ELSE 0 END AS ttos_medium, CASE WHEN abs(s) > 300 THEN 1 ELSE 0 END AS ttos_long,
  {_calendar_sql('o', 'order')}, {_calendar_sql('e', 'session_end')}, CASE WHEN CAST(o AS DATE) = CAST(e AS DATE) THEN 1 ELSE 0 END AS same_day_order, CASE WHEN s < 0 THEN 1 ELSE 0 END AS gap_negative, CASE WHEN s < 30 THEN 1 ELSE 0 END AS hard_call,
  CASE WHEN hour(e) IN (0, 1, 2, 3) THEN 1 ELSE 0 END AS is_midnight_session, CASE WHEN hour(o) BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS order_during_business_hours, CAST(hour(e) - hour(o) AS INT) AS hour_diff,
  round((hour(o) * 3600 + minute(o) * 60 + second(o)) / 86400, 9) AS order_time_fraction, s * hour(o) + 0 AS ttos_x_hour, s * (isodow(o) - 1) + 0 AS ttos_x_dow,
  CAST(greatest(len(list_filter(edges, lambda v: v < s)) - 1, 0) AS INT) AS ttos_decile FROM d, q""")
def _(t):
    start = F.date_trunc("second", "ts")
    gap = ((F.col("event_id") * 37) % 1500 - 200).cast("int")
    d = t.events.select("event_id", start.alias("o"), (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), gap)).alias("e"))
    f = sessions.session_features(d, "o", "e", hard_call_below=30).drop("o", "e")
    places = {"time_to_order_minutes": 8, "time_to_order_hours": 8, "order_time_fraction": 9}
    exact = {"time_to_order_seconds", "ttos_sq", "ttos_cube"}
    out = []
    for x in f.schema.fields:
        c = F.col(x.name)
        if x.dataType.simpleString() == "double" and x.name not in exact:
            c = rnd(c, places.get(x.name, 6)) + 0.0
        out.append(c.alias(x.name))
    return f.select(*out)


@book.add("c16_clean_passengers", """
SELECT p_partkey, p_partkey // 3 AS "group", CAST(p_partkey % 3 AS INT) AS num_in_group, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 ELSE -1 END AS home,
  CASE WHEN p_size % 5 = 0 THEN -1 ELSE CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE -1 END END AS deck, CASE WHEN p_size % 5 = 0 THEN -1 ELSE p_size END AS num,
  CASE WHEN p_size % 5 = 0 THEN -1 ELSE CASE p_size % 2 WHEN 0 THEN 1 ELSE 2 END END AS side, split_part(p_name, ' ', 1) AS first_name, split_part(p_name, ' ', 2) AS last_name FROM part""")
def _(t):
    deck = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("X")), (F.col("p_size") % 3 + 1).cast("int"))
    cabin = F.when(F.col("p_size") % 5 != 0, F.concat_ws("/", deck, F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "P").otherwise("S")))
    d = t.part.select("p_partkey", F.concat_ws("_", F.floor(F.col("p_partkey") / 3).cast("string"), (F.col("p_partkey") % 3).cast("string")).alias("passenger_id"),
                      F.col("p_type").alias("home"), cabin.alias("cabin"), F.col("p_name").alias("name"))
    codes = {"home": {"ECONOMY": 1, "SMALL": 2}, "deck": {"A": 1, "B": 2}, "side": {"P": 1, "S": 2}}
    return passengers.clean_passengers(d, codes).drop("passenger_id")


@book.add("c17_star_denormalized", """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority, p_brand, c_mktsegment, s_name, n_name, r_name FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    d = denormalize(t.lineitem, t.orders, t.part, t.customer, t.supplier, t.nation, t.region)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority", "p_brand", "c_mktsegment", "s_name", "n_name", "r_name")


@book.add("c18_keyword_clusters", r"""
WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+')) AS word FROM documents),
h AS (SELECT doc_id, arg_max(cluster, (priority, cluster)) AS cluster FROM w JOIN (VALUES ('the', 1, 10), ('der', 2, 11), ('le', 3, 12)) r(word, priority, cluster) USING (word) GROUP BY 1)
SELECT d.doc_id, coalesce(h.cluster, CASE WHEN regexp_matches(lower(text), 'eaux') THEN 3 WHEN regexp_matches(lower(text), 'ung') THEN 2 WHEN regexp_matches(lower(text), 'tion') THEN 1 ELSE -1 END) AS cluster FROM documents d LEFT JOIN h USING (doc_id)""")
def _(t):
    words = t.spark.createDataFrame([("the", 1, 10), ("der", 2, 11), ("le", 3, 12)], "word string, priority int, cluster int")
    patterns = [("tion", 1), ("ung", 2), ("eaux", 3)]
    return rules.cluster_texts(t.documents.select("doc_id", "text"), "doc_id", "text", patterns, words).select("doc_id", "cluster")


@book.add("c19_filter_predict_score")
def _(t):
    from featherloom.operators.models import logistic_with_medians
    from featherloom.plans import clicklog

    text = (F.col("o_custkey") % 50).cast("string")
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 6 != 0, text).alias("if1"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("if2"), F.dayofmonth("o_orderdate").cast("double").alias("if3"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    kept = clicklog.keep_rows(rows)
    model = logistic_with_medians(["if2", "if3"], "label").fit(rows)
    return clicklog.score(clicklog.predict(model, kept, "id"), kept.select("id", "label"), "id", "label")


# the same job with a straight line as model, which SQL can fit
@book.add("c19_filter_predict_score_line", """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey % 50 END AS if1, day(o_orderdate)::DOUBLE AS x, CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM orders),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM r)
SELECT round(avg(abs(y - a - b * x)), 6) AS mae FROM r, m WHERE if1 > 20 AND if1 < 40""")
def _(t):
    from pyspark.ml.regression import LinearRegression

    from featherloom.operators.models import fit_on
    from featherloom.plans import clicklog

    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 6 != 0, (F.col("o_custkey") % 50).cast("string")).alias("if1"),
        F.dayofmonth("o_orderdate").cast("double").alias("if3"), (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    kept = clicklog.keep_rows(rows)
    model = fit_on(["if3"], LinearRegression(featuresCol="features", labelCol="label", solver="normal"), rows)
    return clicklog.score(clicklog.predict(model, kept, "id"), kept.select("id", "label"), "id", "label").withColumn("mae", rnd("mae"))


META = """SELECT doc_id, (n_chars % 97 + 1) / 100.0::DOUBLE AS m1, (n_chars % 41 + 1) / 50.0::DOUBLE AS m2, (n_chars % 13 + 1) / 20.0::DOUBLE AS m3 FROM documents"""


@book.add("c20_prediction_meta", f"""
SELECT doc_id, m1, m2, m3, round((m1 + m2 + m3) / 3, 6) AS pred_mean, least(m1, m2, m3) AS pred_min, greatest(m1, m2, m3) AS pred_max, list_median([m1, m2, m3]) AS pred_median, round(list_stddev_samp([m1, m2, m3]), 6) AS pred_std,
  1 + CAST(m2 < m1 AS INT) + CAST(m3 < m1 AS INT) + (CAST(m2 = m1 AS INT) + CAST(m3 = m1 AS INT)) / 2.0::DOUBLE AS rank_m1, 1 + CAST(m1 < m2 AS INT) + CAST(m3 < m2 AS INT) + (CAST(m1 = m2 AS INT) + CAST(m3 = m2 AS INT)) / 2.0::DOUBLE AS rank_m2,
  1 + CAST(m1 < m3 AS INT) + CAST(m2 < m3 AS INT) + (CAST(m1 = m3 AS INT) + CAST(m2 = m3 AS INT)) / 2.0::DOUBLE AS rank_m3, round(abs(m1 - m2), 6) AS abs_m1_m2, round(abs(m1 - m3), 6) AS abs_m1_m3, round(abs(m2 - m3), 6) AS abs_m2_m3,
  round(-(m1 / (m1 + m2 + m3) * ln(m1 / (m1 + m2 + m3)) + m2 / (m1 + m2 + m3) * ln(m2 / (m1 + m2 + m3)) + m3 / (m1 + m2 + m3) * ln(m3 / (m1 + m2 + m3))), 6) AS pred_entropy FROM ({META})""")
def _(t):
    n = F.col("n_chars")
    m = t.documents.select("doc_id", *[((n % a + 1) / F.lit(float(b))).alias(c) for c, a, b in (("m1", 97, 100), ("m2", 41, 50), ("m3", 13, 20))])
    return _rounded(sessions.prediction_meta(m, ["m1", "m2", "m3"]))


@book.add("c21_search_product_comparison", f"""{SHOP}, {actions_sql(CUT)}, {search_sql(CUT)}, {product_sql(CUT)}
SELECT user_id, CASE WHEN main_search_cluster = main_product_cluster THEN 1 WHEN main_search_cluster <> main_product_cluster THEN 0 END AS main_cluster_match,
  round(abs(s.c - p.c), 6) AS main_cluster_ratio_diff, search_cluster_count - product_cluster_count AS main_cluster_count_diff, round(search_cluster_count / (product_cluster_count + 1), 6) AS search_to_product_activity_ratio
FROM srch JOIN (SELECT user_id, max(n) / sum(n) AS c FROM sc GROUP BY 1) s USING (user_id) LEFT JOIN prod USING (user_id) LEFT JOIN (SELECT user_id, max(n) / sum(n) AS c FROM pr GROUP BY 1) p USING (user_id)""")
def _(t):
    s = shop.search_features(t.searches, CUT, LOOKBACK, MONTH, WEEK)
    p = shop.product_cluster_features(t.actions, t.products, CUT, LOOKBACK)
    return _rounded(shop.search_product_comparison(s, p))
