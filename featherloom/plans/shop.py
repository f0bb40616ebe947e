"""Shop event log: per-user feature blocks at a cut-off date.

Every block takes the cut-off (first day that must not be seen) as an argument, so the same
definition serves training and scoring. Windows end the day before the cut-off.

Inputs: ``actions(user_id, ts, event_id, action, product_id, widget)``,
``products(product_id, price, brand, category, cluster)``, ``searches(user_id, ts, doc_id, query, cluster)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions.dates import half_open_window, whole_days
from featherloom.functions.numbers import eps_ratio, match_code, ratio
from featherloom.functions.strings import has_digit, word_count
from featherloom.operators.aggregates import conditional_block
from featherloom.operators.categories import category_profile, measure_by_mode, mode_of, top_arrays
from featherloom.operators.windows import switch_stats
from featherloom.session import materialize

# fixed values: action types and the column suffix of each
ACTION_TYPES = {"click": "click", "view": "favorite", "purchase": "order", "signup": "to_cart"}
USER = ["user_id"]


def _before(cutoff: str, days: int) -> Column:
    """Dates ``cutoff - 1 - days`` to ``cutoff - 1``, both included."""
    return half_open_window(F.col("ts"), cutoff, days + 1)


def _since(cutoff: str, ts: Column) -> Column:
    return whole_days(F.lit(cutoff).cast("timestamp"), ts)


def _join(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, "user_id", "left"), parts)


def purchase_label(actions: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """1 for users with an order in the period, 0 for other active users."""
    stop = F.date_add(F.lit(last_day).cast("date"), 1).cast("timestamp")
    period = actions.where((F.col("ts") >= F.lit(first_day).cast("timestamp")) & (F.col("ts") < stop))
    return period.groupBy("user_id").agg(F.max((F.col("action") == "purchase").cast("int")).alias("target"))


def with_products(actions: DataFrame, products: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    return actions.join(products.select("product_id", *cols), "product_id", how)


def action_features(actions: DataFrame, products: DataFrame, cutoff: str, lookback: int) -> DataFrame:
    """Per user and action type: counts, price sums, times, and cluster statistics.

    All types come from one pass over the window, plus one for the clusters.
    """
    d = with_products(actions.drop("cluster").where(_before(cutoff, lookback)), products, ["price", "cluster"])
    groups = {s: F.col("action") == a for a, s in ACTION_TYPES.items()}
    price, ts = F.col("price"), F.col("ts")
    block = conditional_block(d, USER, groups, {
        "num_products_{}": (F.count, F.col("product_id")), "sum_price_{}": (F.sum, price.cast("decimal(18,2)")),
        "max_price_{}": (F.max, price), "last_{}_time": (F.max, ts), "first_{}_time": (F.min, ts)})
    block = block.withColumns({f"sum_price_{s}": F.coalesce(F.col(f"sum_price_{s}").cast("double"), F.lit(0.0)) for s in groups})
    block = block.withColumns(
        {f"days_since_last_{s}": _since(cutoff, F.col(f"last_{s}_time")) for s in groups}
        | {f"days_since_first_{s}": _since(cutoff, F.col(f"first_{s}_time")) for s in groups})
    per_type = category_profile(d, ["user_id", "action"], "cluster")
    names = {"num_{}_clusters": "unique", "main_{}_cluster": "mode", "{}_cluster_concentration": "concentration"}
    wide = per_type.groupBy("user_id").agg(*[
        F.max(F.when(F.col("action") == a, F.col(c))).alias(n.format(s)) for a, s in ACTION_TYPES.items() for n, c in names.items()])
    # no action of a type: no clusters, as its other counts are 0
    return block.join(wide, "user_id", "left").fillna(0, subset=[f"num_{s}_clusters" for s in groups])


def recent_windows(actions: DataFrame, products: DataFrame, cutoff: str, windows: list[int]) -> DataFrame:
    """Clicks and order sums of the last ``windows`` days, all windows in one pass."""
    d = with_products(actions.where(_before(cutoff, max(windows))), products, ["price"])
    aggs = []
    for i, days in enumerate(windows, 1):
        inside = _before(cutoff, days)
        aggs += [F.count_if(inside & (F.col("action") == "click")).alias(f"num_products_click_last_{i}"),
                 F.coalesce(F.sum(F.when(inside & (F.col("action") == "purchase"), F.col("price").cast("decimal(18,2)"))).cast("double"), F.lit(0.0)).alias(f"sum_price_order_last_{i}")]
    return d.groupBy("user_id").agg(*aggs)


def search_features(searches: DataFrame, cutoff: str, lookback: int, month: int = 30, week: int = 7) -> DataFrame:
    """Counts, rates, cluster statistics, switches and query lengths of a user's searches."""
    d = searches.where(_before(cutoff, lookback))
    n, recent = F.col("query"), _before(cutoff, month)
    base = d.groupBy("user_id").agg(
        F.count(n).alias("num_search"), F.countDistinct(F.sha2("query", 256)).alias("unique_search_queries"),
        F.count(F.when(recent, n)).alias("num_search_last_month"), F.count(F.when(_before(cutoff, week), n)).alias("num_search_last_week"),
        ratio(F.count("*"), whole_days(F.max("ts"), F.min("ts"))).alias("search_daily_rate"),
        F.avg(F.char_length("query")).alias("search_mean_query_len"),
        F.max("ts").alias("last_search_time"), F.min("ts").alias("first_search_time"))
    base = base.withColumns({"days_since_last_search": _since(cutoff, F.col("last_search_time")),
                             "days_since_first_search": _since(cutoff, F.col("first_search_time"))})
    profile = category_profile(d, USER, "cluster").select(
        "user_id", F.col("unique").alias("num_search_clusters"), F.col("mode").alias("main_search_cluster"), F.col("mode_count").alias("search_cluster_count"),
        F.col("concentration").alias("search_cluster_concentration"), F.col("entropy").alias("search_cluster_entropy"),
        F.col("stability").alias("search_cluster_stability"))
    latest = d.where(recent).groupBy("user_id", "cluster").agg(F.count("*").alias("n"))
    latest = latest.groupBy("user_id").agg(mode_of("cluster").alias("recent_search_cluster"))
    moves = switch_stats(d.select("user_id", "ts", "doc_id", "cluster"), USER, "ts", "doc_id", "cluster").select(
        "user_id", F.col("abs_id_change").alias("search_cluster_id_change"), F.col("switch_count").alias("search_cluster_switches"),
        F.col("mean_switch_days").alias("search_mean_cluster_switch_days"))
    lengths = measure_by_mode(d.select("user_id", "cluster", F.char_length("query").alias("len")), USER, "cluster", F.col("len"),
                              "__inside", "search_main_cluster_query_len_diff").drop("__inside")
    top = top_arrays(d, USER, "cluster", 3, "top3_search_clusters", "top3_search_counts")
    return _join([base, profile, latest, moves, lengths, top])


def product_cluster_features(actions: DataFrame, products: DataFrame, cutoff: str, lookback: int) -> DataFrame:
    """Cluster statistics of the products a user touched."""
    d = with_products(actions.drop("cluster").where(_before(cutoff, lookback)), products, ["cluster"])
    p = category_profile(d, USER, "cluster").select(
        "user_id", F.col("unique").alias("num_product_clusters"), F.col("mode").alias("main_product_cluster"), F.col("mode_count").alias("product_cluster_count"),
        F.col("concentration").alias("product_cluster_concentration"), F.col("entropy").alias("product_cluster_entropy"),
        F.col("stability").alias("product_cluster_stability"))
    recent = d.groupBy("user_id").agg(F.max_by("cluster", F.struct("ts", "event_id")).alias("recent_product_cluster"))
    return _join([p, recent, top_arrays(d, USER, "cluster", 3, "top3_product_clusters", "top3_product_counts")])


def recent_activity(actions: DataFrame, products: DataFrame, cutoff: str, days: int = 30) -> DataFrame:
    """Counts, spend, span and rates of the last days (the cut-off day is not included)."""
    d = with_products(actions.drop("cluster").where(half_open_window(F.col("ts"), cutoff, days)), products, ["price", "cluster"])
    kind, n = F.col("action"), F.count("*")
    base = d.groupBy("user_id").agg(
        n.alias("total_actions"), F.count_if(kind == "click").alias("clicks"), F.count_if(kind == "view").alias("favorites"),
        F.count_if(kind == "signup").alias("cart_adds"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total_spent"),
        F.avg("price").alias("avg_price"), F.datediff(F.lit(cutoff).cast("date"), F.to_date(F.max("ts"))).alias("days_since_last_action"),
        whole_days(F.max("ts"), F.min("ts")).alias("active_days"))
    clusters = category_profile(d, USER, "cluster").select(
        "user_id", F.col("unique").alias("unique_clusters"), F.col("concentration").alias("main_cluster_ratio"))
    total = F.col("total_actions")
    return base.join(clusters, "user_id", "left").withColumns({
        "daily_actions_rate": ratio(total, F.col("active_days")), "cart_add_ratio": F.col("cart_adds") / total, "favorite_ratio": F.col("favorites") / total})


def widget_block(actions: DataFrame, widgets: list[int]) -> DataFrame:
    """Per user: count and share of each widget, 0 where it was not used."""
    used = actions.where(F.col("widget").isNotNull())
    counts = {w: F.count_if(F.col("widget") == w) for w in widgets}
    return used.groupBy("user_id").agg(
        *[n.alias(f"widget_{w}_count") for w, n in counts.items()],
        *[(n / F.count("*")).alias(f"widget_{w}_ratio") for w, n in counts.items()],
    )


def time_patterns(actions: DataFrame, products: DataFrame, cutoff: str) -> DataFrame:
    """Shares by time of day and weekend, hour entropy, and morning spend."""
    seen = actions.where(F.col("ts") < F.lit(cutoff).cast("timestamp"))
    d = with_products(seen, products, ["price"], "left")
    hour, weekend = F.hour("ts"), F.weekday("ts") >= 5
    morning, n = (hour >= 6) & (hour < 12), F.count("*")
    base = d.groupBy("user_id").agg(
        (F.count_if(morning) / n).alias("morning_activity_ratio"), (F.count_if((hour >= 12) & (hour < 18)) / n).alias("day_activity_ratio"),
        (F.count_if(weekend) / n).alias("weekend_activity_ratio"), eps_ratio(F.count_if(~weekend), F.count_if(weekend)).alias("weekday_weekend_ratio"),
        eps_ratio(F.coalesce(F.sum(F.when(morning, F.col("price"))), F.lit(0.0)), F.count_if(morning)).alias("morning_avg_spend"))
    hours = category_profile(seen.withColumn("hour", hour), USER, "hour").select("user_id", F.col("entropy").alias("hour_entropy"))
    return base.join(hours, "user_id", "left")


def brand_category(actions: DataFrame, products: DataFrame, cutoff: str) -> DataFrame:
    """Distinct brands and categories, favourite shares, and mean price in the main category."""
    d = with_products(actions.where(F.col("ts") < F.lit(cutoff).cast("timestamp")), products, ["brand", "category", "price"], "left")
    total = d.groupBy("user_id").agg(F.count("*").alias("__n"))
    brands = category_profile(d, USER, "brand").select("user_id", F.col("unique").alias("unique_brands"), F.col("mode_count").alias("__b"))
    cats = category_profile(d, USER, "category").select("user_id", F.col("unique").alias("unique_categories"), F.col("mode_count").alias("favorite_category_count"))
    price = measure_by_mode(d, USER, "category", F.col("price"), "main_category_avg_price")
    out = _join([total, brands, cats, price])
    return out.withColumn("favorite_brand_ratio", F.col("__b") / F.col("__n")).drop("__b", "__n")


def search_text(searches: DataFrame, cutoff: str, long_chars: int = 20) -> DataFrame:
    """Mean words per query, share of queries with digits, and number of long queries."""
    d = searches.where(F.col("ts") < F.lit(cutoff).cast("timestamp"))
    q = F.col("query")
    return d.groupBy("user_id").agg(
        F.avg(word_count(q)).alias("avg_query_length"), (F.count_if(has_digit(q)) / F.count("*")).alias("numeric_query_ratio"),
        F.count_if(F.char_length(q) > long_chars).alias("long_queries_count"))


def funnel_columns(df: DataFrame) -> DataFrame:
    """Derived columns over the joined blocks: step times and rates, matches, activity flags, spending."""
    t = {s: F.col(f"last_{s}_time") for s in ("click", "order", "favorite")}
    rate = {"click_to_order_rate": "order", "click_to_cart_rate": "to_cart"}
    return df.withColumns({
        "last_click_hour": F.hour(t["click"]), "last_order_weekday": F.weekday(t["order"]),
        "click_to_order_days": whole_days(t["order"], t["click"]), "click_to_favorite_days": whole_days(t["favorite"], t["click"]),
        "main_cluster_match": match_code(F.col("main_search_cluster"), F.col("main_product_cluster")),
        "product_cluster_in_search_top3": F.coalesce(F.array_contains("top3_search_clusters", F.col("main_product_cluster")).cast("int"), F.lit(0)),
        **{n: F.coalesce(ratio(F.col(f"num_products_{s}"), F.col("num_products_click")), F.lit(0.0)) for n, s in rate.items()},
        "is_long_term_user": F.coalesce((F.col("days_since_first_click") > 10).cast("int"), F.lit(0)),
        "is_active_user": F.coalesce((F.col("days_since_last_click") < 7).cast("int"), F.lit(0)),
        "spending_rate": F.coalesce(ratio(F.col("sum_price_order"), F.col("days_since_first_order")), F.lit(0.0)),
    })


def search_product_comparison(search: DataFrame, product: DataFrame) -> DataFrame:
    """Search clusters against product clusters per searching user."""
    d = search.join(product, "user_id", "left")
    s, p = F.col("search_cluster_count"), F.col("product_cluster_count")
    return d.select(
        "user_id", (F.col("main_search_cluster") == F.col("main_product_cluster")).cast("int").alias("main_cluster_match"),
        F.abs(F.col("search_cluster_concentration") - F.col("product_cluster_concentration")).alias("main_cluster_ratio_diff"),
        (s - p).alias("main_cluster_count_diff"), (s / (p + 1)).alias("search_to_product_activity_ratio"))


def user_features(users: DataFrame, actions: DataFrame, products: DataFrame, searches: DataFrame, cutoff: str,
                  lookback: int, month: int = 30, week: int = 7) -> DataFrame:
    """All blocks joined onto a list of users, with the derived columns.

    The windowed logs are written out once; every block reads the columns it needs from there.
    """
    longest = max(lookback, month)
    actions = materialize(actions.where(_before(cutoff, longest)), "actions")
    searches = materialize(searches.where(_before(cutoff, lookback)), "searches")
    used = actions.where(_before(cutoff, lookback))
    blocks = [
        users, action_features(actions, products, cutoff, lookback), search_features(searches, cutoff, lookback, month, week),
        product_cluster_features(actions, products, cutoff, lookback), recent_activity(actions, products, cutoff, month),
        widget_block(used, [0, 1, 2, 3]),
    ]
    return funnel_columns(_join(blocks))


def more_blocks(actions: DataFrame, products: DataFrame, searches: DataFrame, cutoff: str, windows: list[int], long_chars: int = 20) -> list[DataFrame]:
    return [recent_windows(actions, products, cutoff, windows), time_patterns(actions, products, cutoff), brand_category(actions, products, cutoff),
            search_text(searches, cutoff, long_chars)]


def whole_user_table(users: DataFrame, actions: DataFrame, products: DataFrame, searches: DataFrame, cutoff: str, lookback: int,
                     month: int = 30, week: int = 7, windows: list[int] | None = None, long_chars: int = 20) -> DataFrame:
    """:func:`user_features` with the recent windows and the time, brand and search-text blocks, which look at all events before the cut-off."""
    known = user_features(users, actions, products, searches, cutoff, lookback, month, week)
    return _join([known, *more_blocks(actions, products, searches, cutoff, windows or [5, 10, 15], long_chars)])


def search_matches(actions: DataFrame, searches: DataFrame) -> DataFrame:
    """Per user: action clusters also searched for, and mean whole days from first such search to the action."""
    first = searches.groupBy("user_id", "cluster").agg(F.min("ts").alias("first_ts"))
    hit = F.col("first_ts").isNotNull()
    return actions.join(first, ["user_id", "cluster"], "left").groupBy("user_id").agg(
        F.countDistinct(F.when(hit, F.col("cluster"))).alias("matching_clusters"),
        F.avg(whole_days(F.col("ts"), F.col("first_ts"))).alias("mean_days"),
    )
