"""Card transactions: per-client feature table.

Input: ``txns(client, ts, amount, mcc, merchant, txn_id)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.functions import dates
from featherloom.functions.strings import slice_text
from featherloom.operators import aggregates as ag
from featherloom.operators import categories as cat
from featherloom.operators.encode import equal_width_bin
from featherloom.operators.ordered import group_quantiles
from featherloom.operators.stats import join_groups, with_stats
from featherloom.operators.windows import gap_stats, group_zscore
from featherloom.session import materialize

CLIENT = ["client"]
PARTS = ["morning", "day", "evening", "night"]


def transaction_columns(txns: DataFrame, holidays: list[str], popular: int = 500) -> DataFrame:
    """Row-level columns: calendar, code slices, merchant frequency, and amount bins."""
    d = txns.where(F.col("amount").isNotNull())
    freq = d.groupBy("merchant").agg(F.count("*").alias("merchant_freq"))
    d = join_groups(d, freq, ["merchant"])
    ts, mcc = F.col("ts"), F.col("mcc")
    d = d.withColumns({
        "hour": F.hour(ts), "is_weekend": dates.is_weekend(ts).cast("int"), "is_holiday": dates.on_dates(ts, holidays).cast("int"),
        "time_of_day": dates.day_part(ts), "mcc_pair": slice_text(mcc, 0, 2), "mcc_triplet": slice_text(mcc, 0, 3),
        "is_popular": (F.col("merchant_freq") > popular).cast("int")})
    return equal_width_bin(d, "amount", "amount_bin")


def _shares(c: str) -> dict[str, str]:
    return {"unique": f"unique_{c}s", "concentration": f"top_{c}_share", "bits": f"{c}_entropy"}


def client_features(rows: DataFrame) -> DataFrame:
    """Everything about a client: one wide aggregate, and joined blocks for the two-level statistics.

    The rows are written out once, because a dozen blocks read a few columns of them each.
    """
    rows = materialize(rows, "client_rows")
    amount = F.col("amount")
    base = rows.groupBy("client").agg(
        F.count("amount").alias("count_amount"), F.avg(amount).alias("avg_amount"), F.sum(amount.cast("decimal(18,2)")).cast("double").alias("total_amount"),
        F.stddev_samp(amount).alias("std_amount"), F.min(amount).alias("min_amount"), F.max(amount).alias("max_amount"),
        F.min("ts").alias("first_txn"), F.max("ts").alias("last_txn"),
        F.avg("merchant_freq").alias("mean_merchant_freq"), F.max("merchant_freq").alias("max_merchant_freq"),
        F.avg("is_popular").alias("popular_merchant_rate"), F.avg("is_weekend").alias("weekend_rate"), F.avg("is_holiday").alias("holiday_rate"),
        *ag.category_shares("time_of_day", PARTS, "tod"), *ag.category_shares("amount_bin", list(range(10)), "amount_bin"),
        F.avg("hour").alias("mean_hour"), F.stddev_samp("hour").alias("std_hour"), ag.unbiased_skew("amount").alias("amount_skew"))
    latest = with_stats(base, name="__all", last=F.max("last_txn"))
    base = latest.withColumn("days_since_last_txn", dates.whole_days(F.col("__all.last"), F.col("last_txn"))).drop("__all")
    # each category is counted once per client; shares, entropies, first values and prefixes all come from these counts
    counts = {c: materialize(cat.category_counts(rows, CLIENT, c), "client_counts") for c in ("mcc", "merchant", "time_of_day")}
    summary = {c: cat.summary_of_counts(d, CLIENT, c) for c, d in counts.items()}
    top = [summary[c].select("client", F.col("top_1").alias(f"top_{n}_1"), F.col("top_2").alias(f"top_{n}_2"), *[F.col(x).alias(y) for x, y in more.items()])
           for c, n, more in (("mcc", "mcc", _shares("mcc")), ("merchant", "merchant", _shares("merchant")), ("time_of_day", "tod", {}))]
    prefixes = [counts["mcc"].select("client", slice_text(F.col("mcc"), 0, k).alias("v")).distinct().groupBy("client").agg(F.count("v").alias(n))
                for k, n in ((2, "unique_mcc_pairs"), (3, "unique_mcc_triplets"))]
    blocks = [
        base, ag.weekly_counts(rows, CLIENT, "ts", "weekly_txn"), ag.monthly_trend(rows, CLIENT, "ts", "amount", "amount_trend"), *top,
        gap_stats(rows.select("client", "ts", "txn_id"), CLIENT, "ts", "txn_id"),
        group_quantiles(rows, CLIENT, "amount", {"amount_median": 0.5, "amount_q25": 0.25, "amount_q75": 0.75}), *prefixes,
    ]
    return reduce(lambda a, b: a.join(b, "client", "left"), blocks)


def optional_features(rows: DataFrame, mcc_groups: dict[str, list[str]], recent_days: int = 14) -> DataFrame:
    """Repetition, outliers, entropies in nats, the last days, and shares of code groups."""
    rows = materialize(rows, "client_rows")
    z = group_zscore(rows.select("client", "amount"), CLIENT, "amount")
    outliers = z.groupBy("client").agg(F.avg(F.coalesce(F.abs("z") > 3, F.lit(False)).cast("int")).alias("amount_outlier_ratio"))
    entropies = [cat.category_profile(rows, CLIENT, c).select("client", F.col("entropy").alias(n))
                 for c, n in (("mcc", "mcc_entropy"), ("merchant", "merchant_entropy"), ("time_of_day", "tod_entropy"))]
    since = with_stats(rows, name="__all", last=F.max("ts"))
    late = since.where(F.col("ts") >= F.col("__all.last") - F.make_dt_interval(F.lit(recent_days)))
    recent = late.groupBy("client").agg(
        F.count("amount").alias("recent_txn_count"), F.avg("amount").alias("recent_amount_mean"), F.stddev_samp("amount").alias("recent_amount_std"))
    groups = rows.groupBy("client").agg(*[F.avg(F.col("mcc").isin(v).cast("int")).alias(f"{n}_ratio") for n, v in mcc_groups.items()])
    gaps = gap_stats(rows.select("client", "ts", "txn_id"), CLIENT, "ts", "txn_id", 86400.0, "interval_days").drop("min_interval_days", "max_interval_days")
    return reduce(lambda a, b: a.join(b, "client", "left"), [groups, gaps, outliers, *entropies, recent])
