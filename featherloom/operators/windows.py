"""Window features per key, built on the chunked ordered operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featherloom.functions.dates import seconds_between, whole_days
from featherloom.functions.numbers import ratio
from featherloom.operators.ordered import known_around, previous, rolling, running
from featherloom.operators.stats import with_group_stats, with_stats
from featherloom.session import materialize


def rolling_stats(df: DataFrame, keys: list[str], order: list[str], value: str, rows: int, full: bool = False, **opts) -> DataFrame:
    """Rolling mean and sample deviation; ``full`` gives null until ``rows`` rows are there.

    Without ``full`` a one-row deviation is 0.
    """
    v = F.col(value)
    out = rolling(df, keys, order, rows, {"__m": F.avg(v), "__s": F.stddev_samp(v), "__n": F.count(F.lit(1))}, **opts)
    mean, std = f"rolling_mean_{rows}", f"rolling_std_{rows}"
    if full:
        ready = F.col("__n") == rows
        out = out.withColumns({mean: F.when(ready, F.col("__m")), std: F.when(ready, F.col("__s"))})
    else:
        out = out.withColumns({mean: F.col("__m"), std: F.coalesce("__s", F.lit(0.0))})
    return out.drop("__m", "__s", "__n")


def event_gaps(df: DataFrame, keys: list[str], ts: str, tie: str, out: str = "gap_seconds") -> DataFrame:
    """Seconds since the key's previous event; null on the first."""
    d = previous(df, keys, [ts, tie], {"__prev": F.col(ts)})
    return d.withColumn(out, seconds_between(F.col(ts), F.col("__prev"))).drop("__prev")


def gap_stats(df: DataFrame, keys: list[str], ts: str, tie: str, unit_seconds: float = 1.0, name: str = "txn_diff") -> DataFrame:
    """Mean, sample deviation, minimum and maximum gap per key."""
    g = F.col("gap_seconds") / F.lit(unit_seconds)
    return event_gaps(df, keys, ts, tie).groupBy(*keys).agg(
        F.avg(g).alias(f"mean_{name}"), F.stddev_samp(g).alias(f"std_{name}"), F.min(g).alias(f"min_{name}"), F.max(g).alias(f"max_{name}"))


def switch_stats(df: DataFrame, keys: list[str], ts: str, tie: str, value: str) -> DataFrame:
    """Per key: sum of absolute steps of a numeric category, number of switches, and mean whole
    days between switches."""
    d = previous(df.select(*keys, ts, tie, value), keys, [ts, tie], {"__pv": F.col(value)})
    d = materialize(d.withColumns({
        "__step": F.coalesce(F.abs(F.col(value) - F.col("__pv")), F.lit(0)),
        "__moved": F.coalesce(F.col(value) != F.col("__pv"), F.lit(False))}).drop(value, "__pv"), "switches")
    sums = d.groupBy(*keys).agg(F.sum("__step").alias("abs_id_change"), F.count_if(F.col("__moved")).alias("switch_count"))
    switches = previous(d.where(F.col("__moved")).select(*keys, ts, tie), keys, [ts, tie], {"__pt": F.col(ts)})
    gaps = switches.groupBy(*keys).agg(F.avg(whole_days(F.col(ts), F.col("__pt"))).alias("mean_switch_days"))
    return sums.join(gaps, keys, "left")


def group_zscore(df: DataFrame, keys: list[str], value: str, out: str = "z") -> DataFrame:
    """(x - mean) / population deviation per key; null when the deviation is 0."""
    d = with_group_stats(df, keys, __m=F.avg(value), __s=F.stddev_pop(value))
    return d.withColumn(out, ratio(F.col(value) - F.col("__m"), F.col("__s"))).drop("__m", "__s")


def fill_negatives(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Negative values become the mean of the key's other values."""
    d = with_group_stats(df, keys, __m=F.avg(F.when(F.col(value) >= 0, F.col(value))))
    return d.withColumn(out, F.when(F.col(value) < 0, F.col("__m")).otherwise(F.col(value).cast("double"))).drop("__m")


def drop_repeats(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Remove rows whose value equals the row before."""
    d = previous(df, keys, order, {"__pv": F.col(value), "__has": F.lit(True)})
    same = F.col("__has").isNotNull() & F.col(value).eqNullSafe(F.col("__pv"))
    return d.where(~same).select(*df.columns)


def since_last(df: DataFrame, keys: list[str], order: list[str], hit: Column, out: str) -> DataFrame:
    """Rows since the last hit (0 on a hit), or since the start when there was none."""
    d = known_around(df, keys, order, {}, hit, pos="__pos")
    return d.withColumn(out, F.col("__pos") - F.coalesce("prev___pos", F.lit(0).cast("long"))).select(*df.columns, out)


def mean_percent_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Average rank of tied values divided by the number of values."""
    freq = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    r = running(freq, [], [value], {"__hi": ("sum", F.col("__n"))}, totals=True)
    rank = F.col("__hi") - F.col("__n") + (F.col("__n") + 1) / 2
    return df.join(r.select(value, (rank / F.col("__hi_total")).alias(out)), value, "left")


def min_max(df: DataFrame, value: str, out: str) -> DataFrame:
    s = F.col("__mm")
    d = with_stats(df, name="__mm", lo=F.min(value), hi=F.max(value))
    return d.withColumn(out, ratio(F.col(value) - s["lo"], s["hi"] - s["lo"])).drop("__mm")


def interpolate(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Linear over row numbers between known values; the tail repeats the last one, the head stays null."""
    v = F.col(value)
    d = known_around(df, keys, order, {"v": v}, v.isNotNull(), pos="p")
    share = ratio((F.col("p") - F.col("prev_p")).cast("double"), (F.col("next_p") - F.col("prev_p")).cast("double"))
    between = F.col("prev_v") + (F.col("next_v") - F.col("prev_v")) * F.coalesce(share, F.lit(0.0))
    value_out = F.when(v.isNotNull(), v.cast("double")).otherwise(F.coalesce(between, F.col("prev_v").cast("double")))
    return d.withColumn(out, value_out).select(*df.columns, out)


def cumulative_product(df: DataFrame, keys: list[str], order: list[str], factor: Column, out: str) -> DataFrame:
    """Running product: logarithms of the sizes, the number of negative factors and whether there was a zero; null factors are passed over."""
    f = factor.cast("double")
    d = running(df, keys, order, {"__l": ("sum", F.ln(F.abs(F.nullif(f, F.lit(0.0))))), "__minus": ("sum", (f < 0).cast("long")),
                                  "__zero": ("max", (f == 0).cast("int")), "__n": ("count", f)})
    size = F.exp(F.coalesce("__l", F.lit(0.0))) * F.when(F.col("__minus") % 2 == 1, -1.0).otherwise(1.0)
    return d.withColumn(out, F.when(F.col("__zero") == 1, 0.0).when(F.col("__n") > 0, size)).drop("__l", "__minus", "__zero", "__n")


def percent_change(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    d = previous(df, keys, order, {"__pv": F.col(value)})
    return d.withColumn(out, ratio(F.col(value), F.col("__pv")) - 1).drop("__pv")


def selection_shares(df: DataFrame, order: list[str], arm: str, arms: list) -> DataFrame:
    """After every step, the share of steps so far that chose each arm."""
    flags = {f"__a{i}": ("sum", (F.col(arm) == a).cast("long")) for i, a in enumerate(arms)}
    d = running(df, [], order, {"__n": ("count", F.lit(1)), **flags})
    return d.select(*df.columns, *[(F.col(f"__a{i}") / F.col("__n")).alias(f"share_{a}") for i, a in enumerate(arms)])


def replay_rate(df: DataFrame, order: list[str], logged: str, chosen: str, reward: str, out: str) -> DataFrame:
    """Running mean reward over the rows where the chosen arm is the logged one."""
    hits = df.where(F.col(logged) == F.col(chosen))
    d = running(hits, [], order, {"__s": ("sum", F.col(reward).cast("double")), "__n": ("count", F.lit(1))})
    return d.withColumn(out, F.col("__s") / F.col("__n")).drop("__s", "__n")


def min_equal_gap(df: DataFrame, pos: str, value: str) -> DataFrame:
    """Fewest rows between two equal values, -1 when all differ."""
    d = previous(df.select(pos, value), [value], [pos], {"__p": F.col(pos)})
    return d.agg(F.coalesce(F.min(F.col(pos) - F.col("__p") - 1), F.lit(-1).cast("long")).alias("min_gap"))


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    many = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > 1).select(*keys)
    return df.join(many, keys, "left_semi")
