"""Profiling and data quality (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherloom.catalog.base import ACTIONS, SEARCHES, Book, rnd
from featherloom.operators import profile as pf

book = Book()

# columns of the profiled table and whether they are numeric
COLS = {"p_partkey": True, "p_brand": False, "p_size": True, "p_note": False, "p_rest": True}
SRC = "src AS (SELECT p_partkey, p_brand, p_size, CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN p_type END AS p_note, p_size % 3 AS p_rest FROM part)"


def _src(t):
    note = F.when(F.col("p_size") % 4 == 0, "").when(F.col("p_size") % 4 == 1, F.col("p_type"))
    return t.part.select("p_partkey", "p_brand", "p_size", note.alias("p_note"), (F.col("p_size") % 3).alias("p_rest"))


def _info_sql(name, numeric, keep):
    zero = f"avg(CASE WHEN {name} = 0 THEN 1 ELSE 0 END)" if numeric else "0.0"
    empty = "0.0" if numeric else f"avg(CASE WHEN {name} = '' THEN 1 ELSE 0 END)"
    return f"""SELECT '{name}' AS "column", (SELECT count(*) FROM (SELECT DISTINCT {name} FROM src)) AS n_unique, avg(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) AS nan_frac,
  {zero} AS zero_frac, {empty} AS empty_frac, (SELECT CAST({name} AS VARCHAR) FROM src WHERE {keep} GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1) AS mode_el,
  (SELECT count(*) FROM src WHERE {keep} GROUP BY {name} ORDER BY count(*) DESC LIMIT 1) AS mode_n, (SELECT count(*) FROM src WHERE {keep}) AS base, count(*) AS rows,
  CAST(min({name}) AS VARCHAR) AS example FROM src"""


def _union(keep):
    return " UNION ALL ".join(_info_sql(c, n, keep(c, n)) for c, n in COLS.items())


@book.add("q01_column_info", f"""WITH {SRC}, i AS ({_union(lambda c, n: f"{c} IS NOT NULL AND {c} <> " + ("0" if n else "''"))}),
m AS (SELECT *, round(mode_n / base, 2) AS mode_frac, greatest(nan_frac, zero_frac, empty_frac, round(mode_n / base, 2)) AS top FROM i)
SELECT "column", n_unique, example, mode_el, round(nan_frac, 6) AS nan_frac, round(zero_frac, 6) AS zero_frac, round(empty_frac, 6) AS empty_frac, mode_frac, round(greatest(mode_frac - top, top), 6) AS trash_score FROM m""")
def _(t):
    d = pf.column_info(_src(t))
    return d.select("column", "n_unique", "example", "mode_el", "mode_frac", *[rnd(c).alias(c) for c in ("nan_frac", "zero_frac", "empty_frac", "trash_score")])


@book.add("q02_column_info_threshold", f"""WITH {SRC}, i AS ({_union(lambda c, n: f"{c} IS NOT NULL")})
SELECT "column", n_unique, mode_el, round(nan_frac, 6) AS nan_frac, round(zero_frac, 6) AS zero_frac, round(empty_frac, 6) AS empty_frac, round(mode_n / rows, 6) AS mode_frac,
  round(greatest(nan_frac + zero_frac + empty_frac, CASE WHEN mode_n / rows > 0.3 THEN mode_n / rows ELSE 0 END), 6) AS trash_score FROM i""")
def _(t):
    d = pf.column_info_by_threshold(_src(t), 0.3)
    return d.select("column", "n_unique", "mode_el", *[rnd(c).alias(c) for c in ("nan_frac", "zero_frac", "empty_frac", "mode_frac", "trash_score")])


NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _table_sql(c):
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 1) AS mean, round(stddev_samp({c}), 1) AS std, round(min({c}), 1) AS min, round(quantile_cont({c}, 0.25), 1) AS q25,
 round(median({c}), 1) AS q50, round(quantile_cont({c}, 0.75), 1) AS q75, round(quantile_cont({c}, 0.95), 1) AS q95, round(max({c}), 1) AS max, round(max({c}) - min({c}), 1) AS iqr, count(DISTINCT {c}) AS nunique,
 (SELECT count(*) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS mode_count, 0::BIGINT AS null_count FROM lineitem"""


@book.add("q03_info_table", f"SELECT \"column\", count, nunique, mode_count, null_count, " + ", ".join(f"CASE WHEN nunique >= 20 THEN {c}::DOUBLE END AS {c}" for c in ("mean", "std", "min", "q25", "q50", "q75", "q95", "max", "iqr"))
          + " FROM (" + " UNION ALL ".join(_table_sql(c) for c in NUMBERS) + ")")
def _(t):
    d = pf.info_table(t.lineitem.select(*NUMBERS), distinct_limit=20)
    return d.select("column", "count", "nunique", "mode_count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "q95", "max", "iqr")


@book.add("q04_classify_columns", "SELECT c AS \"column\", n AS nunique, CASE WHEN n < 55 THEN 'categorical' ELSE 'numerical' END AS kind FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, count(DISTINCT {c}) AS n FROM lineitem" for c in [*NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]) + ")")
def _(t):
    return pf.classify_columns(t.lineitem)


@book.add("q05_describe", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, max({c}) AS max,
  round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75 FROM lineitem""" for c in NUMBERS))
def _(t):
    d = pf.describe(t.lineitem, NUMBERS)
    return d.select("column", "count", "min", "max", *[rnd(c, 4).alias(c) for c in ("mean", "std", "q25", "q50", "q75")])


@book.add("q06_shares_by_class", f"""WITH {ACTIONS} SELECT action, 'value' AS "column", round(avg(CASE WHEN abs(value) <= 1 THEN 1 ELSE 0 END), 6) AS zero_share, 0.0::DOUBLE AS null_share FROM actions GROUP BY 1
UNION ALL SELECT action, 'widget', round(avg(CASE WHEN abs(widget) <= 1 THEN 1 ELSE 0 END), 6), round(avg(CASE WHEN widget IS NULL THEN 1 ELSE 0 END), 6) FROM actions GROUP BY 1""")
def _(t):
    d = pf.shares_by_class(t.actions, "action", ["value", "widget"], 1.0)
    return d.select("action", "column", rnd("zero_share").alias("zero_share"), rnd("null_share").alias("null_share"))


@book.add("q07_class_histogram", "SELECT CAST(least(floor(value / 10), 19) AS BIGINT) AS bin, event_type, count(*) AS n FROM events WHERE value BETWEEN 0 AND 200 GROUP BY 1, 2")
def _(t):
    return pf.class_histogram(t.events, "event_type", "value", 0.0, 200.0, 20)


@book.add("q08_labelled_counts", f"WITH {SRC} SELECT CASE WHEN p_note IS NULL THEN '<NAN>' WHEN p_note = '' THEN '<EMPTY>' ELSE p_note END AS value, count(*) AS n FROM src GROUP BY 1")
def _(t):
    return pf.labelled_counts(_src(t), "p_note")


@book.add("q09_merge_rare", "SELECT CASE WHEN n >= 0.01 * (SELECT count(*) FROM part) THEN p_name ELSE 'Other' END AS p_name, CAST(sum(n) AS BIGINT) AS n FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1) GROUP BY 1")
def _(t):
    return pf.merge_rare(t.part.select("p_name"), "p_name", 0.01).groupBy("p_name").agg(F.count("*").alias("n"))


@book.add("q10_unlabelled_count", "SELECT count(*) FILTER (WHERE NOT regexp_matches(lower(text), 'tion|ing')) AS unlabelled, count(*) AS n FROM documents")
def _(t):
    from featherloom.operators.encode import keyword_rules

    cluster = keyword_rules(F.col("text"), [("tion", 1), ("ing", 2)])
    return t.documents.agg(F.count_if(cluster == -1).alias("unlabelled"), F.count("*").alias("n"))
