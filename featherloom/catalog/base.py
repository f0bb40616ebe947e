"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featherloom.session import apply_settings


class Tables:
    """The test tables of one folder, read lazily and whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def actions(self) -> DataFrame:
        """``events`` in the role of a shop action log."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.events.select(
            "event_id", "user_id", "ts", F.col("event_type").alias("action"), "value",
            k.cast("long").alias("product_id"), (k % 7).alias("cluster"),
            F.when(k % 5 != 0, k % 4).alias("widget"),
        )

    @property
    def searches(self) -> DataFrame:
        """``documents`` in the role of a search log."""
        return self.documents.select(
            "doc_id", (F.col("doc_id") % 150).alias("user_id"),
            F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") * 7919) % 2592000).alias("ts"),
            F.col("text").alias("query"),
            F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("cluster"),
        )

    @property
    def products(self) -> DataFrame:
        return self.part.select(
            F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price"), F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"), (F.col("p_size") % 7).alias("cluster"))

    @property
    def txns(self) -> DataFrame:
        """``orders`` in the role of card transactions."""
        key = F.col("o_orderkey")
        return self.orders.select(
            key.alias("txn_id"), F.col("o_custkey").alias("client"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (key % 24).cast("int"))).alias("ts"),
            F.col("o_totalprice").alias("amount"), F.lpad(((key % 37) * 101).cast("string"), 4, "0").alias("mcc"),
            F.concat(F.lit("m"), (key % 23).cast("string")).alias("merchant"))

    @property
    def scored(self) -> DataFrame:
        """Labels with two deterministic scores in (0, 1), many of them tied."""
        n = F.col("n_chars")
        return self.labels.join(self.documents.select("doc_id", "n_chars", "lang"), "doc_id").select(
            "doc_id", "lang", F.col("quality").alias("y"), "toxic",
            ((n % 97 + 1) / F.lit(100.0)).alias("p1"), ((n % 41 + 1) / F.lit(50.0)).alias("p2"),
            n.cast("double").alias("x"),
        )


# the same derived tables for the SQL side
ACTIONS = r"""actions AS (
  SELECT event_id, user_id, ts, event_type AS action, value, k AS product_id, CAST(k % 7 AS INT) AS cluster,
         CASE WHEN k % 5 <> 0 THEN CAST(k % 4 AS INT) END AS widget
  FROM (SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k FROM events))"""
SEARCHES = r"""searches AS (
  SELECT doc_id, doc_id % 150 AS user_id,
         TIMESTAMP '2024-01-01' + to_seconds(CAST((doc_id * 7919) % 2592000 AS BIGINT)) AS ts, text AS query,
         CAST(regexp_extract(source, '(\d+)', 1) AS INT) AS cluster
  FROM documents)"""
PRODUCTS = """products AS (SELECT p_partkey AS product_id, p_retailprice AS price, p_brand AS brand, p_type AS category, p_size % 7 AS cluster FROM part)"""
TXNS = """txns AS (SELECT o_orderkey AS txn_id, o_custkey AS client, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS ts, o_totalprice AS amount,
  lpad(CAST(o_orderkey % 37 * 101 AS VARCHAR), 4, '0') AS mcc, 'm' || (o_orderkey % 23) AS merchant FROM orders)"""
SCORED = """scored AS (
  SELECT doc_id, lang, quality AS y, toxic, (n_chars % 97 + 1) / 100.0::DOUBLE AS p1,
         (n_chars % 41 + 1) / 50.0::DOUBLE AS p2, n_chars::DOUBLE AS x
  FROM labels JOIN documents USING (doc_id))"""


def uniform_sql(key: str, seed: int) -> str:
    """SQL twin of ``hash_uniform``."""
    return f"((CAST('0x' || substr(md5({key} || ':{seed}'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"


Query = Callable[[Tables], DataFrame]


class Book:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if sql:
                self.sql[name] = sql
            return fn

        return keep


# the slope of monthly means as the operator takes it: whole millionths, one division of exact numbers
SLOPE = ("CASE WHEN count(*) < 2 THEN 0 ELSE CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE) "
         "/ CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) / 1000000.0::DOUBLE END")


def monthly_mean(value: str) -> str:
    return f"((2 * CAST(sum(CAST(round({value} * 1000000) AS BIGINT)) AS HUGEINT) + count(*)) // (2 * count(*)))"


def rnd(col: Column | str, places: int = 6) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, places)


def cents(col: Column | str) -> Column:
    """Exact money sum, returned as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)")).cast("double")
