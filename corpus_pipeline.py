"""From raw documents to a sharded training mix: five stages, each written as Parquet and read again by the next.

toxicity         documents that the classifier rejects go
near_dedup       one document of each group stays that SimHash fingerprints of 4-word shingles link at 4 or fewer differing bits
decontamination  documents that contain a benchmark item go
mixing           sources are brought to their target weights; documents repeat as often as the mix takes them
sharding         every row gets its shard and slot
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherloom.llm import decontaminate, mixing, sharding, simhash, toxicity
from featherloom.llm.common import word_count
from featherloom.session import apply_settings, materialize

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, word_count(F.col("text")))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hashed = docs.withColumn("__text", F.xxhash64("text"))
    return sharding.assign(hashed, SHARDS, ["doc_id", "__text"]).drop("__text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

# fingerprints, edit distances and a trained classifier are beyond SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = apply_settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
