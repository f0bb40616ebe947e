"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "featherloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every operator assumes (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return apply_settings(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Runtime settings that make timestamps read as UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there driver and
    executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="featherloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


_written: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for one written table."""
    _written.append(f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}")
    return _written[-1]


def discard(spark: SparkSession, written: str) -> None:
    """Delete one table written under :func:`scratch_path`, when nothing will read it again."""
    _written.remove(written)
    path = spark._jvm.org.apache.hadoop.fs.Path(written)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this process wrote under :func:`scratch_path`. Call it when every result that reads it has been consumed."""
    while _written:
        discard(spark, _written[-1])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
