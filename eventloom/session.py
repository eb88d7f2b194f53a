"""Session settings and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", partitions: int = 8, **options) -> SparkSession:
    """A session with the settings the engine relies on: UTC, adaptive execution, duplicate JSON keys."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    return SparkSession.builder.master(master).config(map=conf | options).getOrCreate()


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the folder that spark.checkpoint.dir names (a temporary one only where none is
    set) and read it back, so later loss of an executor costs only re-reading."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="eventloom-")
        spark.sparkContext.setCheckpointDir(base)
        base = f"file://{base}"
    path = f"{base}/eventloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
