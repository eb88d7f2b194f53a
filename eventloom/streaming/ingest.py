"""Incremental ingest of raw batches as a stream that ends when nothing is new (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.records import transform


def ingest_available(spark: SparkSession, source: str, target: str, checkpoint: str) -> None:
    """Append the records of new files under `source` to `target`; the checkpoint is the registry of
    finished files. Line numbers are not kept, as streams of text have none."""
    lines = spark.readStream.text(source).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.lit(0).alias("line_no"), F.trim("value").alias("raw"))

    def write(batch: DataFrame, _: int) -> None:
        transform(batch.filter("raw <> ''")).write.mode("append").parquet(target)

    lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
