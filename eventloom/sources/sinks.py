"""Writers and the registry of finished work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parts(df: DataFrame, path: str, order: list, part_size: int = 200_000) -> None:
    """JSON lines in global order, at most part_size rows a file, replacing what was there."""
    df.orderBy(*order).write.mode("overwrite").option("maxRecordsPerFile", part_size).option("ignoreNullFields", True).json(path)


def replace_folder(spark: SparkSession, made: str, path: str) -> None:
    """Put the finished folder `made` in the place of `path`: what was there moves aside first and is
    deleted last, and moves back if the exchange fails, so `path` never holds half an output."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = f"{path}.bak"
    fs.delete(at(aside), True)
    if fs.exists(at(path)) and not fs.rename(at(path), at(aside)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(at(made), at(path)):
        fs.rename(at(aside), at(path))
        raise OSError(f"cannot put {made} in the place of {path}")
    fs.delete(at(aside), True)


def export(spark: SparkSession, folder: str, cleaned: DataFrame, duplicates: DataFrame | None = None, rejects: DataFrame | None = None, part_size: int = 200_000) -> None:
    """Cleaned records as JSON lines in <folder>/cleaned and, where given, duplicates and rejects beside
    them. Each is written whole under another name and then takes the place of the earlier one."""
    for name, df in (("cleaned", cleaned), ("duplicates", duplicates), ("rejects", rejects)):
        if df is not None:
            order = [c for c in ("published_at", "id", "batch", "line_no") if c in df.columns]
            write_parts(df, f"{folder}/.{name}.tmp", order, part_size)
            replace_folder(spark, f"{folder}/.{name}.tmp", f"{folder}/{name}")


def write_by_kind(df: DataFrame, path: str, kind: str, raw: str) -> None:
    """Lines as they are, in one folder for each kind; unknown kinds in _unknown."""
    named = df.select(F.coalesce(F.nullif(F.col(kind), F.lit("")), F.lit("_unknown")).alias("kind"), F.col(raw).alias("value"))
    named.write.mode("overwrite").partitionBy("kind").text(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append keyed results; `pending` and `latest` read them."""
    df.write.mode("append").parquet(path)


def latest(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return log.groupBy(key).agg(F.max_by(F.struct("*"), F.col(order)).alias("r")).select("r.*")


def pending(work: DataFrame, log: DataFrame, key: str, retry_errors: bool = False) -> DataFrame:
    """Work whose key is not in the log. Errors count as done unless they are to be retried."""
    done = log.filter("_error IS NULL") if retry_errors and "_error" in log.columns else log
    return work.join(done.select(key).distinct(), key, "left_anti")


def pending_batches(spark: SparkSession, batches: DataFrame, registry: DataFrame, force: bool = False) -> DataFrame:
    """Batches that are not registered as complete; all of them when forced."""
    return batches if force else batches.join(registry.filter("complete").select("batch"), "batch", "left_anti")


def result_rows(df: DataFrame) -> DataFrame:
    """Results without recorded errors."""
    return df.filter("_error IS NULL") if "_error" in df.columns else df
