"""Helpers shared by the corpus operators: scratch tables, table access and word splitting."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Separators of contract words: everything that is not a digit, an ASCII letter or beyond ASCII.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ASCII white space, as the contracts define it.
BLANKS = r"[\x20\x09-\x0D]+"


#: Spark's setting that removes an execution's shuffle files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of an Arrow batch at most, so that long texts do not fill an executor.
BATCH_ROWS = 1000


def release() -> None:
    """Return freed memory of a Python worker to the system; workers are kept between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def returning(run: Callable) -> Callable:
    """`run` over Arrow batches, after which its worker returns the memory that the task has freed."""

    def wrapped(batches):
        yield from run(batches)
        release()

    return wrapped


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_ROWS; a smaller bound stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir.

    Only where the session names none (tests, local mode) a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="eventloom-")
        spark.sparkContext.setCheckpointDir(base)
        base = f"file://{base}"
    return base


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to a table in the shared folder and read it back: lineage ends there, so a
    lost executor costs only re-reading, and several consumers do not recompute the work. Shuffle
    files of the write go as soon as it ends; `discard` removes the table when nothing reads it."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{scratch_dir(spark)}/eventloom/{label}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, was)
    held = spark.read.schema(df.schema).parquet(path)
    held._settled_at = path
    return held


def discard(*tables: DataFrame) -> None:
    """Remove tables that `settle` wrote and that no DataFrame still to be run reads."""
    for held in tables:
        spark, path = held.sparkSession, held._settled_at
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spare(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Pure-ASCII texts take the fast built-in, which is the same there."""
    ascii_only = F.length(col) == F.octet_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def split_words(col: Column, separators: str) -> Column:
    """Words between runs of `separators`; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), separators), "")
