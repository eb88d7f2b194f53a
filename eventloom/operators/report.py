"""Counts and reports of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, most first; null values are skipped."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def summary(accepted: DataFrame, rejected: DataFrame, cleaned: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row of totals; input is accepted and rejected, accepted is cleaned and duplicates."""
    parts = {"accepted": accepted, "rejected": rejected, "cleaned": cleaned, "duplicates": duplicates}
    tagged = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
        tagged = one if tagged is None else tagged.union(one)
    row = tagged.groupBy().agg(*[F.sum(F.when(F.col("what") == n, F.col("n"))).alias(n) for n in parts])
    return row.withColumn("input", F.col("accepted") + F.col("rejected"))


def extrapolate(total_bytes: int, rows: int, target: int) -> int:
    """Bytes for a target number of rows, in proportion."""
    return int(total_bytes / rows * target) if rows else 0


def near_report(pairs: DataFrame, most: int = 10_000) -> DataFrame:
    """Decided pairs by status and falling scores: a top-k report."""
    return pairs.orderBy("status", F.desc("jaccard"), F.desc("fuzzy"), "l", "r").limit(most)
