"""The queries of this subpackage over the driver's tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import decontamination, host_rules, html, jaccard, packing, quality, substring, tokens, toxicity, warc
from eventloom.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokens.default_tokenizer())


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), 0.3)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(spark, table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.default_tokenizer())


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_host_rules(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (
        op1_decontamination, op2_packing, op3_substring_dedup, op4_quality_classifier, op5_jaccard_join,
        op6_token_counts, op7_html_extraction, op8_quality_rules, op9_toxicity, op10_warc,
    )
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express and finish on whole tables."""
    return {"op1_decontamination": decontamination.ORACLE, "op5_jaccard_join": jaccard.ORACLE, "op8_quality_rules": host_rules.ORACLE, "op10_warc": warc.ORACLE}
