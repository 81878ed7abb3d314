"""A training-corpus pipeline: quality rules, near-dedup, decontamination, mixing, token output. Part of subpackage llm.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that the stage before kept; run() writes each
stage's rows as Parquet in the shared scratch folder and reads them back. Stages can't be expressed in SQL (models,
sketches and tokenizers), so ORACLE_SQL is None and the tests compare them with brute force. Every stage takes empty
tables, very long texts and extra columns, which it carries along under their own names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressmill.llm import common, decontaminate, line_crf, mixing, near_dedup, token_output
from pressmill.llm.queries import TOKENIZER


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line labels reject go: null, empty and short texts too; rows that repeat share one fate."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return line_crf.keep_documents(docs, line_crf.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest doc_id stays, once; null texts and rows without doc_id stay."""
    return near_dedup.first_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; null and empty texts stay, an empty benchmark takes nothing."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them; texts without words are never taken, null is a source like any other."""
    return mixing.apply_mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the scratch folder; the rows say where each document stands in them. Copies of a document follow each other, a null or empty text is its end id."""
    return token_output.encode_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("mixing", mix_sources),
    ("token_output", token_files),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), name)
    return docs
