"""The queries opN_<name> over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, dialogue_repair, fill_middle, lang_cnn, line_crf, mixing, near_dedup, quality_mil, secret_scan, simhash, token_output, url_filter, warc

TOKENIZER = "public:word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"), url_filter.rules_frame(spark))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encode_documents(_read(spark, sf_dir, "documents"), TOKENIZER)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_read(spark, sf_dir, "pages"))


def op6_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return quality_mil.score(documents, quality_mil.train(documents, _read(spark, sf_dir, "labels")))


def op7_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return lang_cnn.predict(documents, lang_cnn.train(documents))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return line_crf.judge(documents, line_crf.train(documents, _read(spark, sf_dir, "labels")))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(_read(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.damaged_and_repaired(_read(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_url_filter": op2_url_filter,
    "op3_token_output": op3_token_output,
    "op4_secret_scan": op4_secret_scan,
    "op5_warc": op5_warc,
    "op6_quality_mil": op6_quality_mil,
    "op7_language_cnn": op7_language_cnn,
    "op8_mix_sources": op8_mix_sources,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_dedup": op10_near_dedup,
    "op11_fill_middle": op11_fill_middle,
    "op12_simhash": op12_simhash,
    "op13_dialogue_repair": op13_dialogue_repair,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": url_filter.ORACLE,
    "op4_secret_scan": secret_scan.oracle(),
    "op5_warc": warc.ORACLE,
    "op11_fill_middle": fill_middle.ORACLE,
    "op13_dialogue_repair": dialogue_repair.oracle(),
}
