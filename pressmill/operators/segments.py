"""Reassembly of OCR segments: ids taken apart and put together, texts knit in order, token sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text_udf import knit_parts

KEYS = ["issue_id", "page_number", "block", "column", "class", "reading_order"]


def decompose(custom_id: Column) -> dict[str, Column]:
    """issue_id, page_number, class, block, column, reading_order, segment of '<issue>_page_<n>_<class>_B<b>C<c>R<r>_segment_<s>'; what is no number is 0."""
    number = lambda pattern: F.coalesce(F.regexp_extract(custom_id, pattern, 1).try_cast("int"), F.lit(0))
    rest = F.split_part(custom_id, F.lit("_page_"), F.lit(2))
    return {
        "issue_id": F.split_part(custom_id, F.lit("_page_"), F.lit(1)), "page_number": F.coalesce(F.split_part(rest, F.lit("_"), F.lit(1)).try_cast("int"), F.lit(0)),
        "class": F.regexp_extract(rest, r"^[^_]*_(.*)_B\d+C\d+R\d+", 1), "block": number(r"_B(\d+)C\d+R\d+"), "column": number(r"_B\d+C(\d+)R\d+"), "reading_order": number(r"_B\d+C\d+R(\d+)"),
        "segment": number(r"_segment_(\d+)$"),
    }


def with_ids(df: DataFrame) -> DataFrame:
    """box_page_id, page_id and bbox_uid from the parts."""
    df = df.withColumn("box_page_id", F.concat(F.lit("B"), "block", F.lit("C"), "column", F.lit("R"), "reading_order"))
    df = df.withColumn("page_id", F.concat("issue_id", F.lit("_page_"), F.col("page_number").cast("string")))
    return df.withColumn("bbox_uid", F.concat_ws("_", "page_id", "box_page_id"))


def totals(segments: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return segments.groupBy(*keys).agg(F.count("*").alias("segment_count"), *[F.sum(c).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")])


def knit_segments(segments: DataFrame, keys: list[str] = KEYS, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per box: texts knit in segment order, tokens summed. Only the knitting leaves the JVM."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("segment", *ties, "content"))), lambda s: s["content"])
    return segments.groupBy(*keys).agg(parts.alias("_parts"), F.count("*").alias("segment_count"), *[F.sum(c).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]).withColumn("content", knit_parts("_parts")).drop("_parts")


def clean_content(df: DataFrame) -> DataFrame:
    """Fences off, long titles become text, everything but tables cleaned."""
    bare = T.strip_fences(F.col("content"))
    kind = F.when((F.col("class") == "title") & (F.col("completion_tokens") > 50), "text").otherwise(F.col("class"))
    return df.withColumn("content", bare).withColumn("class", kind).withColumn("content", F.when(F.col("class") != "table", T.clean_line_breaks(F.col("content"))).otherwise(F.col("content")))
