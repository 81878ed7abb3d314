"""Articles: texts split at breaks, titles found, consecutive titles merged, parts gathered under their title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def split_and_reclassify(df: DataFrame, key: list[str], text: str = "content", separator: str = "\n\n") -> DataFrame:
    """One row per non-empty part, numbered from 1 in sub_order; parts that look like titles get class 'title', others 'text'."""
    parts = df.select(*key, F.posexplode(F.split(text, separator)).alias("_at", "_part")).withColumn("content", T.strip(F.col("_part"))).where("content != ''")
    order = Window.partitionBy(*key).orderBy("_at")
    return parts.select(*key, F.row_number().over(order).alias("sub_order"), "content", F.when(T.is_title(F.col("content")), "title").otherwise("text").alias("class"))


def merge_titles(df: DataFrame, group: list[str], order: list[str], is_title: Column, text: str = "content") -> DataFrame:
    """Runs of consecutive titles in a group become one row of their texts, one a line; new_order numbers what is left."""
    w = Window.partitionBy(*group).orderBy(*order)
    df = df.withColumn("_title", is_title)
    fresh = F.when(F.col("_title") & F.coalesce(F.lag("_title").over(w), F.lit(False)), 0).otherwise(1)
    df = df.withColumn("_run", fresh)
    df = df.withColumn("_run", F.sum("_run").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = F.array_sort(F.collect_list(F.struct(*order, text)))
    merged = df.groupBy(*group, "_run").agg(F.array_join(F.transform(rows, lambda s: s[text]), "\n").alias(text), F.max("_title").alias("is_title"), F.count("*").alias("merged"))
    return merged.withColumn("new_order", F.row_number().over(Window.partitionBy(*group).orderBy("_run"))).drop("_run")


def merge_titles_compat(df: DataFrame, group: list[str], order: list[str], is_title: Column, text: str = "content") -> DataFrame:
    """The shifted rule, for results as before: a row is masked when it and the next one are titles, groups are numbered by the
    running count of rows without a mask, and a row stays unless the next one is masked. Rows that stay carry their whole
    group's texts, so a row before a run of titles is swallowed."""
    w = Window.partitionBy(*group).orderBy(*order)
    df = df.withColumn("_title", is_title)
    df = df.withColumn("_mask", F.col("_title") & F.coalesce(F.lead("_title").over(w), F.lit(False)))
    df = df.withColumn("_run", F.sum(F.when(F.col("_mask"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = df.withColumn("_keep", ~F.coalesce(F.lead("_mask").over(w), F.lit(False)))
    rows = F.array_sort(F.collect_list(F.struct(*order, text)))
    joined = df.groupBy(*group, "_run").agg(F.array_join(F.transform(rows, lambda s: s[text]), "\n").alias("_all"))
    kept = df.join(joined, [*group, "_run"]).where("_keep")
    return kept.withColumn(text, F.col("_all")).withColumn("new_order", F.row_number().over(w)).select(*group, *order, text, F.col("_title").alias("is_title"), "new_order")


def create_articles(df: DataFrame, group: list[str], order: list[str], is_title: Column, text: str = "content", separator: str = "\n\n", compat: bool = False) -> DataFrame:
    """One row per article: a title starts one, and so does a group's first row. title, content (title and parts joined), n_parts, first attributes.

    compat: a title that stands alone at the very beginning of a group's rows is not recorded (content '', title null).
    """
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_title", is_title).withColumn("article", F.sum(F.when(F.col("_title"), 1).otherwise(0)).over(w))
    df = df.withColumn("_first", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col("_title").alias("t"), F.col(text).alias("c"))))
    out = df.groupBy(*group, "article").agg(
        F.array_join(F.transform(rows, lambda s: s["c"]), separator).alias("content"),
        F.max(F.when(F.col("_title"), F.col(text))).alias("title"), F.count(F.when(~F.col("_title"), 1)).alias("n_parts"), F.count("*").alias("n_rows"), F.min("_first").alias("_first"),
    )
    if compat:
        lone = (F.col("_first") == 1) & (F.col("n_rows") == 1) & F.col("title").isNotNull()
        out = out.withColumns({"content": F.when(lone, "").otherwise(F.col("content")), "title": F.when(~lone, F.col("title"))})
    return out.drop("_first")


def page_number(page_id: Column) -> Column:
    """For numeric page order: the digits after the last '_page_'."""
    return F.coalesce(F.regexp_extract(page_id, r"_page_(\d+)$", 1).try_cast("int"), F.lit(0))


def process_documents(content: DataFrame, compat: bool = False) -> DataFrame:
    """Content rows (issue_id, page_id, box_page_id, reading_order, content) to articles: split, merge titles, gather by issue."""
    parts = split_and_reclassify(content, ["issue_id", "page_id", "box_page_id", "reading_order"])
    merge = merge_titles_compat if compat else merge_titles
    merged = merge(parts, ["issue_id", "page_id", "box_page_id", "reading_order"], ["sub_order"], F.col("class") == "title")
    merged = merged.withColumn("page_order", F.col("page_id") if compat else page_number(F.col("page_id")))
    return create_articles(merged, ["issue_id"], ["page_order", "reading_order", "new_order"], F.col("is_title"), compat=compat)
