"""The end of a run: results put to their regions, boxes on the scan, what is withheld, totals; small filters on the way."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import box_to_original

# What a word of a page must reach to stand for it.
WORD_CONFIDENCE, WORD_LETTERS = 90, 5


def other_class(c: Column, kept: tuple[str, ...]) -> Column:
    """Classes that an analysis doesn't keep are 'other'; null stays null."""
    return F.when(c.isin(*kept) | c.isNull(), c).otherwise(F.lit("other"))


def columns_like(df: DataFrame, pattern: str, without: str | None = None) -> DataFrame:
    """The columns whose name holds a match of the pattern, less those that end in `without`."""
    names = [c for c in df.columns if re.search(pattern, c) and not (without and c.endswith(without))]
    return df.select(*[F.col(f"`{c}`") for c in names])


def with_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a null (or NaN) in the columns."""
    return df.dropna(subset=columns)


def word_candidate(text: Column, confidence: Column) -> Column:
    """A word that is surely read: high confidence, long enough, letters only."""
    return F.coalesce((confidence > WORD_CONFIDENCE) & (F.length(text) >= WORD_LETTERS) & text.rlike(r"^\p{L}+$"), F.lit(False))


def first_pages(df: DataFrame, n: int, order: str = "seq") -> DataFrame:
    """A run over n pages only, for a trial (the limit is the feature)."""
    return df.orderBy(order).limit(n)


def with_results(regions: DataFrame, results: DataFrame) -> DataFrame:
    """Regions with the answers that belong to them, by page and region id instead of by place; regions without an answer stay."""
    return regions.join(results, ["page_id", "box_page_id"], "left")


def finalise(regions: DataFrame) -> DataFrame:
    """Regions as they are published: `box` on the scan, and no text where it is suspect.

    regions: page_id, box_page_id, x1, y1, x2, y2, inverse (ARRAY of six: page to scan), scan_width, scan_height, text, suspect.
    The text that is withheld stays in `withheld`.
    """
    box = box_to_original(F.col("inverse"), *[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")], F.col("scan_width"), F.col("scan_height"))
    good = F.coalesce("suspect", F.lit("")) == ""
    return regions.withColumns({"box": box, "withheld": F.when(~good, F.col("text")), "text": F.when(good, F.col("text"))}).drop("inverse")


def run_summary(regions: DataFrame) -> DataFrame:
    """One row for a run: pages, regions, withheld regions, tokens, answers from the cache. regions: page_id, suspect, total_tokens, cached."""
    return regions.agg(
        F.countDistinct("page_id").alias("pages"), F.count("*").alias("regions"), F.count(F.when(F.coalesce("suspect", F.lit("")) != "", 1)).alias("withheld"),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("tokens"), F.count(F.when(F.col("cached"), 1)).alias("cached"),
    )
