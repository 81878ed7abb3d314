"""Region quality as one CASE expression, page reports and token shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

EDGE_SHARE = 0.02
NARROW, STRIP, FRAGMENTS = 2.5, 6.0, 0.6
FIGURE_SUPPORT, SUPPORT = 0.2, 0.2
WORD_AREA = 3000.0


def at_page_edge(x: Column, w: Column, page_width: Column) -> Column:
    return (x <= EDGE_SHARE * page_width) | (x + w >= (1 - EDGE_SHARE) * page_width)


def assess_region(
    region_class: Column, text: Column, raw: Column, width: Column, height: Column, word_area: Column, n_tokens: Column, n_words: Column, alignment: Column,
    finish_reasons: Column, at_edge: Column, from_figure: Column,
) -> Column:
    """Why a region's text looks like no transcription, or null. Rules in order; figures and blank texts only get the first."""
    problem = T.transcription_problem(region_class, text, raw, finish_reasons)
    area = F.greatest(word_area, F.lit(1.0))
    size = F.sqrt(area)
    capacity = width * height / area
    cut_off = at_edge & ((width < NARROW * size) | ((width < STRIP * size) & (T.fragment_share(text) >= FRAGMENTS)))
    return (
        F.when(problem.isNotNull(), problem)
        .when((region_class == "figure") | (T.strip(text) == ""), F.lit(None).cast("string"))
        .when(from_figure & (alignment < FIGURE_SUPPORT), "figure text not confirmed by Tesseract")
        .when(cut_off, "cut-off text at the page edge")
        .when(n_tokens > F.greatest(F.lit(20.0), 3.0 * capacity), F.concat(n_tokens.cast("string"), F.lit(" tokens but the region holds about "), F.bround(capacity, 0).cast("long").cast("string"), F.lit(" words")))
        .when((n_words > 0) & (alignment < SUPPORT) & (n_tokens > 3 * n_words + 10), F.format_string("%d tokens against %d Tesseract words with alignment %.2f", n_tokens, n_words, alignment))
    )


def token_share(matched: Column, tokens: Column) -> Column:
    """Aggregate: matched over all tokens, 4 places, 0 without tokens."""
    return F.coalesce(F.round(F.sum(matched) / F.nullif(F.sum(tokens), F.lit(0)), 4), F.lit(0.0))


def median_word_area(w: Column, h: Column) -> Column:
    """Aggregate: the page's median word box, WORD_AREA without words."""
    return F.coalesce(F.median(w * h), F.lit(WORD_AREA))


def page_report(regions: DataFrame) -> DataFrame:
    """One row per page from finished regions: counts of regions, tokens, words, suspects and the two token shares.

    Of the columns `lines` (ARRAY) and `cached` (BOOLEAN) those that are there are counted too.
    """
    also = {"lines": F.coalesce(F.sum(F.greatest(F.size("lines"), F.lit(0))), F.lit(0)), "cached": F.count(F.when(F.col("cached"), 1))}
    return regions.groupBy("page_id").agg(
        F.count("*").alias("regions"), F.sum("n_chandra_tokens").alias("tokens"), F.sum("n_tesseract_words").alias("words"),
        F.count(F.when(F.col("suspect").isNotNull() & (F.col("suspect") != ""), 1)).alias("suspects"), F.count(F.when(F.col("recovered"), 1)).alias("recovered"),
        token_share(F.col("n_matched"), F.col("n_chandra_tokens")).alias("alignment_score"), token_share(F.col("n_matched") + F.col("n_estimated"), F.col("n_chandra_tokens")).alias("coverage"),
        *[c.alias(name) for name, c in also.items() if name in regions.columns],
    )


def published_text(regions: DataFrame) -> DataFrame:
    """Regions whose text is published: not a figure (by the OCR class if there is one), not suspect, not empty."""
    kind = F.coalesce("ocr_class", "class") if "ocr_class" in regions.columns else F.col("class")
    suspect = F.coalesce("suspect", F.lit("")) if "suspect" in regions.columns else F.lit("")
    return regions.where((kind != "figure") & (suspect == "") & (F.col("text") != ""))
