"""Phrase search over page words: search texts, hits with boxes, snippets, totals, selectors."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text_udf import fold_search

BEFORE, AFTER = 6, 8
_WORD = re.compile(r"[^\W_]", re.UNICODE)


def continues(word: dict, after: dict | None) -> bool:
    """A hyphen at a line's end whose word goes on in the next line of the region."""
    return bool(after) and after["region"] == word["region"] and len(word["text"]) > 1 and word["text"][-1] in "-‐‑¬–—" and after["x"] < word["x"] and after["y"] > word["y"] + word["h"] / 2


def search_text(words: Sequence[dict], match_case: bool = False) -> tuple[str, np.ndarray, np.ndarray]:
    """A page's text with each word's start and end in it: hyphenation joined, regions on lines of their own."""
    parts, starts, ends, at = [], [], [], 0
    for word, after in zip(words, [*words[1:], None][: len(words)], strict=True):  # none on an empty page
        joined = continues(word, after)
        piece = fold_search(word["text"][:-1] if joined else word["text"], match_case)
        gap = "" if after is None or joined else "\n" if after["region"] != word["region"] else " "
        starts.append(at)
        ends.append(at + len(piece))
        parts += [piece, gap]
        at += len(piece) + len(gap)
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def line_boxes(boxes: Sequence[tuple[float, float, float, float]]) -> list[tuple[float, float, float, float]]:
    """Boxes (x, y, w, h) of one hit, those of a line as one."""
    out: list[tuple[float, float, float, float]] = []
    for x, y, w, h in boxes:
        if out:
            a, b, c, d = out[-1]
            if x >= a and min(b + d, y + h) - max(b, y) > 0.5 * min(d, h):
                top = min(b, y)
                out[-1] = (a, top, max(a + c, x + w) - a, max(b + d, y + h) - top)
                continue
        out.append((x, y, w, h))
    return out


def found_words(text: str, starts: np.ndarray, ends: np.ndarray, needle: str, whole_word: bool = False) -> Iterator[tuple[int, int]]:
    """First word and the one behind the last of each hit of a folded phrase in a search text. Hits don't overlap."""
    at = text.find(needle) if needle else -1
    while at >= 0:
        stop = at + len(needle)
        if whole_word and (_WORD.match(text[at - 1 : at] or " ") or _WORD.match(text[stop : stop + 1] or " ")):
            at = text.find(needle, at + 1)
            continue
        first, last = int(np.searchsorted(ends, at, "right")), int(np.searchsorted(starts, stop - 1, "right"))
        if first < last:
            yield first, last
        at = text.find(needle, stop)


def told_hit(first: int, found: Sequence[dict], around: Sequence[str]) -> dict:
    """A hit from its words and the texts of those around it."""
    heights = sorted(w["h"] for w in found)
    return {"word": first, "n_words": len(found), "boxes": line_boxes([(w["x"], w["y"], w["w"], w["h"]) for w in found]), "line_height": heights[len(heights) // 2], "snippet": " ".join(around)}


def find_phrase(words: Sequence[dict], query: str, match_case: bool = False, whole_word: bool = False) -> list[dict]:
    """Hits of a phrase: first word, number of words, boxes by line, line height, snippet. Hits don't overlap."""
    found = found_words(*search_text(words, match_case), fold_search(query, match_case), whole_word)
    return [told_hit(first, words[first:last], [w["text"] for w in words[max(0, first - BEFORE) : first + AFTER]]) for first, last in found]


HIT = "page_id long, word int, n_words int, boxes array<struct<x double, y double, w double, h double>>, line_height double, snippet string"


def phrase_hits(pages: DataFrame, query: str, match_case: bool = False, whole_word: bool = False) -> DataFrame:
    """One row per hit; pages: page_id and words (ARRAY of structs text, region, x, y, w, h, in order)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            rows = []
            for page, words in zip(part["page_id"], part["words"], strict=True):
                for h in find_phrase([w if isinstance(w, dict) else w.asDict() for w in words], query, match_case, whole_word):
                    rows.append((page, h["word"], h["n_words"], [dict(zip("xywh", map(float, b), strict=True)) for b in h["boxes"]], float(h["line_height"]), h["snippet"]))
            yield pd.DataFrame(rows, columns=["page_id", "word", "n_words", "boxes", "line_height", "snippet"])

    return pages.select("page_id", "words").mapInPandas(run, HIT)


def page_totals(hits: DataFrame) -> DataFrame:
    """Matches of each page with the first one's place and snippet."""
    return hits.groupBy("page_id").agg(F.count("*").alias("matches"), F.min("word").alias("first_word"), F.min_by("snippet", "word").alias("first_snippet"))


def snippet(words: Column, at: Column) -> Column:
    """Words around place `at` (from 0): six before, eight from the hit on."""
    first = F.greatest(at - BEFORE, F.lit(0))
    return F.array_join(F.slice(words, first + 1, at + AFTER - first), " ")


def parse_xywh(target: Column) -> Column:
    """STRUCT<canvas, x, y, w, h> of a media fragment, null if there is none."""
    pattern = r"^([^#]*)#xywh=(?:pixel:)?(\d+),(\d+),(\d+),(\d+)"
    part = lambda k: F.regexp_extract(target, pattern, k)
    return F.when(target.rlike(pattern), F.struct(part(1).alias("canvas"), *[part(k + 2).cast("int").alias(n) for k, n in enumerate("xywh")]))


def parse_svg(svg: Column) -> Column:
    """ARRAY<STRUCT<x, y, w, h>> of the rectangles in an SVG path."""
    pattern = r"M(-?[\d.]+),(-?[\d.]+) h(-?[\d.]+) v(-?[\d.]+)"
    return F.transform(F.regexp_extract_all(svg, F.lit(pattern), 0), lambda m: F.struct(*[F.regexp_extract(m, pattern, k + 1).cast("double").alias(n) for k, n in enumerate("xywh")]))


def smallest_box_at(hits: DataFrame, boxes: DataFrame) -> DataFrame:
    """The smallest box (page_id, id, x, y, w, h) that holds each hit's centre (page_id, hit, cx, cy)."""
    inside = (hits.page_id == boxes.page_id) & hits.cx.between(boxes.x, boxes.x + boxes.w) & hits.cy.between(boxes.y, boxes.y + boxes.h)
    return hits.join(boxes, inside).groupBy(hits.page_id, "hit").agg(F.min_by("id", F.struct(F.expr("w * h"), "id")).alias("id"))


def page_words(words: DataFrame) -> DataFrame:
    """page_id and its words in reading order, from one row per word (page_id, at, text, region, x, y, w, h)."""
    return words.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text", "region", "x", "y", "w", "h"))), lambda s: F.struct(*[s[k].alias(k) for k in ("text", "region", "x", "y", "w", "h")])).alias("words"))


def running_offsets(words: DataFrame) -> DataFrame:
    """start and stop of each word in its page's space-joined text."""
    order = Window.partitionBy("page_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.length("text") + 1).over(order) - 1
    return words.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("text"))
