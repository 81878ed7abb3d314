"""Phrase search on a positional index, as joins of shifted places.

A token is what stands between two blanks of a page's search text: a word, folded, with the words that a hyphen at a line's
end joins to it. places() has one row for each, with the word that it begins at and the word behind it; it may be kept as a
table (index()), sorted by token, and used for any number of phrases. A phrase of several words is a chain of tokens: the
first must end with the phrase's first word, those inside be equal, the last begin with the last one. The chain is grown from
its rarest part by joins on (page, place), so pages without it are never looked at, and only hits meet their page's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text_udf import fold_search
from ..sources.scratch import written
from .search import AFTER, BEFORE, HIT, found_words, told_hit

_DASHES = list("-‐‑¬–—")
_LETTER = r"[\p{L}\p{N}]"
WORDS = 1 << 15  # words of whole pages that a Python worker handles together
PLACES = "page_id long, word int, next int, token string, cuts array<int>, fresh boolean"


def _fold(texts: pa.Array, match_case: bool) -> pa.Array:
    """fold_search of an array, on distinct texts; those of ASCII alone need no Python."""
    texts = pc.fill_null(texts, "")
    plain = pc.string_is_ascii(texts)
    low = texts if match_case else pc.ascii_lower(texts)
    odd = pc.filter(texts, pc.invert(plain))
    if not len(odd):
        return low
    known = odd.dictionary_encode()
    folded = pa.array([fold_search(t, match_case) for t in known.dictionary.to_pylist()], pa.string()).take(known.indices)
    return pc.replace_with_mask(low, pc.invert(plain), folded)


def _pieces(page: np.ndarray, w: pa.StructArray, match_case: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Folded words, whether each is in one region with the word behind it, and whether it is joined to it (page: the number of each word's page)."""
    n = len(w)
    column = lambda name: w.field(name)
    number = lambda name: np.asarray(pc.fill_null(column(name).cast(pa.float64()), 0.0))
    texts = pc.fill_null(column("text"), "")
    region = np.asarray(pc.fill_null(column("region").cast(pa.string()).dictionary_encode().indices, -1))
    x, y, h = number("x"), number("y"), number("h")
    together = np.zeros(n, bool)  # with the word behind: same page and region
    together[:-1] = (page[1:] == page[:-1]) & (region[1:] == region[:-1])
    dash = np.asarray(pc.and_(pc.is_in(pc.utf8_slice_codeunits(texts, -1), pa.array(_DASHES)), pc.greater(pc.utf8_length(texts), 1)))
    joined = together & dash
    joined[:-1] &= (x[1:] < x[:-1]) & (y[1:] > y[:-1] + h[:-1] / 2)
    if joined.any():
        texts = pc.replace_with_mask(texts, pa.array(joined), pc.utf8_slice_codeunits(texts.filter(pa.array(joined)), 0, -1))
    return _fold(texts, match_case), together, joined


def _tokens(page: np.ndarray, place: np.ndarray, w: pa.StructArray, match_case: bool) -> pa.RecordBatch:
    """PLACES of the words w (page and place: the number of each word's page, and its number in it)."""
    n = len(w)
    pieces, together, joined = _pieces(page, w, match_case)
    first = np.flatnonzero(np.concatenate(([True], ~joined[:-1])))
    count = np.diff(np.append(first, n))
    tokens = pieces.take(pa.array(first))
    long = count > 1
    if long.any():
        whole = ["".join(pieces.slice(a, c).to_pylist()) for a, c in zip(first[long].tolist(), count[long].tolist(), strict=True)]
        tokens = pc.replace_with_mask(tokens, pa.array(long), pa.array(whole, pa.string()))
    cuts = pa.ListArray.from_arrays(pa.array(np.append(first, n).astype(np.int32)), pc.utf8_length(pieces).cast(pa.int32()))
    fresh = np.concatenate(([True], ~together[:-1]))[first]
    return pa.RecordBatch.from_arrays([pa.array(page[first]), pa.array(place[first].astype(np.int32)), pa.array((place[first] + count).astype(np.int32)), tokens, cuts, pa.array(fresh)], ["page_id", "word", "next", "token", "cuts", "fresh"])


def places(pages: DataFrame, match_case: bool = False) -> DataFrame:
    """PLACES of every token: page_id, the number of its first word and of the first one behind it, the folded token, the lengths of its words, whether it begins a region.

    pages: page_id and words (ARRAY of structs text, region, x, y, w, h, in order). The words of some pages of an Arrow batch
    are handled together, without an object for each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(1)), 0))
            if not batch.num_rows:
                continue
            sizes = np.asarray(pc.list_value_length(batch.column(1))).astype(np.int64)
            sums, at = np.cumsum(sizes), 0
            while at < len(sizes):  # whole pages of about WORDS words at a time
                stop = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + WORDS, "right")))
                size, part = sizes[at:stop], batch.slice(at, stop - at)
                words, page = part.column(1).flatten(), np.repeat(np.asarray(part.column(0)), size)
                yield _tokens(page, np.arange(len(page)) - np.repeat(np.cumsum(size) - size, size), words, match_case)
                at = stop

    return pages.where("page_id is not null and words is not null").select(F.col("page_id").cast("long").alias("page_id"), "words").mapInArrow(run, PLACES)


def index(pages: DataFrame, match_case: bool = False, ranges: bool = True) -> DataFrame:
    """places(), written once; in ranges of tokens, so that a search reads the row groups of its words, or as they come, for a few searches."""
    every = places(pages, match_case)
    return written(every.repartitionByRange("token", "page_id", "word").sortWithinPartitions("token", "page_id", "word") if ranges else every, "places")


def postings(indexed: DataFrame) -> DataFrame:
    """token, page_id, n, words: the ascending places of each token on each page."""
    return indexed.groupBy("token", "page_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("word")).alias("words"))


def _starts(token: Column, part: str) -> Column:
    """All places (from 0) in a token at which a part of it begins, overlapping ones too."""
    every = F.sequence(F.lit(0), F.length(token) - len(part))
    return F.when(F.length(token) >= len(part), F.filter(every, lambda k: F.substring(token, k + 1, F.lit(len(part))) == part)).otherwise(F.slice(F.array(F.lit(0)), 1, 0))


def chains(indexed: DataFrame, needle: str, whole_word: bool = False) -> DataFrame:
    """page_id, start and stop (structs of a token's first word and a place in it; stop is exclusive), first and last (tokens): all occurrences of a folded phrase, overlapping ones too."""
    parts = needle.split(" ")
    token = F.col("token")
    edge = lambda c: ~F.coalesce(c.rlike(_LETTER), F.lit(False))
    own = F.struct("word", "next", "token", "cuts", "fresh")
    if len(parts) == 1:
        found = indexed.where(token.contains(needle)).select("page_id", own.alias("first"), F.explode(_starts(token, needle)).alias("at"))
        if whole_word:
            text, before = F.col("first.token"), F.col("at") == 0
            found = found.where((before | edge(F.substring(text, F.col("at"), F.lit(1)))) & edge(F.substring(text, F.col("at") + len(needle) + 1, F.lit(1))))
        place = lambda at: F.struct(F.col("first.word").alias("word"), at.alias("at"))
        return found.select("page_id", place(F.col("at")).alias("start"), place(F.col("at") + len(needle)).alias("stop"), "first", F.col("first").alias("last"))
    tests = []
    for k, part in enumerate(parts):
        if k == 0:
            ok = token.endswith(part) & (edge(F.substring(token, F.length(token) - len(part), F.lit(1))) | (F.length(token) == len(part)) if whole_word and part else F.lit(True))
        elif k < len(parts) - 1:
            ok = (token == part) & ~F.col("fresh")
        else:
            ok = token.startswith(part) & ~F.col("fresh") & (edge(F.substring(token, F.lit(len(part) + 1), F.lit(1))) if whole_word and part else F.lit(True))
        tests.append(ok)
    counts = indexed.agg(*[F.count(F.when(t, 1)).alias(f"n{k}") for k, t in enumerate(tests)]).first()
    rarest = min(range(len(parts)), key=lambda k: counts[k])
    rows = lambda k: indexed.where(tests[k]).select("page_id", own.alias(f"t{k}"))
    grown = rows(rarest)
    for k in range(rarest + 1, len(parts)):
        grown = _next_to(grown, rows(k), f"t{k - 1}.next", f"t{k}.word")
    for k in range(rarest - 1, -1, -1):
        grown = _next_to(grown, rows(k), f"t{k + 1}.word", f"t{k}.next")
    first, last = F.col("t0"), F.col(f"t{len(parts) - 1}")
    start = F.struct(first["word"].alias("word"), (F.length(first["token"]) - len(parts[0])).alias("at"))
    return grown.select("page_id", start.alias("start"), F.struct(last["word"].alias("word"), F.lit(len(parts[-1])).alias("at")).alias("stop"), first.alias("first"), last.alias("last"))


def _next_to(grown: DataFrame, rows: DataFrame, mine: str, other: str) -> DataFrame:
    """Chains with one more token beside them."""
    return grown.withColumn("_place", F.col(mine)).join(rows.withColumn("_place", F.col(other)), ["page_id", "_place"]).drop("_place")


def hits(pages: DataFrame, indexed: DataFrame, query: str, match_case: bool = False, whole_word: bool = False) -> DataFrame:
    """The rows of search.phrase_hits, from the index. Of occurrences that overlap the first counts, page by page."""
    needle = fold_search(query, match_case)
    spark = pages.sparkSession
    if not needle:
        return spark.createDataFrame([], HIT)
    found = chains(indexed, needle, whole_word)
    word_of = lambda t, at: t["word"] + F.size(F.filter(F.transform(t["cuts"], lambda n, i: F.aggregate(F.slice(t["cuts"], 1, i + 1), F.lit(0), lambda s, x: s + x)), lambda end: end <= at))
    begins = lambda t, at: t["word"] + F.size(F.filter(F.transform(t["cuts"], lambda n, i: F.aggregate(F.slice(t["cuts"], 1, i), F.lit(0), lambda s, x: s + x)), lambda begin: begin < at)) - 1
    spans = found.select("page_id", F.struct("start", "stop", word_of(F.col("first"), F.col("start.at")).alias("first"), begins(F.col("last"), F.col("stop.at")).alias("last")).alias("hit"))
    listed = spans.groupBy("page_id").agg(F.array_sort(F.collect_list("hit")).alias("all"))

    def take(kept: Column, h: Column) -> Column:
        return F.when((F.size(kept) == 0) | (h["start"] >= F.element_at(kept, -1)["stop"]), F.concat(kept, F.array(h))).otherwise(kept)

    apart = written(listed.select("page_id", F.aggregate("all", F.slice("all", 1, 0), take).alias("all")), "hits")
    wanted = pages.join(apart.select("page_id"), "page_id", "left_semi")  # before anything is made of a page's words
    told = apart.join(wanted.select("page_id", "words"), "page_id").select("page_id", "words", F.explode("all").alias("hit"))
    own = F.slice("words", F.col("hit.first") + 1, F.col("hit.last") - F.col("hit.first") + 1)
    told = told.select("page_id", F.col("hit.first").alias("word"), own.alias("own"), F.slice("words", F.greatest(F.col("hit.first") - BEFORE, F.lit(0)) + 1, F.least(F.col("hit.first"), F.lit(BEFORE)) + AFTER).alias("around")).where("size(own) > 0")
    box = lambda x, y, w, h: F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))

    def line(done: Column, w: Column) -> Column:
        b = F.element_at(done, -1)
        level = (w["x"] >= b["x"]) & (F.least(b["y"] + b["h"], w["y"] + w["h"]) - F.greatest(b["y"], w["y"]) > 0.5 * F.least(b["h"], w["h"]))
        top = F.least(b["y"], w["y"])
        wider = box(b["x"], top, F.greatest(b["x"] + b["w"], w["x"] + w["w"]) - b["x"], F.greatest(b["y"] + b["h"], w["y"] + w["h"]) - top)
        alone = F.array(box(w["x"], w["y"], w["w"], w["h"]))
        return F.when(F.size(done) == 0, alone).when(level, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, alone))

    none = F.slice(F.transform("own", lambda w: box(w["x"], w["y"], w["w"], w["h"])), 1, 0)
    heights = F.array_sort(F.transform("own", lambda w: w["h"]))
    return told.select(
        "page_id", "word", F.size("own").alias("n_words"), F.aggregate("own", none, line).alias("boxes"), F.get(heights, F.floor(F.size(heights) / 2).cast("int")).alias("line_height"),
        F.array_join(F.transform("around", lambda w: w["text"]), " ").alias("snippet"),
    )


_GAPS = pa.array(["", " ", "\n"])
_BOX = pa.struct([(c, pa.float64()) for c in "xywh"])
HITS = pa.schema([("page_id", pa.int64()), ("word", pa.int32()), ("n_words", pa.int32()), ("boxes", pa.list_(_BOX)), ("line_height", pa.float64()), ("snippet", pa.string())])  # HIT in Arrow


class PhraseHits:
    """An Arrow table function over one row for each word (page_id, at, text, region, x, y, w, h): called with a table that is partitioned by page_id and ordered by at, it gives the page's hits.

    A page's words stay in Arrow; objects are made of the words of hits alone.
    """

    def __init__(self) -> None:
        self.words: list[pa.StructArray] = []
        self.page: int | None = None
        self.call: tuple = ("", False, False)

    def eval(self, words: pa.RecordBatch, query: pa.Array, match_case: pa.Array, whole_word: pa.Array) -> Iterator[pa.Table]:
        self.page, self.call = words.column("page_id")[0].as_py(), (query[0].as_py(), match_case[0].as_py(), whole_word[0].as_py())
        self.words.append(words.to_struct_array())
        return iter(())

    def terminate(self) -> Iterator[pa.Table]:
        if not self.words:
            return
        words, (query, match_case, whole_word) = pa.concat_arrays(self.words), self.call
        pieces, together, joined = _pieces(np.zeros(len(words), np.int8), words, match_case)
        gap = np.where(joined, 0, np.where(together, 1, 2))
        gap[-1] = 0
        length = np.asarray(pc.utf8_length(pieces)).astype(np.int64)
        ends = np.cumsum(length + (gap > 0)) - (gap > 0)
        parts = pc.binary_join_element_wise(pieces, _GAPS.take(pa.array(gap)), "")
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts), "")[0].as_py()
        hits = []
        for first, last in found_words(text, ends - length, ends, fold_search(query, match_case), whole_word):
            own, low = words.slice(first, last - first).to_pylist(), max(0, first - BEFORE)
            h = told_hit(first, own, words.field("text").slice(low, first + AFTER - low).to_pylist())
            hits.append(h | {"page_id": self.page, "boxes": [dict(zip("xywh", map(float, b), strict=True)) for b in h["boxes"]], "line_height": float(h["line_height"])})
        if hits:
            yield pa.Table.from_pylist(hits, HITS)


def register(spark: SparkSession, name: str = "find_phrase") -> None:
    """Make find_phrase(TABLE(words) PARTITION BY page_id ORDER BY at, query, match_case, whole_word) known to the session's SQL."""
    spark.udtf.register(name, F.arrow_udtf(PhraseHits, returnType=HIT))
