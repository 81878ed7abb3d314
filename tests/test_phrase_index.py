"""The positional index and the table function against the plain search of every page."""

import random

import pyarrow as pa
import pytest

from pressmill.operators import phrase_index, search

PAGES = "page_id long, words array<struct<text: string, region: string, x: double, y: double, w: double, h: double>>"


def made(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["the", "The", "and", "sand", "then", "a", "aa", "aaa", "été", "ETE", "ſo", "so", "lan-", "tern", "lan‑", "a-", "-", "—", "“the”", "the,", "Σας", "ana", "banana", "x_the", "the9"]
    out = []
    for page in range(n):
        words, line = [], 0
        for k in range(r.choice([0, 1, 5, 40, 80])):
            if k % 7 == 6:
                line += 1
            words.append((r.choice(vocabulary), f"B{k // r.choice([9, 20, 100])}" if page % 3 else "B0", float(k % 7 * 50), float(line * 30 + r.choice([0, 2])), 40.0, r.choice([18.0, 20.0])))
        out.append((page, words))
    # a hyphen at a line's end, and one at a region's end, which joins nothing
    out.append((n, [("see", "B0", 0.0, 0.0, 40.0, 20.0), ("lan-", "B0", 300.0, 0.0, 40.0, 20.0), ("tern", "B0", 0.0, 30.0, 40.0, 20.0), ("the", "B0", 50.0, 30.0, 40.0, 20.0), ("lan-", "B0", 300.0, 30.0, 40.0, 20.0), ("tern", "B1", 0.0, 60.0, 40.0, 20.0)]))
    return out


def plain(rows, query, match_case, whole_word):
    names = ("text", "region", "x", "y", "w", "h")
    return sorted((page, h["word"], h["n_words"], tuple(map(tuple, h["boxes"])), h["line_height"], h["snippet"]) for page, words in rows for h in search.find_phrase([dict(zip(names, w, strict=True)) for w in words], query, match_case, whole_word))


def told(hits):
    return sorted((r.page_id, r.word, r.n_words, tuple(map(tuple, r.boxes)), r.line_height, r.snippet) for r in hits.collect())


@pytest.mark.parametrize("query", ["the", "a", "aa", "and the", "the and", "a a", "a a a", "the the and", "lantern", "lantern the", "tern", "Été so", "σας", "-", "“the”", "x_the", "no such"])
def test_hits_are_those_of_the_plain_search(spark, query):
    rows = made(4)
    frame = spark.createDataFrame(rows, PAGES).repartition(3)
    for match_case, whole_word in ((False, False), (False, True), (True, False)):
        indexed = phrase_index.places(frame, match_case)
        assert told(phrase_index.hits(frame, indexed, query, match_case, whole_word)) == plain(rows, query, match_case, whole_word), (match_case, whole_word)


def test_kept_index_and_postings(spark):
    rows = made(5)
    frame = spark.createDataFrame(rows, PAGES)
    indexed = phrase_index.index(frame)
    assert told(phrase_index.hits(frame, indexed, "and the")) == plain(rows, "and the", False, False)
    lists = {(r.token, r.page_id): r.words for r in phrase_index.postings(indexed).collect()}
    assert all(w == sorted(set(w)) for w in lists.values()) and lists["lantern", 60] == [1] and lists["tern", 60] == [5]
    assert phrase_index.hits(frame, indexed, "").count() == 0 and phrase_index.places(frame.limit(0)).count() == 0


def test_table_function(spark):
    rows = made(6, 20)
    phrase_index.register(spark)
    words = spark.createDataFrame([(page, k, *w) for page, ws in rows for k, w in enumerate(ws)], "page_id long, at int, text string, region string, x double, y double, w double, h double")
    call = "SELECT * FROM find_phrase(TABLE({words}) PARTITION BY (page_id) ORDER BY (at), 'and the', false, true)"
    assert told(spark.sql(call, words=words.repartition(4))) == plain(rows, "and the", False, True)


def test_table_function_gets_words_as_arrow_batches(spark):
    rows = [(1, [(t, "B0", 10.0 * k, 0.0, 9.0, 9.0) for k, t in enumerate(["Sand", "and", "the", "été", "and", "THE"] * 5000)])]  # a page of several batches
    words = pa.RecordBatch.from_pylist([dict(zip(("page_id", "at", "text", "region", "x", "y", "w", "h"), (page, k, *w), strict=True)) for page, ws in rows for k, w in enumerate(ws)])
    call, found = [pa.array(["and the"]), pa.array([False]), pa.array([True])], phrase_index.PhraseHits()
    for at in range(0, len(words), 10_000):
        assert not list(found.eval(words.slice(at, 10_000), *call))
    told_rows = [h for t in found.terminate() for h in t.to_pylist()]
    got = [(h["page_id"], h["word"], h["n_words"], tuple(tuple(b.values()) for b in h["boxes"]), h["line_height"], h["snippet"]) for h in told_rows]
    assert got == plain(rows, "and the", False, True) and len(got) == 10_000 and not list(phrase_index.PhraseHits().terminate())


def test_places_are_the_same_however_many_words_are_handled_together(spark, monkeypatch):
    word = "struct<text string, region string, x double, y double, w double, h double>"
    rows = [(k, [(t, "r", float(10 * i), 0.0, 9.0, 9.0) for i, t in enumerate(["Ünder", "the-", "moon", ""][: k % 5])]) for k in range(40)]
    pages = spark.createDataFrame(rows, f"page_id long, words array<{word}>").coalesce(1)
    want = sorted(map(str, phrase_index.places(pages).collect()))
    monkeypatch.setattr(phrase_index, "WORDS", 3)
    assert sorted(map(str, phrase_index.places(pages).collect())) == want and len(want) == sum(len(w) for _, w in rows)
