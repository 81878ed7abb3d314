"""Readings of crops, requests that are made again, runs taken up again, progress and searches as a user types."""

import json

import pytest
from pyspark.sql import functions as F

from pressmill.functions import geometry as G
from pressmill.operators import align, boxes, quality, readings
from pressmill.sources import io, models
from pressmill.sources.session import ship
from pressmill.streaming import incremental, workflow


def test_word_boxes_and_texts(spark):
    ship(spark)
    images = spark.createDataFrame([("a", b"1"), ("b", b""), ("c", b"3")], "file_name string, image binary")
    got = {r.file_name: r for r in readings.texts_of_images(images, models.FakeWords, spark.createDataFrame([("c",)], "file_name string")).collect()}
    assert set(got) == {"a", "b"} and (got["b"].text, got["b"].error) == ("", "ValueError: no image")
    assert got["a"].error is None and [len(line.split(" ")) for line in got["a"].text.split("\n")] == [3, 3]
    assert readings.texts_of_images(images.limit(0), models.FakeWords).count() == 0


def test_requests_again(spark):
    # made in here, so that they travel to the workers whole
    class Mumbling:
        """Talks about the picture until it gets enough tokens; breaks down above 400."""

        def transcribe(self, image, region_class, prompt, max_tokens):
            if max_tokens > 400:
                raise RuntimeError("too long")
            enough = max_tokens >= 200 and image != b"never"
            return {"content": "real text" if enough else f"the image {max_tokens}", "finish_reason": "stop", "prompt_tokens": 1, "completion_tokens": 2}

    def talks(region_class, answer):
        return "talk" if "the image" in answer["content"] else None

    ship(spark)
    rows = [("k1", b"x", "text", "p", 100, 2), ("k2", b"x", "text", "p", 300, 1), ("k3", b"never", "text", "p", 100, 3)]
    requests = spark.createDataFrame(rows, "request_key string, image binary, region_class string, prompt string, max_tokens int, seq int")
    ask = lambda **k: {r.request_key: r.content for r in models.ask(requests, Mumbling, order=["seq"], **k).collect()}
    assert ask() == {"k1": "the image 100", "k2": "real text", "k3": "the image 100"}
    assert ask(problem=talks) == {"k1": "real text", "k2": "real text", "k3": "the image 400"}
    assert ask(problem=talks, again=5)["k3"] == "the image 400"  # the request that broke down left the answer before it


def test_best_reading(spark):
    tries = [("a", 1, 0.5), ("a", 2, 0.85), ("a", 3, 0.99), ("b", 1, 0.3), ("b", 2, 0.7), ("b", 3, 0.7), ("c", 1, None), ("c", 2, 0.0), ("d", 1, None)]
    df = spark.createDataFrame(tries, "id string, place int, score double")
    assert sorted(tuple(r)[:2] for r in readings.best_reading(df, ["id"]).collect()) == [("a", 2), ("b", 2), ("c", 2), ("d", 1)]
    assert len(readings.READINGS) == 17 and readings.READINGS[0] == (3, 0.75)


def test_row_measures(spark):
    word = "array<struct<text string, x1 int, y1 int, x2 int, y2 int>>"
    row = [("aaaa", 0, 10, 40, 30), ("bbbb", 50, 12, 90, 30), ("cccc", 110, 10, 150, 32)]
    df = spark.createDataFrame([(1, row), (2, row[:1]), (3, []), (4, None)], f"k int, w {word}")
    got = {r.k: r.m for r in df.select("k", G.row_measures(F.col("w")).alias("m")).collect()}
    assert tuple(got[1]) == (10, 31, 20.0, 10.0, 15.0, 6.75, 37.5)
    assert got[2].gap == 7.0 and got[3] is None and got[4] is None
    many = [("aa", 100 * k, 0, 100 * k + 20, 10 + k) for k in range(12)]
    near = spark.createDataFrame([(1, many)], f"k int, w {word}").select(G.row_measures(F.col("w"), F.lit(0.0)).alias("m")).first().m
    assert near.height == 13.5 and near.gap == 80.0


def test_page_map(spark):
    size = F.array(F.lit(7), F.lit(9))
    made = G.page_map_json(F.array(*[F.lit(float(v)) for v in range(6)]), size, size, F.lit(1.5), F.array(*[F.lit(v) for v in (1, 2, 3, 4)]))
    r = spark.range(1).select(made.alias("j"), G.page_map_of_json(made).alias("m"), G.page_map_of_json(F.lit('{"matrix": [[1, 0, 2], [0, 1, 3]], "original_size": [5, 6], "processed_size": [5, 6]}')).alias("d"), G.page_map_of_json(F.lit("broken")).alias("n")).first()
    assert json.loads(r.j)["matrix"] == [[0, 1, 2], [3, 4, 5]] and tuple(r.m) == ([0.0, 1.0, 2.0, 3.0, 4.0, 5.0], [7, 9], [7, 9], 1.5, [1, 2, 3, 4])
    assert (r.d.matrix, r.d.angle, r.d.content_box, r.n) == ([1.0, 0.0, 2.0, 0.0, 1.0, 3.0], 0.0, [0, 0, 5, 6], None)


def test_single_response_and_report(spark):
    body = {"usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 3}, "choices": [{"finish_reason": "stop", "message": {"content": "text"}}]}
    r = io.single_response(spark.createDataFrame([(json.dumps(body),)], "body string"), "i", "c").first()
    assert tuple(r) == ("i", "c", 1, 2, 3, "stop", "text")
    cells = "page_id int, n_chandra_tokens int, n_matched int, n_estimated int, n_tesseract_words int, suspect string, recovered boolean, lines array<string>, cached boolean"
    page = quality.page_report(spark.createDataFrame([(1, 4, 2, 1, 3, None, False, ["a", "b"], True), (1, 4, 2, 1, 3, "x", True, None, None)], cells)).first()
    assert (page.regions, page.lines, page.cached, page.suspects) == (2, 2, 1, 1)


def test_column_regions(spark):
    raw = [(1, k, c, 0.9, float(x), float(y), float(x + 400), float(y + 200), 900, 900) for k, (c, x, y) in enumerate([("plain text", -5, 0), ("plain text", 480, 0), ("plain text", 0, 300), ("abandon", 0, 600)])]
    df = spark.createDataFrame(raw, "page_id int, key int, class string, confidence double, x1 double, y1 double, x2 double, y2 double, page_width int, page_height int")
    rows = boxes.column_regions(df, ["key"]).collect()
    assert rows and all(0 <= r.x1 < r.x2 <= 900 and 0 <= r.y1 < r.y2 <= 900 and r.recovered is False for r in rows)
    assert "abandon" not in {r["class"] for r in rows}


def test_own_normal_form():
    words = [{"text": t, "conf": 90.0, "line": 0, "x1": 70 * k, "y1": 0, "x2": 70 * k + 60, "y2": 20} for k, t in enumerate(("vv", "ww"))]
    assert align.align_region("xx yy", words)["n_matched"] == 0
    assert align.align_region("xx yy", words, normal=lambda t: {"vv": "xx", "ww": "yy"}.get(t, t))["n_matched"] == 2


def test_stages_are_taken_up_again(spark, tmp_path):
    told, broken = [], [True]

    def second(df):
        if broken[0]:
            raise RuntimeError("lost")
        return df.withColumn("b", F.col("id") + 1)

    stages = [("one", lambda df: df.where("id > 1")), ("two", second)]
    run = lambda: workflow.run_stages(spark, spark.range(5), stages, str(tmp_path), lambda name, state: told.append((name, state)))
    with pytest.raises(RuntimeError):
        run()
    broken[0] = False
    assert sorted(r.b for r in run().collect()) == [3, 4, 5] and run().count() == 3
    assert told == [("one", "started"), ("one", "done"), ("two", "started"), ("one", "kept"), ("two", "started"), ("two", "done"), ("one", "kept"), ("two", "kept")]


def test_progress_of_a_stream(spark, tmp_path):
    seen, src = [], str(tmp_path / "src")
    listener = workflow.Progress(seen.append)
    spark.streams.addListener(listener)
    try:
        spark.range(7).write.parquet(src)
        incremental.process_new_files(spark, src, "id long", lambda df: df, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert listener.rows == 7 and sum(b["rows"] for b in seen) == 7 and not listener.failed


def test_only_the_latest_search_counts(spark):
    inner = []

    def search(phrase):
        if phrase == "ha":
            inner.append(find("harbour"))  # the user types on while the first search runs
        return spark.createDataFrame([(phrase,)], "p string")

    find = workflow.LatestSearch(spark, search)
    assert find("ha") is None and [r.p for r in inner[0]] == ["harbour"]
    assert [r.p for r in find("fish")] == ["fish"] and not [t for t in spark.getTags() if t.startswith("search-")]
