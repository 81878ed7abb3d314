"""Readers, writers, models behind interfaces, incremental runs and IIIF documents."""

import json

from pyspark.sql import functions as F

from pressmill.operators import corpus, iiif, search
from pressmill.sources import io, models
from pressmill.streaming import incremental


def test_discovery(spark, tmp_path):
    for name in ("x/a.tif", "x/a.jp2", "b.png", ".hidden.png", "notes.txt"):
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_bytes(b"-")
    rows = io.discover_scans(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.relpath for r in rows] == ["b.png", "x/a.jp2", "x/a.tif"]
    assert [r.page_id for r in rows] == ["b", "x__a", "x__a_ext1"]


def test_responses(spark, tmp_path):
    one = {"id": "1", "custom_id": "c", "response": {"body": {"usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 3}, "choices": [{"finish_reason": "stop", "message": {"content": "text"}}]}}}
    (tmp_path / "a.jsonl").write_text(json.dumps(one) + "\n{broken\n" + json.dumps(one | {"id": "2"}) + "\n")
    (tmp_path / "b.json").write_text(json.dumps([one, one | {"id": "3"}]))
    assert sorted(r.id for r in io.read_responses(spark, str(tmp_path / "a.jsonl")).collect()) == ["1", "2"]
    rows = io.read_response_array(spark, str(tmp_path / "b.json")).orderBy("id").collect()
    assert [(r.id, r.total_tokens, r.finish_reason, r.content) for r in rows] == [("1", 3, "stop", "text"), ("3", 3, "stop", "text")]


def test_label_export(spark, tmp_path):
    row = {"data_row": {"external_id": "p_1.png"}, "media_attributes": {"height": 9, "width": 8}, "projects": {"key77": {"labels": [{"annotations": {"objects": [{"name": "text", "bounding_box": {"left": 1, "top": 2, "width": 3, "height": 4}}]}}]}}}
    (tmp_path / "e.ndjson").write_text(json.dumps(row) + "\n")
    r = io.read_label_export(spark, str(tmp_path / "e.ndjson")).first()
    assert (r.page_id, r["class"], r.x1, r.y1, r.x2, r.y2, r.page_height) == ("p_1", "text", 1, 2, 4, 6, 9)


def test_text_folder_csv_and_exports(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/one.txt").write_text("a\nb")
    assert [tuple(r) for r in io.read_texts(spark, str(tmp_path / "t")).collect()] == [("one", "a\nb")]
    df = spark.createDataFrame([(1, "x,y"), (2, None)], "k int, v string")
    io.write_csv(df, str(tmp_path / "csv"))
    assert sorted(r.k for r in io.read_csv(spark, str(tmp_path / "csv"), "k int, v string").collect()) == [1, 2]
    box = "struct<x int, y int, w int, h int>"
    regions = spark.createDataFrame([("p1", "B0C0R1", "title", 1, "HEAD", "", (0, 0, 9, 9), [("HEAD", (0, 0, 9, 9))], [("HEAD", (0, 0, 9, 9))]), ("p1", "B0C0R2", "text", 2, "body", "bad", (0, 0, 9, 9), [], [])], f"page_id string, box_page_id string, class string, reading_order int, text string, suspect string, box {box}, lines array<struct<text string, box {box}>>, words array<struct<text string, box {box}>>")
    io.write_exports(regions, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/words")).count() == 1 and spark.read.parquet(str(tmp_path / "out/regions")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out/texts")).first()["value"] == "[1 B0C0R1 title]\nHEAD"


def test_models_answer_once(spark):
    from pressmill.sources.session import ship

    ship(spark)
    requests = spark.createDataFrame([(f"k{i}", bytes([i]), "text", "Transcribe.", 99) for i in range(5)] + [("k1", bytes([1]), "text", "Transcribe.", 99)], "request_key string, image binary, region_class string, prompt string, max_tokens int")
    first = models.ask(requests.where("request_key < 'k3'"), models.FakeOcr)
    again = models.ask(requests, models.FakeOcr, spark.createDataFrame(first.collect(), first.schema))
    assert first.count() == 3 and again.count() == 5
    boxes = models.detect(spark.createDataFrame([("p1", b"")], "page_id string, image binary"), models.FakeLayout)
    assert boxes.count() == 4 and boxes.columns[0] == "page_id"
    scored = corpus.score_texts(spark.createDataFrame([(1, "a"), (2, None)], "k int, t string"), "k", "t", lambda: models.FakeClassifier(3).logits, 3)
    assert {c for c in scored.columns} == {"k", "class_0_probability", "class_1_probability", "class_2_probability", "predicted_class"}
    assert all(abs(sum(r[1:4]) - 1) < 1e-9 for r in scored.collect())


def test_new_files_only(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    step = lambda df: df.withColumn("w", F.length("t"))
    spark.createDataFrame([("ab",)], "t string").write.mode("append").parquet(src)
    for expected in (1, 1):
        incremental.process_new_files(spark, src, "t string", step, out, check).awaitTermination(120)
        assert spark.read.parquet(out).count() == expected
    spark.createDataFrame([("c",)], "t string").write.mode("append").parquet(src)
    incremental.process_new_files(spark, src, "t string", step, out, check).awaitTermination(120)
    assert sorted(r.w for r in spark.read.parquet(out).collect()) == [1, 2]
    work = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "page_id string")
    status = incremental.mark(spark.createDataFrame([("p1", None), ("p2", "failed"), ("p2", None)], "page_id string, error string"), "page_id")
    assert sorted(r.page_id for r in incremental.pending(work, status, "page_id").collect()) == ["p2", "p3"]


def test_iiif_documents_parse(spark, tmp_path):
    box = "struct<x int, y int, w int, h int>"
    rows = [("p 1", "a/b.tif", 100, 200, f"B0C0R{k}", "text", k, f'say "{k}"', None if k < 3 else "x", (1, 2, 3, 4), [("l", (1, 2, 3, 4))], [("w", (1, 2, 3, 4), "estimated"), ("v", (1, 2, 3, 4), "exact")]) for k in (2, 1, 3)]
    df = spark.createDataFrame(rows, f"page_id string, source_relpath string, page_width int, page_height int, box_page_id string, class string, reading_order int, text string, suspect string, box {box}, lines array<struct<text string, box {box}>>, words array<struct<text string, box {box}, match string>>")
    docs = iiif.page_documents(df, "http://m/", "http://i")
    r = docs.first()
    blocks, words, manifest = (json.loads(r[k]) for k in ("blocks", "words", "manifest"))
    assert [b["body"][0]["value"] for b in blocks["items"]] == ['say "1"', 'say "2"'] and blocks["label"] == {"en": ["Blocks (2)"]}
    assert blocks["items"][0]["target"] == "http://m/p%201/canvas/p1#xywh=1,2,3,4" and isinstance(words["items"][1]["body"], dict)
    assert words["items"][0]["body"][1]["value"] == "estimated position" and manifest["items"][0]["width"] == 100
    assert manifest["items"][0]["items"][0]["items"][0]["body"]["id"] == "http://i/a%2Fb.tif/full/max/0/default.jpg"
    assert docs.select(iiif.structure_errors(F.col("manifest")).alias("e")).first().e == []
    made = spark.createDataFrame([(manifest["id"], json.dumps(manifest["label"]))], "id string, label string")
    assert json.loads(iiif.collection(made, "http://m").first()[0])["items"][0]["type"] == "Manifest"
    target = json.loads(df.select(iiif.parts_target(F.lit("c"), F.array("box", "box")).alias("t")).first().t)
    assert target["selector"][0]["value"] == "xywh=1,2,3,4"
    (tmp_path / "a").mkdir()
    (tmp_path / "a/words.json").write_text(r["words"])
    found = io.read_annotations(spark, str(tmp_path / "a/words.json")).withColumn("b", search.parse_xywh(F.col("target"))).orderBy("at").collect()
    assert [f.text for f in found] == ["w", "v"] * 2 and found[0].b.w == 3


def test_iiif_json_is_made_behind_the_grouping(spark):
    """So that what a page's regions are sorted and spilled with is not their JSON."""
    box = "struct<x int, y int, w int, h int>"
    df = spark.createDataFrame([], f"page_id string, source_relpath string, page_width int, page_height int, box_page_id string, class string, reading_order int, text string, suspect string, box {box}, lines array<struct<text string, box {box}>>, words array<struct<text string, box {box}, match string>>")
    plan = iiif.page_documents(df, "http://m/", "http://i")._jdf.queryExecution().analyzed().toString()
    assert "to_json" in plan and "to_json" not in plan[plan.index("Aggregate [") :]


def test_smallest_box(spark):
    hits = spark.createDataFrame([(1, 0, 5.0, 5.0)], "page_id int, hit int, cx double, cy double")
    boxes = spark.createDataFrame([(1, "page", 0.0, 0.0, 100.0, 100.0), (1, "word", 0.0, 0.0, 10.0, 10.0), (1, "far", 50.0, 50.0, 2.0, 2.0)], "page_id int, id string, x double, y double, w double, h double")
    assert search.smallest_box_at(hits, boxes).first().id == "word"


def test_documents_and_cleanup(spark, tmp_path):
    df = spark.createDataFrame([("p1", '{"a": 1}'), ("p2", '{"b": [2]}')], "page_id string, document string")
    io.write_documents(df, f"file://{tmp_path}/docs")
    back = {r.page_id: json.loads(r.value) for r in spark.read.text(f"file://{tmp_path}/docs").collect()}
    assert back == {"p1": {"a": 1}, "p2": {"b": [2]}}
    (tmp_path / "docs/page_id=p1/left.json.tmp").write_text("x")
    (tmp_path / "docs/_temporary/0").mkdir(parents=True)
    assert len(io.remove_partial(spark, f"file://{tmp_path}/docs")) == 2 and not (tmp_path / "docs/_temporary").exists()
    assert spark.read.text(f"file://{tmp_path}/docs").count() == 2 and io.remove_partial(spark, f"file://{tmp_path}/none") == []


def test_finish(spark):
    from pressmill.functions import geometry as G
    from pressmill.operators import finish

    regions = spark.createDataFrame([(1, "B0", 10, 20, 30, 40), (1, "B1", 0, 0, 5, 5)], "page_id long, box_page_id string, x1 int, y1 int, x2 int, y2 int")
    results = spark.createDataFrame([(1, "B1", "second", "cut off"), (1, "B0", "first", None)], "page_id long, box_page_id string, text string, suspect string")
    told = F.lit('{"matrix": [1.0, 0.0, 100.0, 0.0, 1.0, 200.0], "width": 9, "height": 8}')
    whole = finish.with_results(regions, results).withColumns({"inverse": G.map_of_json(told)["matrix"], "scan_width": F.lit(1000), "scan_height": F.lit(1000)})
    got = {r.box_page_id: r for r in finish.finalise(whole).collect()}
    assert tuple(got["B0"].box) == (110, 220, 20, 20) and (got["B0"].text, got["B0"].withheld) == ("first", None)
    assert (got["B1"].text, got["B1"].withheld) == (None, "second")
    r = spark.range(1).select(G.map_of_json(F.lit("broken")).alias("m"), G.map_json(F.array(F.lit(1.5)), F.lit(3), F.lit(4)).alias("j")).first()
    assert r.m.matrix == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0] and json.loads(r.j) == {"matrix": [1.5], "width": 3, "height": 4}
    df = spark.createDataFrame([("a", 1.0, 2.0), (None, None, 3.0)], "class string, class_1_probability double, class_1_probability_old double")
    assert finish.columns_like(df, "probability", "_old").columns == ["class_1_probability"] and finish.with_values(df, ["class_1_probability"]).count() == 1
    assert [r[0] for r in df.select(finish.other_class(F.col("class"), ("b",))).collect()] == ["other", None]
    assert [r.id for r in finish.first_pages(spark.range(9), 3, "id").collect()] == [0, 1, 2]
