"""Label maps, silver sets and request lines."""

import json

from pyspark.sql import functions as F

from pressmill.functions import geometry as G
from pressmill.functions import text as T
from pressmill.operators import classify


def test_types_and_topics(spark):
    df = spark.createDataFrame([("a", "{'class': 4}"), ("b", "{'class': [15, 4]}"), ("c", "?")], "custom_id string, content string")
    rows = {r.custom_id: r for r in classify.text_types(df).collect()}
    assert (rows["a"].text_class, rows["a"].text_class2, rows["a"].class_code2) == ("review", "article", 0) and rows["c"].text_class is None
    r = classify.topics(df).where("custom_id = 'b'").first()
    assert r.conflict_war_peace == 1 and r.education == 1 and r.sport == 0


def test_silver_set_keeps_issues_together(spark):
    labels = spark.createDataFrame([(f"u{i}", i % 3) for i in range(60)], "custom_id string, k int")
    content = spark.createDataFrame([(f"u{i}", f"text {i}", f"issue{i % 12}", "text", 40) for i in range(60)], "bbox_uid string, content string, issue_id string, class string, completion_tokens int")
    rows = classify.silver_set(labels, content, "k").join(content.select("bbox_uid", "issue_id"), "bbox_uid").collect()
    sides = {}
    for r in rows:
        sides.setdefault(r.issue_id, set()).add(r.is_train)
    assert len(rows) == 60 and all(len(s) == 1 for s in sides.values())
    assert classify.sampled_rows(content, 7).count() == 7
    line = json.loads(classify.request_lines(content, "Say the class.").first().value)
    assert line["custom_id"] == "u0" and line["body"]["messages"][0]["content"] == "Say the class.\n\ntext 0"


def test_names_and_small_parts(spark):
    df = spark.createDataFrame([("NCSE_deskew_True_max_ratio_1.5.csv", "x_page_1_box_page_id_B0C1R0.txt", 0.5)], "f string, n string, class_0_probability double")
    assert "sport_probability" in classify.rename_classes(df, ["sport"]).columns
    r = df.select(*[c.alias(n) for n, c in classify.experiment(F.col("f")).items()], classify.experiment_page(F.lit("BLN600"), F.col("n")).alias("p")).first()
    assert tuple(r) == ("NCSE", "True", 1.5, "x")
    assert spark.range(1).select(T.first_tokens(F.lit(" a b  c d"), 3)).first()[0] == "a b c"
    box = G.crop_window(*[F.lit(float(v)) for v in (-3, 2, 50, 9)], F.lit(40), F.lit(40))
    assert tuple(spark.range(1).select(box.alias("b")).first().b) == (0, 2, 40, 9)
    assert spark.range(1).select(G.crop_window(*[F.lit(5.0)] * 4, F.lit(9), F.lit(9)).alias("b")).first().b is None
