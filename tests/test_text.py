"""Text functions on single values."""

import pytest
from pyspark.sql import functions as F

from pressmill.functions import text as T
from pressmill.functions import text_udf as U
from pressmill.operators import search


@pytest.mark.parametrize(("raw", "want"), [("Lamp,", "lamp"), ("ſtreet", "street"), ("ﬁne", "fine"), ("—", "—"), ("a_b", "ab")])
def test_token_form(raw, want):
    assert U.normalise_token(raw) == want


def test_normalise_joins_hyphenation_and_folds(spark):
    row = spark.createDataFrame([("Light-\n house  “x”", "a — b", "\u00a0 ſo\u2003ﬁne – - — ok\n", None)], "a string, b string, c string, d string")
    got = row.select(U.normalise_text("a"), U.normalise_dashes("b"), U.normalise_text("c"), U.normalise_dashes("c"), U.normalise_text("d")).first()
    assert tuple(got) == ('Lighthouse "x"', "a-b", "so fine - - - ok", "so fine---ok", None)


def test_html_table_and_blocks():
    html = '<div data-label="Text"><p>One<br>two</p></div><div data-label="Table"><table><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table></div>'
    text, labels, dropped = U.html_to_text(html)
    assert text == "One\ntwo\na\tb\nc\td"
    assert labels == ["Text", "Table"] and dropped == []


def test_html_plain_fence_alt_empty():
    assert U.html_to_text("plain")[0] == "plain"
    assert U.html_to_text("```html\n<p>x</p>\n```")[0] == "x"
    assert U.html_to_text('<img alt="a lamp">')[0] == "a lamp"
    assert U.html_to_text("") == ("", [], [])


def test_html_drops_labelled_blocks():
    text, labels, dropped = U.html_to_text('<p>Above</p><div data-label="Image"><img alt="A lamp"><p>glows</p></div><p>Below</p>', ("Image",))
    assert text == "Above\nBelow" and labels == ["Image"] and dropped == ["A lamp glows"]


def test_knitting():
    assert U.knit(["Ships leave", "leave the harbour", "harbour at dawn"]) == "Ships leave the harbour at dawn"
    assert U.knit_overlap("a late frost in the orchards", "frost in the orchards again") == "a late frost in the orchards again"
    assert U.knit_overlap("abc", "xyz") == "abc\nxyz"
    assert U.knit_overlap("", "xyz") == "xyz"


def test_distances():
    assert U.edit_distance("kitten", "sitting") == 3
    assert U.edit_distance("a b c".split(), "a c".split()) == 1
    assert U.edit_distance([], ["a"]) == 1
    assert U.indel_ratio("abcd", "abxd") == pytest.approx(0.75)
    assert U.partial_ratio("needle", "hay needle hay") == 1.0


def test_clean_and_titles(spark):
    df = spark.createDataFrame([("A-\nB\nc  d\n\n\ne ",)], "t string")
    assert df.select(T.clean_line_breaks(F.col("t"))).first()[0] == "AB c d\n\ne"
    titles = spark.createDataFrame([("LOCAL NOTES",), ("NTS FRM TWN",), ("Local notes",), ("ABCE",)], "t string")
    assert [r[0] for r in titles.select(T.is_title(F.col("t"))).collect()] == [True, False, False, False]


def test_fences_tsv(spark):
    df = spark.createDataFrame([("```a tsv b tsv```",)], "t string")
    assert df.select(T.strip_fences(F.col("t"))).first()[0] == "a  b tsv"


def test_layout_json(spark):
    raws = ['[{"label":"Text","bbox":[1,2]}]', "[1881] Harbour", "[]", None, '[{"label":"x"}]']
    df = spark.createDataFrame([(r,) for r in raws], "t string")
    assert [r[0] for r in df.select(T.is_layout_json(F.col("t"))).collect()] == [True, False, False, False, False]


def test_ids(spark):
    df = spark.createDataFrame([("1881/May 3 (p2).jp2",), ("a b/c.jp2",), ("...",)], "p string")
    assert [r[0] for r in df.select(T.page_id(F.col("p"))).collect()] == ["1881__May_3_p2", "a_b__c", "page"]
    assert [r[0] for r in df.select(T.image_identifier(F.col("p"))).collect()][1] == "a%20b%2Fc.jp2"
    tilde = spark.createDataFrame([("a/b/c.tif",)], "p string")
    assert tilde.select(T.image_identifier(F.col("p"), "~")).first()[0] == "a~b~c.tif"


def test_labels(spark):
    df = spark.createDataFrame([("{'class': 6}",), ("```json\n{'class': [15, 4]}\n```",), ("class 3",), ("none",)], "t string")
    assert [r[0] for r in df.select(T.parse_label(F.col("t"))).collect()] == [[6], [15, 4], [3], [99]]


def test_flesch_and_fold():
    assert U.flesch("") == 0.0
    assert U.flesch("The sun set. The fog rose.") > 100
    assert U.fold_search("Café—ſet") == "cafe-set"


def test_phrase_hits_join_hyphens_and_lines():
    words = [
        {"text": "the", "region": "B0", "x": 0, "y": 0, "w": 30, "h": 10}, {"text": "lan-", "region": "B0", "x": 40, "y": 0, "w": 40, "h": 10},
        {"text": "tern", "region": "B0", "x": 0, "y": 20, "w": 40, "h": 10}, {"text": "the", "region": "B1", "x": 0, "y": 40, "w": 30, "h": 10},
    ]
    hit = search.find_phrase(words, "Lantern")
    assert len(hit) == 1 and hit[0]["word"] == 1 and hit[0]["n_words"] == 2 and len(hit[0]["boxes"]) == 2
    assert len(search.find_phrase(words, "the", whole_word=True)) == 2
    assert search.find_phrase(words, "tern the") == []


def test_selectors(spark):
    df = spark.createDataFrame([("c#xywh=1,2,3,4", '<path d="M1,2 h3 v4 h-3 Z M5,6 h7 v8 h-7 Z"/>')], "t string, s string")
    r = df.select(search.parse_xywh(F.col("t")).alias("b"), search.parse_svg(F.col("s")).alias("p")).first()
    assert tuple(r.b) == ("c", 1, 2, 3, 4) and [tuple(x) for x in r.p] == [(1, 2, 3, 4), (5, 6, 7, 8)]


def test_text_functions_hold_few_objects_at_a_time():
    """Of an Arrow batch of 20 MB no more than a part is Python text at a time."""
    import tracemalloc

    import pyarrow as pa

    from pressmill.functions import text_udf

    values = pa.array([None, "", "ﬁn"] + ["ſé" * 2500] * 2700)
    tracemalloc.start()
    got = text_udf.nfkc.func(values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.slice(0, 4).to_pylist() == [None, "", "fin", "sé" * 2500] and len(got) == len(values) and peak < 6e6
    assert text_udf.nfkc.func(pa.array([], pa.string())).to_pylist() == []
