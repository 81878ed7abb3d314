"""Every operator on odd and empty tables: no crash, and the result that its docstring states."""

from pressmill.llm import decontaminate, lang_cnn, line_crf, mixing, near_dedup, quality_mil, secret_scan, token_output, url_filter, warc

TOKENIZER = "public:word_bpe_49k.json"


def by_id(df, *columns):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return out


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, text string")


def test_decontaminate(spark, odd_documents, no_documents):
    text = odd_documents.where("doc_id = 1").first()["text"]
    bench = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "one two")], "item_id long, text string")
    got = by_id(decontaminate.leaks(odd_documents, bench), "item_id", "n_agree", "item_tokens")
    assert got == {1: [(1, 90, 90)], 5: [(1, 90, 90)] * 2}
    assert decontaminate.leaks(no_documents, bench).count() == 0 and decontaminate.leaks(odd_documents, bench.limit(0)).count() == 0
    kept = decontaminate.without_leaks(odd_documents, bench)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 3


def test_token_output(odd_documents, no_documents):
    rows = token_output.encode_documents(odd_documents, TOKENIZER).orderBy("start").collect()
    assert len(rows) == odd_documents.count() and rows[0]["doc_id"] is None
    assert [r["doc_id"] for r in rows[1:]] == sorted(r["doc_id"] for r in rows[1:])
    ends = [r["start"] + r["n_tokens"] for r in rows]
    assert [r["start"] for r in rows] == [0, *ends[:-1]] and {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 6)} == {1}
    assert token_output.encode_documents(no_documents, TOKENIZER).count() == 0


def test_secret_scan(odd_documents, no_documents):
    got = secret_scan.scan(odd_documents)
    assert got.count() == odd_documents.count() and got.where("n_assign + n_access + n_hex > 0 or spans != ''").count() == 0
    assert secret_scan.scan(no_documents).count() == 0


def test_near_dedup(odd_documents, no_documents):
    got = by_id(near_dedup.near_duplicates(odd_documents), "class_id", "class_size")
    assert got[1] == [(1, 3)] and got[5] == [(1, 3)] * 2 and got[2] == [(2, 1)] and got[3] == [(3, 1)] and got[None] == [(None, None)]
    assert sorted(got[9]) == [(9, 1), (9, 1)] and got[4] == [(4, 1)]
    assert near_dedup.near_duplicates(no_documents).count() == 0
    assert near_dedup.first_of_each(no_documents).columns == no_documents.columns
    assert sorted((r["doc_id"] or 0) for r in near_dedup.first_of_each(odd_documents).collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 9]


def test_mixing(odd_documents, no_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 6)} == {0}
    assert sum(r["taken"] for r in rows if r["source"] is None) > 0
    assert mixing.mix(no_documents).count() == 0 and mixing.apply_mix(no_documents).count() == 0
    assert mixing.apply_mix(odd_documents).columns == odd_documents.columns


def test_quality_rules(spark, odd_documents, no_documents):
    labels = labels_of(spark, [(1, 1, 0, "t"), (4, 0, 0, "t"), (None, 1, 0, "t"), (5, None, 0, "t")])
    chain = line_crf.train(odd_documents, labels)
    got = by_id(line_crf.judge(odd_documents, chain), "n_words", "base_failed", "kept")
    assert got[2] == got[3] == got[6] == [(0, True, False)] and len(got[5]) == 2
    assert line_crf.train(odd_documents, labels.limit(0)) is None
    assert by_id(line_crf.judge(odd_documents, None), "kept")[1] == [(True,)]
    assert line_crf.judge(no_documents, chain).count() == 0 and line_crf.keep_documents(odd_documents, chain).columns == odd_documents.columns


def test_quality_mil(spark, odd_documents, no_documents):
    model = quality_mil.train(odd_documents, labels_of(spark, [(1, 1, 0, "t"), (4, 0, 0, "t"), (3, 0, 0, "t"), (5, 1, 0, "t"), (9, 1, 0, "t"), (7, 0, 0, "t")]))
    rows = quality_mil.score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert quality_mil.train(odd_documents, labels_of(spark)) is None and quality_mil.score(odd_documents, None).where("score != 0.5").count() == 0
    assert quality_mil.score(no_documents, None).count() == 0


def test_language(odd_documents, no_documents):
    got = by_id(lang_cnn.predict(odd_documents, lang_cnn.train(odd_documents)), "lang_pred", "score")
    assert got[2] == got[3] == got[6] == [("und", 0.0)] and got[1][0][0] in {"en", "fr", "de"}
    assert lang_cnn.train(no_documents) is None and lang_cnn.predict(odd_documents, None).where("lang_pred != 'und'").count() == 0


def test_urls(spark):
    urls = ["http://Blog.Example.NET/en/1?x", "http://a.example.net/x", "https://net", "https://net/", "ftp://x.org/fr/1#a", None, "nothing", "://", "http://example.com/de/9", "http://notexample.com/de/", "http://a..net/q", "http://" + "a." * 3000 + "net/p"]
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(urls)] + [(0, urls[0], "h", "p", "r"), (None, urls[0], "h", "p", "r")], "page_id long, url string, host string, path string, rule string")
    rows = url_filter.judge(pages, url_filter.rules_frame(spark)).collect()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == len(urls) + 2
    want = ["example.net/en/", "net/", None, "net/", "org/fr/", None, None, None, "example.com/de/", None, "net/", "net/"]
    assert [got[i][0] for i in range(len(urls))] == want
    assert [got[i][1] for i in range(len(urls))] == ["block" if w in ("net/", "example.com/de/") else "allow" for w in want]
    assert url_filter.judge(pages.limit(0), url_filter.rules_frame(spark)).count() == 0
    assert url_filter.judge(pages, url_filter.rules_frame(spark).limit(0)).where("verdict != 'allow' or rule is not null").count() == 0


def test_warc(spark):
    rows = [(3, "http://a/\r\nX: y", "same", 1), (1, None, "same", 1), (2, "u", None, 1), (None, "u", "same", 1), (4, "u", "", 1), (5, "u", "long " * 200_000, 1), (1, None, "same", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, first int")
    got = {}
    for r in warc.archive(pages).collect():
        got.setdefault(r["page_id"], []).append((r["payload_bytes"], r["record_type"], r["refers_to"]))
    assert got == {3: [(4, "revisit", 1)], 1: [(4, "response", None)] * 2, 2: [(0, "response", None)], None: [(4, "revisit", 1)], 4: [(0, "revisit", 2)], 5: [(1_000_000, "response", None)]}
    assert warc.archive(pages.limit(0)).count() == 0
    assert warc.archive(pages, least_bytes=5).where("record_type = 'revisit'").count() == 0


def test_warc_batches_do_not_grow_with_the_file(spark, monkeypatch, tmp_path):
    """No batch that Python sends or gets for an archive is near the size of the file."""
    largest, frame = 11 << 20, type(spark.range(0))
    plain = frame.mapInArrow

    def bounded(self, func, schema, *args, **kwargs):
        def small(batches, what):
            for batch in batches:
                if batch.nbytes > largest and "html" not in what:
                    raise ValueError(f"{what}: a batch of {batch.nbytes} bytes")
                yield batch

        def run(batches):
            yield from small(func(small(batches, "html to write" if "body" in schema else "read")), "result")

        return plain(self, run, schema, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", bounded)
    html = "array_join(transform(sequence(1, 128), i -> sha2(concat_ws(' ', id, i), 256)), '')"
    pages = spark.range(0, 4400, 1, 1).selectExpr("id page_id", "'http://x/' url", f"{html} html").coalesce(1)
    warc.write(pages, f"{tmp_path}/whole")
    sizes = sorted(f.stat().st_size for f in (tmp_path / "whole").glob("part-*"))
    assert len(sizes) == 1 and sizes[0] > 1.4 * largest
    rows = warc.read(spark, f"{tmp_path}/whole").collect()
    assert sorted(r["page_id"] for r in rows) == list(range(4400)) and {(r["payload_bytes"], r["record_type"]) for r in rows} == {(8192, "response")}
    warc.write(pages, f"{tmp_path}/cut", file_bytes=3_000_000)
    sizes = sorted(f.stat().st_size for f in (tmp_path / "cut").glob("part-*"))
    assert len(sizes) == 7 and sizes[-1] < 3_200_000
    assert sorted(warc.read(spark, f"{tmp_path}/cut").collect(), key=lambda r: r["page_id"]) == sorted(rows, key=lambda r: r["page_id"])
