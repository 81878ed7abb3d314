"""Fill-in-the-middle: units, places, forms and round trips against plain regular expressions."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pressmill.llm import fill_middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
PIECES = st.lists(st.sampled_from(["a", "Zb", "<", "P", ">", "<P>", "<S>", "<M>", "é", "\n", " ", "\U0001f600", "?", "\x00", "12", "ſ", "\x7f"]), max_size=14).map("".join)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(u), "plain", None, None, text
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = ("".join(x) for x in (u[:a], u[a:b], u[b:]))
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=400, deadline=None)
@given(PIECES, st.integers(-5, 10**12))
def test_units_places_and_output(text, doc_id):
    units, found = UNIT.findall(text), fill_middle.events(text)
    assert found.n == len(units) and found.sentinel == bool(re.search("<[PSM]>", text))
    assert [found.place(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]
    assert fill_middle.transformed(doc_id, text) == plain(doc_id, text)


def test_events_are_sparse():
    found = fill_middle.events("x" * 100_000 + "é1 " * 100_000 + "y")
    assert len(found.at) == 6 and found.n == 300_002 and found.place(300_001) == 400_000


def test_odd_and_empty_tables(odd_documents, no_documents):
    rows = fill_middle.digests(odd_documents).collect()
    want = [(r.doc_id, *(w := plain(r.doc_id, r.text))[:4], sha(w[4]), sha(r.text or "")) for r in odd_documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert {r.form for r in rows if r.doc_id in (2, 3)} == {"plain"}
    assert fill_middle.digests(no_documents).count() == 0


def test_outputs_are_whole_and_restored(spark):
    texts = ["<", "<P", "a<S", "<<P >", "one two <M three", "é" * 50 + "<P>", "ab cd ef", "\n\n", "z", "<S" * 40]
    docs = spark.createDataFrame([(i, t) for i in range(60) for t in texts], "doc_id long, text string")
    rows = fill_middle.transform(docs).select("doc_id", "form", "output", fill_middle.restored().alias("back")).collect()
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert sorted((r.doc_id, r.back) for r in rows) == sorted((i, t) for i in range(60) for t in texts)
    assert sorted((r.doc_id, r.output) for r in rows) == sorted((i, plain(i, t)[4]) for i in range(60) for t in texts)


def test_every_document_against_plain_python(spark):
    import os

    import pyarrow.parquet as pq

    from pressmill.llm import queries

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    docs = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    got = {r.doc_id: tuple(r) for r in queries.op11_fill_middle(spark, folder).collect()}
    for d in docs:
        w = plain(d["doc_id"], d["text"])
        assert got[d["doc_id"]] == (d["doc_id"], *w[:4], sha(w[4]), sha(d["text"] or ""))
