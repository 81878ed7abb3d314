"""Each stage of the pipeline against its operator's own result on that stage's input."""

import os

import pytest

D = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


def test_stages(spark):
    import corpus_pipeline as P
    from pressmill.llm import common, decontaminate, line_crf, mixing, near_dedup

    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in P.STAGES:
        before, docs = docs, common.materialize(stage(spark, docs, D), name)
        seen.append(docs.count())
        if name == "quality_rules":
            chain = line_crf.train(before, spark.read.parquet(f"{D}/labels.parquet"))
            want = {r.doc_id for r in line_crf.judge(before, chain).where("kept").collect()}
        elif name == "near_dedup":
            want = {r.class_id for r in near_dedup.near_duplicates(before).collect()}
        elif name == "decontamination":
            want = {r.doc_id for r in before.collect()} - {r.doc_id for r in decontaminate.leaks(before, spark.read.parquet(f"{D}/benchmark.parquet")).collect()}
        elif name == "mixing":
            want = {r.doc_id for r in mixing.mix(before).where("2 * taken >= size and taken > 0").collect()}
        else:
            assert docs.count() == before.count() and docs.select("start").distinct().count() == docs.count()
            continue
        assert docs.columns == columns and {r.doc_id for r in docs.collect()} == want
    assert seen[0] > seen[1] > 0 and seen[-1] == seen[-2]


def test_stages_on_odd_and_empty_tables(spark, odd_documents, no_documents):
    import corpus_pipeline as P
    from pressmill.llm import common

    for docs, some in ((odd_documents, True), (no_documents, False)):
        columns = docs.columns
        for name, stage in P.STAGES:
            before, docs = docs, common.materialize(stage(spark, docs, D), name)
            if name != "token_output":
                assert docs.columns == columns and (name == "mixing" or docs.count() <= before.count())
        assert (docs.count() > 0) == some
