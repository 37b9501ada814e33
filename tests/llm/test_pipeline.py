import re

import corpus_pipeline
from greenlake.llm import common, decontaminate, pii
from greenlake.llm import queries as q

D = "/root/testdata/sf0.001"


def test_stage_decisions_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "pii", "byte_bpe"]
    docs = q.table(spark, D, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, D), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4]
    rated = docs.join(q.table(spark, D, "labels"), "doc_id").where("quality = 0").count()
    assert rated <= 1
    assert decontaminate.contaminated(docs, q.table(spark, D, "benchmark")).count() == 0
    assert all(not pii.base_spans(r["text"]) for r in docs.select("text").collect())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, D)
    assert last.count() == sizes[4] and not re.search("text", " ".join(last.columns))


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, D).select("doc_id", "ids_sha256").collect()
    docs = q.table(spark, D, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, D)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, docs.select("doc_id", "ids_sha256").collect()))


def test_stages_on_odd_rows(spark, frame):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = frame([(1, None, None, None, None), (None, "a b c", "en", "s", 5), (1, None, None, None, None), (2, "", "en", "s", 0), (3, "x " * 20000, "en", "s", 40000)], columns)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, D).count() >= 0
        assert stage(spark, docs.where("false"), D).count() == 0
