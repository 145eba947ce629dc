"""The pipeline's stages against plain versions of what they decide."""

import corpus_pipeline
from conftest import SF0001
from test_llm_ngram_join import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "packing"]


def test_run_keeps_one_of_each_group(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    pieces = corpus_pipeline.run(spark, SF0001).collect()
    worded = {k: r["text"] for k, r in docs.items() if any(c.isalpha() for c in r["text"] or "")}
    groups = brute(worded)
    assert {p["doc_id"] for p in pieces} == {k for k in worded if groups[k][1] == k}
    lengths = {}
    for p in pieces:
        lengths[p["sequence_id"]] = lengths.get(p["sequence_id"], 0) + p["length"]
    assert all(n == 1024 or n & (n - 1) == 0 for n in lengths.values())


def test_stage_decisions_and_cases(spark):
    text = "the cat and the dog went over there with all of them again "
    rows = [
        (1, text * 3, "en", "s", 1, "x"), (2, text * 3, "en", "s", 1, "x"), (2, text * 3, "en", "s", 1, "x"),
        (3, "123 456", "en", "s", 1, "x"), (4, None, "en", "s", 1, "x"), (5, "", None, None, None, None),
        (6, f"{text} password=abcdefgh12", "en", None, 1, "x"), (None, "alone here", None, "s", 1, "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    labelled = stages["language"](spark, docs, "")
    assert labelled.columns == corpus_pipeline.COLUMNS
    assert sorted(str(r["doc_id"]) for r in labelled.collect()) == ["1", "2", "2", "6", "None"]
    assert {r["lang"] for r in labelled.collect()} == {"en"}
    single = stages["near_duplicates"](spark, labelled, "")
    assert sorted(str(r["doc_id"]) for r in single.collect()) == ["1", "6", "None"]
    clean = {r["doc_id"]: r for r in stages["secrets"](spark, single, "").collect()}
    assert clean[6]["text"] == f"{text} [secret]" and clean[6]["n_chars"] == len(clean[6]["text"])
    assert clean[1]["text"] == text * 3
    packed = stages["packing"](spark, stages["secrets"](spark, single, ""), "").collect()
    assert {r["doc_id"] for r in packed} == {1, 6, None}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
