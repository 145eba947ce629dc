"""Viterbi against all paths; held-out accuracy; defined cases."""

import itertools

import numpy as np
from conftest import SF001

from lograft.llm import language
from lograft.llm.queries import op6_language


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(100):
        sizes = rng.integers(0, 6, 4)
        score = rng.normal(0, 3, (sizes.sum(), 3))
        got, at = language.viterbi(score, sizes, 2.0), 0
        for n in sizes.tolist():
            value = lambda p: sum(score[at + i, x] for i, x in enumerate(p)) - 2 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E501
            best = max(map(value, itertools.product(range(3), repeat=n)))
            assert abs(value(got[at : at + n].tolist()) - best) < 1e-9
            at += n


def test_viterbi_with_many_labels():
    """Pointers to labels beyond 255: each text changes once, from one high label to another."""
    score = np.zeros((8, 300))
    score[[0, 1, 2, 3], [299, 299, 256, 256]] = score[[4, 5, 6, 7], [255, 255, 298, 298]] = 9
    got = language.viterbi(score, np.array([4, 4]), 2.0)
    assert got.tolist() == [299, 299, 256, 256, 255, 255, 298, 298]


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in op6_language(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang").collect()
    assert set(found) == {r["doc_id"] for r in docs}
    own = [(r["lang"], found[r["doc_id"]]) for r in docs]
    held = [lang == f["lang_pred"] for lang, f in own if f["held_out"]]
    assert len(held) > 200 and np.mean(held) > 0.98
    assert all(0 <= f["score"] <= 1 for _, f in own)


def test_defined_cases_and_spans(spark):
    english = "the cat and the dog went over there with them"
    german = "der hund und die katze gehen ueber die strasse nicht"
    greek = "και το παιδι ειναι εδω"
    rows = [(i, t, lang) for i, (t, lang) in enumerate([(english, "en"), (german, "de"), (greek, "el")] * 4)]
    rows += [(100, None, "en"), (101, english, None), (None, german, "de")]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(labelled)
    assert model.langs == ["de", "el", "en"]
    mixed = f"{english}. {german}"
    asked = [(1, mixed, "a"), (2, None, "a"), (3, "123 !?", "a"), (4, "", "a"), (5, greek, "a"), (5, greek, "a"),
             (None, english, "a"), (7, f"{english} " * 4000, "a")]
    docs = spark.createDataFrame(asked, "doc_id long, text string, score string")
    got = language.identify(docs, model, penalty=4.0).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(asked)
    assert [by_id[k]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3 and by_id[2]["score"] == 0.0
    assert by_id[5]["lang_pred"] == "el" and by_id[None]["lang_pred"] == by_id[7]["lang_pred"] == "en"
    assert [(s["lang"], mixed[s["start"] : s["end"]]) for s in by_id[1]["spans"]] == [("en", english), ("de", german)]
    nothing = language.train(labelled.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_dirty_labels_do_not_grow_the_model(spark):
    """Of more labels than ``most_langs`` those with the most rows are learned, then those that sort first."""
    rows = [(i, "the cat and the dog went over", "en") for i in range(9)] + [(i, "der hund und die katze", "de") for i in range(9, 14)]
    rows += [(100 + i, f"word{chr(97 + i % 26)} other thing", f"dirt{i:03}") for i in range(400)] + [(None, "x y", "none"), (999, "z", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.train(labelled, most_langs=3)
    assert model.langs == ["de", "dirt000", "en"] and model.table.shape == (1 << language.FEATURE_BITS, 3)
    docs = spark.createDataFrame([(1, "the dog and the cat"), (2, "die katze und der hund")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()} == {1: "en", 2: "de"}
    assert len(language.train(labelled).langs) == language.MOST_LANGS


def test_sample_is_bounded_per_language(spark):
    rows = [(i, "aa bb", "big") for i in range(4000)] + [(-1 - i, "cc dd", "small") for i in range(30)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(labelled, sample_per_lang=100)
    whole = language.train(labelled)
    assert model.langs == whole.langs == ["big", "small"]
    # all rows of the small language are learned, so that its words' share is what it is with all rows
    small = language.Words(["cc dd"], language.FEATURE_BITS).word
    assert np.allclose(model.table[small, 1], whole.table[small, 1])


def test_scores_do_not_depend_on_the_size_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, (1 << 8, 5)).astype(float)
    model = language.Model(list("abcde"), counts, np.ones((language.N_SCRIPTS, 5)), 8, 0.005)
    texts = ["abc de fghij", None, "", "x" * 300 + " y", " ".join("".join(rng.choice(list("abcdefg"), 4)) for _ in range(500))]
    want = model.label(texts, 2.0)[1]
    for cells in (1, 35, 1000):
        monkeypatch.setattr(language, "CELLS", cells)
        assert model.label(texts, 2.0)[1].tolist() == want.tolist()
