"""The n-gram join against brute force, on given and on made-up copies."""

import random
import re
from collections import defaultdict

import pandas as pd
import pytest
from conftest import SF001

from lograft.llm import ngram_join


def brute(docs: dict):
    """id -> (links, component) by comparing all pairs of shingle sets."""

    def shingles(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {k: shingles(t) for k, t in docs.items()}
    inverted = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            inverted[x].append(k)
    common = defaultdict(int)
    for own in inverted.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                common[a, b] += 1
    links, root = defaultdict(int), {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: (links[k], find(k)) for k in docs}


def found(spark, rows, **options):
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text"])).selectExpr(
        "cast(doc_id as long) doc_id", "text", "'x' AS size", "1 AS component"
    )
    got = ngram_join.jaccard_join(frame.repartition(3), **options).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return {r["doc_id"]: (r["n_links"], r["component_id"]) for r in got}


@pytest.mark.parametrize("block", [1024, 4])
def test_near_copies_equal_brute_force(spark, monkeypatch, block):
    """Many copies, near copies at all similarities, and a passage that all share; also with small blocks."""
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", block)
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", block)
    rnd = random.Random(11)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("klmnop") + str(rnd.randint(0, 60))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(6):
        base = [word() for _ in range(rnd.randint(40, 160))]
        for _ in range(12):
            changed = [word() if rnd.random() < rnd.choice([0, 0.005, 0.02, 0.04]) else w for w in base]
            texts.append(" ".join(changed))
        texts += [" ".join(base).upper() + "!"] * 3
    texts += [f"{' '.join(word() for _ in range(30))} {passage}" for _ in range(20)]
    texts += ["one two", "One, two.", "one", "three four five six", "", "...", "1 2 3 4 5"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows) == brute(dict(rows))


def test_given_documents_equal_brute_force(spark):
    docs = pd.read_parquet(f"{SF001}/documents.parquet")[["doc_id", "text"]].head(500)
    rows = list(docs.itertuples(index=False, name=None))
    assert found(spark, rows) == brute(dict(rows))


def test_defined_cases(spark):
    text = "a b c d e f g h i j"
    rows = [(1, text), (2, text), (2, text), (3, None), (None, text), (4, text.replace(" ", "\n")), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["class_id"], r["n_links"], r["component_id"], r["kept"]) for r in ngram_join.jaccard_join(frame).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 1, 3, 1, True), (2, 1, 3, 1, False), (2, 1, 3, 1, False), (4, 1, 3, 1, False),
         (3, 3, 0, 3, True), (5, 5, 0, 5, True), (None, None, 0, None, True)], key=str)
    assert ngram_join.jaccard_join(frame.limit(0)).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    least = ngram_join.least_matches(0.8, 1e-6, 240)
    assert len(least) == 6 and least == sorted(least)
    # the chance to drop a pair of the threshold's similarity at a step stays near the tolerance
    from math import comb

    for n, m in zip(range(40, 241, 40), least, strict=True):
        below = sum(comb(n + 1, k) * 0.8**k * 0.2 ** (n + 1 - k) for k in range(m))
        assert below < 1e-6


def test_rows_of_one_id_with_different_texts(spark):
    """Each text has its own links; of each group one row stays."""
    rnd = random.Random(3)
    words = [f"w{rnd.randint(0, 9999)}" for _ in range(80)]
    other = [f"v{rnd.randint(0, 9999)}" for _ in range(80)]
    text = lambda own, k=None: " ".join(w if i != k else "zz" for i, w in enumerate(own))
    rows = [(1, text(words)), (1, text(other)), (2, text(words, 79)), (3, text(other, 79)), (4, text(other, 0)),
            (5, "some words that stand alone here"), (5, text(words, 0)), (9, text(words).upper()), (9, text(words) + "!")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.jaccard_join(frame, with_hash=True)
    named = frame.selectExpr("doc_id", "text", "xxhash64(text) AS text_hash").join(got, ["doc_id", "text_hash"])
    found = {(r["doc_id"], r["text"]): (r["n_links"], r["component_id"], r["kept"]) for r in named.collect()}
    assert found == {
        rows[0]: (4, 1, True), rows[2]: (4, 1, False), rows[6]: (4, 1, False), rows[7]: (4, 1, False), rows[8]: (4, 1, False),
        rows[1]: (2, 1, True), rows[3]: (2, 1, False), rows[4]: (2, 1, False), rows[5]: (0, 5, True)}
    near = spark.createDataFrame([(1, text(words)), (1, text(words, 0)), (2, text(words, 1))], "doc_id long, text string")
    assert sorted(r["kept"] for r in ngram_join.jaccard_join(near).collect()) == [False, False, True]


def test_no_pair_is_taken_for_met_when_it_was_not():
    """Of ten thousand pairs near the threshold each is passed on by the first band that it shares."""
    import numpy as np

    rng = np.random.default_rng(5)
    sets = []
    for k in range(10_000):
        n = int(rng.integers(60, 300))
        both = int(np.ceil(n * rng.uniform(0.89, 0.925)))  # a similarity of 0.80 to 0.86
        values = rng.integers(0, 2**63, size=2 * n - both, dtype=np.uint64)
        sets += [np.unique(values[:n]), np.unique(np.concatenate((values[:both], values[n:])))]
    shared = lost = pruned = 0
    least = ngram_join.least_matches(ngram_join.THRESHOLD, ngram_join.TOLERANCE, ngram_join.BANDS * ngram_join.ROWS)
    for a in range(0, len(sets), 2000):
        sigs, keys = ngram_join.signatures(sets[a : a + 2000])
        whole = np.concatenate((sigs, ngram_join.key_marks(keys).view(np.uint8).reshape(len(sigs), -1)), axis=1)
        same = keys[::2] == keys[1::2]
        have = same.any(axis=1)
        first = same.argmax(axis=1)
        met = ngram_join.met_before(whole[::2], whole[1::2], first, sigs.shape[1], ngram_join.ROWS)
        shared, lost = shared + have.sum(), lost + (met & have).sum()
        pruned += (~ngram_join.alike(sigs[::2], sigs[1::2], least)).sum()
    assert shared >= 9_999 and lost == 0 and pruned == 0
