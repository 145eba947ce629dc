"""Top-k search and embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lograft.llm import embed_dedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, links string"


def vectors(seed=0, n=300, d=9):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        x = centres[i % 12] + rng.normal(size=d) * rng.choice([0.0, 0.02, 0.1, 1.0])
        if i % 40 == 7:
            x = centres[0] * 3  # equal vectors
        rows.append((i, [float(np.float32(v)) for v in x], [1, 1, 1, 2, None][i % 5], "s", "l"))
    rows += [(1000, None, 1, "s", "l"), (1001, [0.0] * d, 1, "s", "l"), (1002, [float("nan")] * d, 1, "s", "l"),
             (1050, [1.0, None, 2.0], 1, "s", "l"), (1004, [1.0, 2.0], 1, "s", "l"), (1005, [], 1, "s", "l"),
             (1006, [float("inf")] * d, 2, "s", "l")]
    return rows


def test_search_equals_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    good = {}
    for i, e, *_ in rows:
        if e is not None and all(x is not None and np.isfinite(x) for x in e):
            good[i] = [int(np.floor(256 * x)) for x in e]
    want = set()
    for q in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], v, strict=False)), i) for i, v in good.items() if i != q)
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])}
    for sizes in ({}, {"shard_rows": 40, "query_block": 2}):
        got = topk.search(frame, F.col("id") % 50 == 0, **sizes)
        assert {tuple(r) for r in got.collect()} == want and dict(got.dtypes)["rank"] == "int"
    few = topk.search(frame.where("vec_id in (0, 50, 100)"), F.col("id") % 50 == 0).collect()
    assert len(few) == 6  # two candidates each
    assert topk.search(frame.limit(0), F.col("id") % 50 == 0).count() == 0
    twice = frame.where("vec_id < 5")  # repeated rows count once
    got = topk.search(twice.unionByName(twice), F.col("id") % 50 == 0).collect()
    assert [r["rank"] for r in sorted(got)] == [1, 2, 3, 4]


def test_large_weights_stay_exact(spark):
    rows = [(i, [float(2.0**14 * (i + 1)), float(i)], 1, "s", "l") for i in range(60)]
    got = topk.search(spark.createDataFrame(rows, SCHEMA), F.col("id") == 50).collect()
    terms = {i: [int(np.floor(256 * x)) for x in e] for i, e, *_ in rows}
    want = sorted((-sum(a * b for a, b in zip(terms[50], terms[i], strict=True)), i) for i in terms if i != 50)[:5]
    assert [(r["vec_id"], r["score"]) for r in sorted(got)] == [(i, -s) for s, i in want]


def brute(rows, threshold):
    good = [(i, np.array(e, dtype=np.float64), lab) for i, e, lab, *_ in rows
            if lab is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, root = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x, la) in enumerate(good):
        for b, y, lb in good[k + 1 :]:
            if la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {i: (links[i], find(i), find(i) == i) for i in links}


@pytest.mark.parametrize("block", [1024, 16])
@pytest.mark.parametrize("threshold", [0.98, 0.6])
def test_links_equal_brute_force(spark, block, threshold):
    rows = vectors(3)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = embed_dedup.link_vectors(frame, threshold, block_rows=block).collect()
    assert len(got) == len(rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows, threshold)


def test_link_cases(spark):
    x = [1.0, 2.0]
    rows = [(1, x, 1, "", ""), (1, x, 1, "", ""), (2, x, 1, "", ""), (None, x, 1, "", ""), (3, x, None, "", ""), (4, x, 2, "", "")]
    got = embed_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True), (3, 0, 3, True), (4, 0, 4, True)], key=str)
    assert embed_dedup.link_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_different_vectors_of_one_id(spark):
    """Both are candidates and queries, as in the SQL; links are each vector's own."""
    import duckdb
    import pandas as pd

    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.9, 0.1]), (1, [0.9, 0.1]), (2, [0.7, 0.0]), (50, [0.0, 1.0]), (50, [1.0, 0.2]), (3, [0.1, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.search(frame.repartition(3), F.col("id") % 50 == 0, shard_rows=3)
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame(rows, columns=["vec_id", "embedding"]))
    want = con.sql(topk.oracle_sql()).fetchall()
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)
    labelled = [(1, [1.0, 0.0], 1, "", ""), (1, [0.0, 1.0], 1, "", ""), (2, [1.0, 0.01], 1, "", ""), (3, [1.0, 0.02], 1, "", ""), (4, [0.01, 1.0], 1, "", "")]
    found = embed_dedup.link_vectors(spark.createDataFrame(labelled, SCHEMA)).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 1, 1, False)]


def test_parts_and_given_thresholds(monkeypatch):
    """Part by part, with thresholds of another shard, ties and large numbers: as by sorting all scores."""
    rng = np.random.default_rng(5)
    monkeypatch.setattr(topk, "PART_ROWS", 7)
    for kind, scale in ((np.float64, 1), (np.int64, 1), (np.int64, 2**28)):
        weights = (rng.integers(-2, 3, (60, 4)) * scale).astype(kind)  # few values: many ties
        asked = (rng.integers(-2, 3, (12, 4)) * scale).astype(kind)
        ids = rng.permutation(90)[:60]
        names = np.concatenate((ids[:8], [500, 501, 502, 503]))
        scores = asked @ weights.T
        want = []
        for own, score in zip(names, scores, strict=True):
            want.append(sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist(), strict=True) if i != own)[:5])
        for starts in ([-np.inf] * 12, [kind(-w[-1][0]) for w in want], [kind(-w[0][0] + 1) for w in want]):
            got = topk.best_of_shard(weights, ids, asked, names, 5, starts)
            got = [list(zip((-s).tolist(), i.tolist(), strict=True)) for i, s in got]
            if starts[0] == -np.inf or starts[0] == -want[0][-1][0]:
                assert got == want
            else:  # a threshold above all: nothing that could have ranked is wrong, and nothing needs to be found
                assert all(set(g) <= set(zip((-score).tolist(), ids.tolist(), strict=True)) for g, score in zip(got, scores, strict=True))
