"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF001, SF0001

from lograft.llm import spelling
from lograft.llm.queries import op13_spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(docs):
    out = Counter()
    for name, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'null' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    """The same by keys with one code point left out, which all near words share."""
    keys = {}
    for w in words:
        for i in range(len(w)):
            keys.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        keys.setdefault(w, set()).add(w)
    pairs = {(a, b) for own in keys.values() for a in own for b in own if near(a, b)}
    of = {}
    for a, b in pairs:
        of.setdefault(a, set()).add(b)
    form = {}
    for a, own in of.items():
        best = min(own, key=lambda w: (-words[w], w))
        if words[best] >= 10 * words[a]:
            form[a] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, n, len(of.get(w, ())), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


COLUMNS = ["word", "n", "n_near", "form", "form_n", "root"]


def found(frame):
    rows = [tuple(r[c] for c in COLUMNS) for r in frame.select(*COLUMNS).collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_query_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(counted(docs))
    got = op13_spelling(spark, sf)
    assert found(got) == want and len(want) > 50
    kinds = dict(got.dtypes)
    assert kinds["n"] == kinds["n_near"] == kinds["form_n"] == "bigint" and kinds["root"] == "string"


def vocabulary(seed=5):
    rnd = random.Random(seed)
    letters = "abcéÿz×"
    words = {}
    for _ in range(300):
        w = "".join(rnd.choice(letters) for _ in range(rnd.randint(7, 9)))
        n = rnd.choice([2, 3, 20, 40, 400, 5000])
        for _ in range(rnd.randint(1, 6)):
            words[w] = n
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice(letters) + w[i:], w[:i] + rnd.choice(letters) + w[i + 1 :]])
            n = max(2, n // rnd.choice([1, 5, 10, 11]))
            if len(w) < 7:
                break
    words |= {"aaaaaaaa" + "b" * 3000: 50, "aaaaaaaa" + "b" * 2999: 2, "aaaaaaa": 7, "aaaaaaaa": 70, "aaaaaaaaa": 700}
    return words


@pytest.mark.parametrize("sizes", [{}, {"shard_keys": 40, "most": 1000}])
def test_made_up_words_with_many_shards_and_rounds(spark, sizes):
    words = vocabulary()
    frame = spark.createDataFrame([*words.items(), ("short", 90), ("aaaaaac", 1)], "word string, n long").repartition(4)
    assert found(spelling.group_variants(frame, **sizes)) == brute(words)
    if sizes:
        plan = spelling.shard_plan(frame, sizes["shard_keys"])
        rounds = spelling.rounds_of(plan, sizes["most"])
        assert len(rounds) > 1 and sum(map(len, rounds)) == sum(n for _, n, _ in plan)


def test_edits_reach_every_near_word_once():
    words = sorted(vocabulary(8))
    hashes, filters, shards = spelling.word_hashes(words), {}, {}
    lengths = np.array([len(w) for w in words])
    for n in set(lengths.tolist()):
        own = spelling.Blocked.empty(int((lengths == n).sum()))
        own.add(hashes[lengths == n])
        assert own.holds(hashes[lengths == n]).all()
        filters[n, 0], shards[n] = own.data, 1
    got = list(spelling.Prober(filters, shards).edits(words))
    assert len(got) == len(set(got))
    known = set(words)
    pairs = [tuple(sorted((words[i], e))) for i, e in got if e in known]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_filter_lets_little_through():
    rng = np.random.default_rng(0)
    keys, others = rng.integers(0, 2**63, size=(2, 50_000), dtype=np.uint64)
    own = spelling.Blocked.empty(len(keys))
    own.add(keys)
    assert own.holds(keys).all() and own.holds(others).mean() < 0.005


def test_defined_cases(spark):
    rows = [(1, "Überlänge überlänge ÜBERLÄNGE"), (1, "Überlänge überlänge ÜBERLÄNGE"), (None, "abcdefgh abcdefgh"), (2, None), (3, ""),
            (4, "x" * 100_000), (4, "x" * 100_000), (5, "abcdefg " * 60 + "123 abcdefgĀ")]
    frame = spark.createDataFrame([(*r, "w", 3) for r in rows], "doc_id long, text string, word string, n int")
    assert found(spelling.group_variants(spelling.words_of(frame))) == brute(counted(rows))
    assert spelling.group_variants(spelling.words_of(frame.limit(0))).count() == 0
    assert spelling.group_variants(spelling.words_of(frame.where("doc_id = 2"))).columns == COLUMNS
