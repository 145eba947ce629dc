"""BPE against the tokenizers library; packing against its rules."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lograft.llm import bpe, packing
from lograft.llm.queries import vocabulary_path

SIGNS = ["a", "s", "t", "re", "ve", "ll", "'", " ", "  ", "\n", "\t", "é", "日本", "1", "²", "!", "<|endoftext|>", "<|endof",
         "😀", "A", "\x1c", "\x85", "\u3000", "'re", "'s", "\u200d"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def hard_texts():
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 25))) for _ in range(600)]
    return [*texts, "", None, "x" * 30_000, "ab " * 20_000, "!?" * 700, " " * 5000 + "z"]


def test_encoder_equals_the_library(library):
    texts = hard_texts()
    enc = bpe.Encoder(vocabulary_path(), cache_words=50)  # the cache is emptied again and again
    for at in range(0, len(texts), 60):
        part = texts[at : at + 60]
        ids, counts = enc.encode(part)
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert got == want
        assert enc.decode(ids, counts) == [library.decode(w, skip_special_tokens=False) for w in want]


def test_one_tree_and_many_trees_agree():
    vocab = bpe.Vocabulary(vocabulary_path())
    rnd = random.Random(3)
    words = [bytes(rnd.choice(b" the and ing\xc3\xa9aaa") for _ in range(rnd.randint(1, 70))) for _ in range(300)]
    ids, counts = bpe.merge_many(words, vocab)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [bpe.merge_one(w, vocab) for w in words]


def test_many_special_tokens(tmp_path):
    """More special tokens than a vocabulary usually has: each is one id, none is plain text."""
    with open(vocabulary_path(), encoding="utf-8") as f:
        spec = json.load(f)
    proto = spec["added_tokens"][0]
    first = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1

    def written(n):
        own = [{**proto, "id": first + k, "content": f"<|mark{k:04}|>"} for k in range(n)]
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps({**spec, "added_tokens": spec["added_tokens"] + own}), encoding="utf-8")
        return str(path)

    path = written(700)
    library, enc = Tokenizer.from_file(path), bpe.Encoder(path)
    texts = ["".join(f"<|mark{k:04}|> and{k}" for k in range(i, 700, 90)) for i in range(90)] + ["<|mark0699|>", "<|mark9999|>"]
    ids, counts = enc.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert enc.decode(ids, counts) == texts
    with pytest.raises(ValueError):
        bpe.Encoder(written(2100))


def frame(spark, texts):
    rows = [(i, t, "other", i) for i, t in enumerate(texts)]
    rows.append((0, texts[0], "other", 0))  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, length long").repartition(3)


def test_round_trip_frames(spark, library):
    texts = hard_texts()[:80] + [None, ""]
    docs = frame(spark, texts)
    coded = bpe.encode_documents(docs, vocabulary_path())
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(coded, vocabulary_path()).collect()}
    both = bpe.round_trip(docs, vocabulary_path()).collect()
    assert len(both) == len(texts) + 1
    for r in both:
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)
        assert r["decoded"] == back[r["doc_id"]] == (texts[r["doc_id"]] or "")
    assert bpe.round_trip(docs.limit(0), vocabulary_path()).count() == 0


def check_packing(rows, texts, library, window=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for d, pieces in by_doc.items():
        ids = np.array([*library.encode(texts[d] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            part = ids[at : at + r["length"]].tobytes()
            assert bytes(r["ids"]) == part and r["crc"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and at & (at - 1) == 0  # full or a power of two: nothing to pad


@pytest.mark.parametrize("pool", [0, 5, 2048])
def test_packing_is_whole_and_without_padding(spark, library, pool):
    texts = [*hard_texts()[:200], *["same text here " * 60] * 50, "ab " * 9000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    pieces = packing.pack_documents(docs, vocabulary_path(), pool=pool)
    digest = packing.pieces_digest(pieces).withColumnRenamed("ids_crc32", "crc").drop("doc_tokens", "length", "offset")
    rows = pieces.join(digest, ["doc_id", "start", "sequence_id"]).collect()
    check_packing(rows, texts, library)
    assert packing.pack_documents(docs.limit(0), vocabulary_path()).count() == 0


def test_packing_of_nulls_repeats_and_clashing_columns(spark, library):
    """Null texts are the end id alone, repeated rows are packed each, columns of like names are not read."""
    rows = [(1, None, "a", 7), (2, "", "b", 7), (3, "same words", "c", 7), (3, "same words", "c", 7), (None, "no id", "d", 7),
            (4, "long " * 3000, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, length long").repartition(2)
    pieces = packing.pieces_digest(packing.pack_documents(docs, vocabulary_path())).collect()
    assert sum(r["length"] for r in pieces) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in rows)
    own = defaultdict(list)
    for r in pieces:
        own[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]))
    end = zlib.crc32(np.array([0], dtype="<u4").tobytes())
    assert own[1] == own[2] == [(0, 1, 1, end)]
    same = len(library.encode("same words", add_special_tokens=False).ids) + 1
    assert sum(n for _, n, _, _ in own[3]) == 2 * same and all(t == same for *_, t, _ in own[3])
    assert None in own
    spaces = {(r["sequence_id"], r["offset"] + k) for r in pieces for k in range(r["length"])}
    assert len(spaces) == sum(r["length"] for r in pieces)


def test_closest_fill_is_the_best_sum():
    rnd = random.Random(5)
    for _ in range(200):
        capacity = rnd.randint(1, 40)
        counts = {rnd.randint(1, 45): rnd.randint(1, 3) for _ in range(rnd.randint(0, 5))}
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        taken = packing.closest_fill(counts, capacity)
        assert all(taken[k] <= counts[k] for k in taken)
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= capacity)
