"""Spelling variant grouping (operator 13): words one edit apart, and the form each stands for.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. A
word's form is its near word of largest count, if that is at least ``RATIO`` times its own;
its root is the last of the forms that follow one another.

Method: Bloom-guided neighbourhoods.

1. Words and their counts come from whole texts, counted in each task first.
2. The vocabulary goes into blocked Bloom filters (all bits of a key lie in one block of 512
   bits), in shards by length; a length of many words has several shards, by hash. A task
   builds a shard, of bounded size. Shards are broadcast in rounds whose bytes are bounded by
   ``BROADCAST_BYTES``, so a vocabulary of any size is probed in full.
3. Each word generates the edits of one direction: all deletions, which meet the shorter word
   of a pair, and all replacements by a larger code point, which meet the larger one. Every
   near pair is so generated by exactly one of its words. An edit's hash follows from the
   word's prefix sums without making the string; each is probed in the one shard that could
   hold it.
4. Only the positives become strings, and these are joined to the vocabulary by equality,
   which removes what the filters let through wrongly.

A word has at most (length + 1) x alphabet neighbours, so no group of pairs is large. Forms
grow by ``RATIO`` at each step, so the roots take a logarithm of a logarithm of rounds.

Defined cases: a null text has no words; words shorter than ``LEAST_CHARS`` code points or
rarer than ``LEAST_COUNT`` take no part; ties between near words go to the smallest in code
point order; repeated rows count again; a null id is the text ``null`` in the checksum; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import cut
from lograft.llm.spans import mix64, ragged

LEAST_CHARS, LEAST_COUNT, RATIO = 7, 2, 10
#: Code points that words are made of (after lower-casing A-Z).
ALPHABET = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
DAMAGE = 31

BLOCK_BITS, KEY_BITS, PROBES = 512, 20, 8
SHARD_KEYS = 2_000_000  # a shard's filter is 5 MB
BROADCAST_BYTES = 128 << 20
HELD_WORDS = 200_000  # distinct words counted in a task before they go on
PROBED = 1 << 21  # edits probed at once


# ---------------------------------------------------------------- words
def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE) -> DataFrame:
    """``word, n``: the words of all texts, one code point deleted where the checksum of id and word is
    divisible by ``damage``, and how often each occurs."""
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    run_of = re.compile(f"[{ALPHABET[:26]}À-ÿ]{{{LEAST_CHARS},}}")

    def counted(batches):
        held: Counter = Counter()
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                # bytes.lower() changes A-Z only
                own = Counter(run_of.findall(text.encode().lower().decode()))
                prefix = zlib.crc32(f"{name if name is not None else 'null'}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), prefix)
                    if damage and h % damage == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_CHARS:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield table(held)
                    held = Counter()
        if held:
            yield table(held)

    def table(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- hashes of words and of their edits
_BASE = 0x2545F4914F6CDD1B  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _codes(cp: np.ndarray) -> np.ndarray:
    return mix64((cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


@dataclass
class Laid:
    """Words as one array of code points, with the sums that hashes are made of."""

    cp: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    weights: np.ndarray  # code times power, per position
    sums: np.ndarray  # prefix sums of the weights, over all words
    power: np.ndarray  # per position of a word

    @classmethod
    def of(cls, words: Sequence[str]) -> Laid:
        cp = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        begins = np.cumsum(lengths) - lengths
        place = np.arange(len(cp)) - np.repeat(begins, lengths)
        power = _powers(int(lengths.max(initial=0)) + 1)[place]
        weights = _codes(cp) * power
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(weights, dtype=np.uint64)))
        return cls(cp, begins, lengths, weights, sums, power)

    def hashes(self) -> np.ndarray:
        return mix64(self.sums[self.begins + self.lengths] - self.sums[self.begins])


def word_hashes(words: Sequence[str]) -> np.ndarray:
    return Laid.of(words).hashes()


def _shards_of(hashes: np.ndarray, count: int) -> np.ndarray:
    return (mix64(hashes ^ np.uint64(0x5BD1E995)) % np.uint64(count)).astype(np.int64)


class Blocked:
    """A blocked Bloom filter: a key's bits all lie in one block."""

    def __init__(self, data: np.ndarray):
        self.data = data  # blocks of eight 64-bit words, one after another
        self.blocks = np.uint64(len(data) * 64 // BLOCK_BITS)

    @classmethod
    def empty(cls, keys: int) -> Blocked:
        return cls(np.zeros(math.ceil(max(1, keys) * KEY_BITS / BLOCK_BITS) * (BLOCK_BITS // 64), dtype=np.uint64))

    def _at(self, hashes: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
        block = ((hashes >> np.uint64(32)) % self.blocks).astype(np.int64) * BLOCK_BITS
        # two odd steps from the low half, as in double hashing
        low = hashes & np.uint64(0xFFFFFFFF)
        bit = (low + np.uint64(i) * ((low >> np.uint64(9)) | np.uint64(1))) % np.uint64(BLOCK_BITS)
        at = block + bit.astype(np.int64)
        return at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)

    def add(self, hashes: np.ndarray) -> None:
        for i in range(PROBES):
            np.bitwise_or.at(self.data, *self._at(hashes, i))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes may have been added. Each further bit is looked at only where all before are set."""
        left = np.arange(len(hashes))
        for i in range(PROBES):
            word, bit = self._at(hashes[left], i)
            left = left[self.data[word] & bit != 0]
        out = np.zeros(len(hashes), dtype=bool)
        out[left] = True
        return out


# ---------------------------------------------------------------- filters
def shard_plan(vocab: DataFrame, shard_keys: int = SHARD_KEYS) -> list[tuple[int, int, int]]:
    """``length, shards, words`` of each length: a row per length that occurs."""
    lengths = vocab.groupBy(F.length("word").alias("len")).agg(F.count("*").alias("n")).orderBy("len")
    return [(r["len"], math.ceil(r["n"] / shard_keys), r["n"]) for r in lengths.toLocalIterator()]


def rounds_of(plan: list[tuple[int, int, int]], most: int = BROADCAST_BYTES) -> list[list[tuple[int, int, int]]]:
    """``length, shard, shards`` of all shards, in rounds whose filters together stay within ``most`` bytes
    (one shard at least)."""
    out, held = [[]], 0
    for length, shards, n in plan:
        size = math.ceil(n / shards) * KEY_BITS // 8 + BLOCK_BITS // 8
        for shard in range(shards):
            if out[-1] and held + size > most:
                out.append([])
                held = 0
            out[-1].append((length, shard, shards))
            held += size
    return [r for r in out if r]


def build_filters(vocab: DataFrame, wanted: list[tuple[int, int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The filters of some shards, each made by one task from its shard's hashes."""
    shards = {length: count for length, _, count in wanted}
    chosen = {(length, shard) for length, shard, _ in wanted}

    def hashed(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            lengths = np.array([len(w) for w in words], dtype=np.int64)
            hashes = word_hashes(words)
            for length in np.unique(lengths).tolist():
                if length not in shards:
                    continue
                own = hashes[lengths == length]
                at = _shards_of(own, shards[length])
                keep = np.isin(at, [s for n, s in chosen if n == length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(keep.sum(), length), pa.int32()), pa.array(at[keep], pa.int32()), pa.array(own[keep].view(np.int64))],
                    names=["len", "shard", "h"],
                )

    def built(batches):
        current, parts = None, []
        for b in batches:
            key = np.stack([b.column("len").to_numpy(), b.column("shard").to_numpy()], axis=1)
            edges = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            values = b.column("h").to_numpy().view(np.uint64)
            for part, k in zip(np.split(values, edges), key[np.concatenate(([0], edges))] if len(key) else [], strict=False):
                if current != tuple(k.tolist()):
                    if parts:
                        yield filled(current, parts)
                    current, parts = tuple(k.tolist()), []
                parts.append(part)
        if parts:
            yield filled(current, parts)

    def filled(key, parts):
        hashes = np.concatenate(parts)
        own = Blocked.empty(len(hashes))
        own.add(hashes)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([own.data.tobytes()], pa.binary())],
            names=["len", "shard", "data"],
        )

    rows = vocab.select("word").where(F.length("word").isin(*shards)).mapInArrow(hashed, "len int, shard int, h long")
    rows = rows.repartition("len", "shard").sortWithinPartitions("len", "shard")
    made = rows.mapInArrow(built, "len int, shard int, data binary")
    return {(r["len"], r["shard"]): np.frombuffer(r["data"], dtype=np.uint64) for r in made.toLocalIterator()}


# ---------------------------------------------------------------- edits
class Prober:
    """Finds the edits of words that the filters may hold."""

    def __init__(self, filters: dict[tuple[int, int], np.ndarray], shards: dict[int, int]):
        self.filters = {k: Blocked(v) for k, v in filters.items()}
        self.shards = shards
        self.letters = np.array(sorted(map(ord, ALPHABET)), dtype=np.uint32)
        self.letter_codes = _codes(self.letters)

    def _held(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), dtype=bool)
        for length in np.unique(lengths).tolist():
            if length not in self.shards:
                continue
            at = np.flatnonzero(lengths == length)
            shard = _shards_of(hashes[at], self.shards[length]) if self.shards[length] > 1 else np.zeros(len(at), dtype=np.int64)
            for s in np.unique(shard).tolist():
                if (length, s) in self.filters:
                    own = at[shard == s]
                    out[own] = self.filters[length, s].holds(hashes[own])
        return out

    def edits(self, words: Sequence[str]):
        """``number of the word, edit`` for each edit that may be a word."""
        laid = Laid.of(words)
        row = np.repeat(np.arange(len(words)), laid.lengths)
        begin, end = laid.begins[row], (laid.begins + laid.lengths)[row]
        total = laid.sums[end] - laid.sums[begin]
        place = np.arange(len(row)) - begin
        length = laid.lengths[row]

        # a deletion: what stands after it moves one place to the left. Of equal neighbours only the
        # last is deleted: the others give the same word
        once = np.ones(len(row), dtype=bool)
        once[:-1] = (laid.cp[1:] != laid.cp[:-1]) | (row[1:] != row[:-1])
        for a in range(0, len(row), PROBED):
            at = np.arange(a, min(a + PROBED, len(row)))
            at = at[once[at]]
            before = laid.sums[at] - laid.sums[begin[at]]
            after = laid.sums[end[at]] - laid.sums[at + 1]
            found = at[self._held(mix64(before + after * _INVERSE), length[at] - 1)]
            for k in found.tolist():
                word, i = words[row[k]], place[k]
                yield int(row[k]), word[:i] + word[i + 1 :]

        # a replacement by a larger code point
        first = np.searchsorted(self.letters, laid.cp, side="right")
        choices = len(self.letters) - first
        step = max(1, PROBED // len(self.letters))
        for a in range(0, len(row), step):
            part = slice(a, min(a + step, len(row)))
            at = np.repeat(np.arange(part.start, part.stop), choices[part])
            letter = ragged(first[part], choices[part])
            hashes = mix64(total[at] - laid.weights[at] + self.letter_codes[letter] * laid.power[at])
            found = np.flatnonzero(self._held(hashes, length[at]))
            for k in found.tolist():
                word, i = words[row[at[k]]], place[at[k]]
                yield int(row[at[k]]), word[:i] + chr(self.letters[letter[k]]) + word[i + 1 :]


def _candidates(vocab: DataFrame, wanted: list[tuple[int, int, int]]) -> DataFrame:
    """``word, n, edit``: edits that the filters of some shards may hold."""
    context = vocab.sparkSession.sparkContext
    shards = {length: count for length, _, count in wanted}
    sent = context.broadcast(build_filters(vocab, wanted))

    def run(batches):
        prober = Prober(sent.value, shards)
        for b in batches:
            words, counts = b.column("word").to_pylist(), b.column("n").to_pylist()
            i = 0
            while i < len(words):
                j, held = i, 0
                while j < len(words) and (j == i or held + len(words[j]) <= PROBED // 8):
                    held += len(words[j])
                    j += 1
                found = list(prober.edits(words[i:j]))
                if found:
                    at, edits = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([words[i + k] for k in at], pa.string()), pa.array([counts[i + k] for k in at], pa.int64()),
                         pa.array(edits, pa.string())],
                        names=["word", "n", "edit"],
                    )
                i = j

    near = sorted({*shards, *(n + 1 for n in shards)})
    return vocab.select("word", "n").where(F.length("word").isin(*near)).mapInArrow(run, "word string, n long, edit string")


def near_pairs(vocab: DataFrame, shard_keys: int = SHARD_KEYS, most: int = BROADCAST_BYTES) -> DataFrame:
    """``word, n, other, other_n``: every near pair of the vocabulary ``(word, n)``, in both directions."""
    found = None
    for wanted in rounds_of(shard_plan(vocab, shard_keys), most):
        part = _candidates(vocab, wanted)
        found = part if found is None else found.unionByName(part)
    own = vocab.select(F.col("word").alias("edit"), F.col("n").alias("other_n"))
    if found is None:
        return vocab.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    one = found.join(own, "edit").select("word", "n", F.col("edit").alias("other"), "other_n")
    both = F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    return one.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last of the forms that follow one another, by doubling."""
    known = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        new = cut(known.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), "_next"))
        known = new.select("word", "root")
        if new.where("_next is not null").isEmpty():
            return known


def group_variants(
    words: DataFrame, ratio: int = RATIO, shard_keys: int = SHARD_KEYS, most: int = BROADCAST_BYTES
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``words (word, n)`` that is long and frequent enough."""
    vocab = cut(words.where((F.length("word") >= LEAST_CHARS) & (F.col("n") >= LEAST_COUNT)).select("word", "n"))
    near = near_pairs(vocab, shard_keys, most)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    per_word = cut(near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best")))
    large = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    forms = per_word.where(large).select("word", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    rest = per_word.select("word", "n_near").join(forms, "word", "left").join(_roots(forms), "word", "left")
    out = vocab.join(rest, "word", "left")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"),
    )
