"""Byte-level BPE: encoding by segment trees over adjacent pair ranks, and decoding (operator 1).

A pre-token is a row of byte tokens. Leaf ``i`` of its segment tree holds the key
``rank * leaves + i`` of the pair that begins at token ``i`` (a large key where
the pair can't merge), so the root's minimum is the leftmost merge of the lowest
rank. A merge changes three leaves; each is updated along its path to the root.
The merging ends when the root holds no mergeable pair.

Short pre-tokens of a batch are merged together: one numpy array holds the trees
of all of them, and every round takes one merge of each. Long ones have a tree of
their own. Results are kept in a bounded cache, since texts repeat their words.

Defined cases: a null text is empty, an empty text has no ids; repeated rows are
encoded alike; texts and pre-tokens of any length are taken whole; only the id
and text columns are read, so other columns can have any name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lograft.llm.spans import BREAK, LETTER, OTHER, SPACE, TextBatch, chunks, ragged

_NONE = np.int64(1) << np.int64(62)
_LONG = 64  # longer pre-tokens are known by their text, shorter ones by their hash
_BATCH_BYTES = 1024  # longer pre-tokens are merged one by one
_CELLS = 1 << 21  # tree nodes merged at once
_CACHE_WORDS = 800_000

# Code points that no text holds (lone surrogates) stand for special tokens while texts are cut.
_SPECIAL_MARKS = [chr(cp) for cp in range(0xD801, 0xE000)]


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file (tokenizers' JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_characters()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token)
        for token, i in special.items():
            self.token_bytes[i] = token.encode()
        self.special = special
        self.byte_id = np.zeros(256, dtype=np.int64)
        for c, b in to_byte.items():
            self.byte_id[b] = vocab.get(c, 0)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        lengths = np.array([len(b) for b in self.token_bytes], dtype=np.int64)
        self.byte_pool = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)
        self.byte_lengths, self.byte_starts = lengths, np.cumsum(lengths) - lengths

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, -1 where it can't merge."""
        key = (left << np.int64(32)) | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)


def merge_one(word: bytes, vocab: Vocabulary) -> list[int]:
    """Ids of one pre-token by a segment tree of its own."""
    n = len(word)
    if n < 2:
        return [int(vocab.byte_id[b]) for b in word]
    leaves = 1 << (n - 1).bit_length()
    ids = [int(vocab.byte_id[b]) for b in word]
    none = int(_NONE)
    rank_of, merged = vocab.rank_of, vocab.merged
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * leaves)

    def leaf(i: int) -> int:
        j = following[i]
        rank = rank_of.get((ids[i] << 32) | ids[j]) if j < n else None
        return none if rank is None else rank * leaves + i

    for i in range(n - 1):
        tree[leaves + i] = leaf(i)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, key: int) -> None:
        node = leaves + i
        tree[node] = key
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low

    while tree[1] != none:
        rank, i = divmod(tree[1], leaves)
        j = following[i]
        ids[i] = int(merged[rank])
        following[i] = following[j]
        ids[j] = -1
        if following[i] < n:
            previous[following[i]] = i
        put(j, none)
        put(i, leaf(i))
        if previous[i] >= 0:
            put(previous[i], leaf(previous[i]))
    return [x for x in ids if x >= 0]


def merge_many(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pre-tokens, one after another, and how many each has: one tree a row."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    rows, leaves = len(words), max(2, 1 << (int(sizes.max()) - 1).bit_length())
    column = np.arange(leaves)
    alive = column < sizes[:, None]
    ids = np.zeros((rows, leaves), dtype=np.int64)
    ids[alive] = vocab.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
    following = np.where(column + 1 < sizes[:, None], column + 1, leaves).astype(np.int64).ravel()
    previous = np.broadcast_to(column - 1, (rows, leaves)).astype(np.int64).ravel()
    tree = np.full((rows, 2 * leaves), _NONE, dtype=np.int64)
    rank = vocab.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, leaves - 1)
    can = alive[:, 1:] & (rank >= 0)
    tree[:, leaves:-1] = np.where(can, rank * leaves + column[:-1], _NONE)
    width = leaves
    while width > 1:
        half = width // 2
        tree[:, half:width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
        width = half
    ids, alive, tree = ids.ravel(), alive.ravel(), tree.ravel()

    def put(row: np.ndarray, at: np.ndarray, keys: np.ndarray) -> None:
        base, node = row * (2 * leaves), at + leaves
        tree[base + node] = keys
        node = node >> 1
        while node.size and node[0] >= 1:
            child = base + 2 * node
            tree[base + node] = np.minimum(tree[child], tree[child + 1])
            node = node >> 1

    def keys(row: np.ndarray, at: np.ndarray) -> np.ndarray:
        base = row * leaves
        after = following[base + at]
        there = after < leaves
        found = vocab.ranks(ids[base + at], ids[base + np.where(there, after, 0)])
        return np.where(there & (found >= 0), found * leaves + at, _NONE)

    row = np.arange(rows, dtype=np.int64)
    while True:
        root = tree[row * (2 * leaves) + 1]
        row, root = row[root < _NONE], root[root < _NONE]
        if not row.size:
            break
        at, base = root % leaves, row * leaves
        gone = following[base + at]
        ids[base + at] = vocab.merged[root // leaves]
        after = following[base + gone]
        following[base + at] = after
        alive[base + gone] = False
        more = after < leaves
        previous[(base + after)[more]] = at[more]
        put(row, gone, np.full(row.size, _NONE))
        put(row, at, keys(row, at))
        before = previous[base + at]
        has = before >= 0
        put(row[has], before[has], keys(row[has], before[has]))
    return ids[alive], alive.reshape(rows, leaves).sum(axis=1)


def pre_token_starts(batch: TextBatch) -> np.ndarray:
    """Where the pre-tokens of a batch begin: a contraction; a run of letters, numbers or other
    signs with the one space before it; white space, of which the last one goes to the next token."""
    cp, kind = batch.cp, batch.classes
    n = len(cp)
    before = np.concatenate(([BREAK], kind[:-1]))
    after = np.concatenate((kind[1:], [BREAK]))
    space_before = np.concatenate(([False], cp[:-1] == 0x20))
    start = kind != before
    # the last white space before a visible character stands apart from the rest of its run
    start |= (kind == SPACE) & (after != SPACE) & (after != BREAK)
    # a visible run takes one plain space before it
    start &= ~((kind != SPACE) & (kind != BREAK) & space_before)
    start |= kind == BREAK
    mark = np.flatnonzero((cp == 0x27) & (after == LETTER) & (before != OTHER) & ~space_before)
    if mark.size:
        padded = np.concatenate((cp, [0, 0, 0])).astype(np.int64)
        one, two = padded[mark + 1], padded[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & np.isin(one * 256 + two, [ord(p[0]) * 256 + ord(p[1]) for p in ("re", "ve", "ll")]) & (two < 256)
        found, end = short | long, mark + np.where(short, 2, 3)
        start[mark[found] + 1] = False
        start[end[found & (end < n)]] = True
    return start


class Encoder:
    """Encodes batches of whole texts; keeps what words it has met, within a bound."""

    def __init__(self, path: str, cache_words: int = _CACHE_WORDS):
        self.vocab = Vocabulary(path)
        self.cache_words = cache_words
        if len(self.vocab.special) > len(_SPECIAL_MARKS):
            raise ValueError(f"a vocabulary may have up to {len(_SPECIAL_MARKS)} special tokens")
        self.marks = dict(zip(self.vocab.special, _SPECIAL_MARKS, strict=False))
        self.mark_ids = {ord(m): self.vocab.special[t] for t, m in self.marks.items()}
        self._forget()

    def _forget(self) -> None:
        self.slots: dict = {}
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0
        self.begins = np.zeros(1 << 14, dtype=np.int64)
        self.counts = np.zeros(1 << 14, dtype=np.int64)

    def _keep(self, names: list, ids: np.ndarray, counts: np.ndarray) -> None:
        first, need = len(self.slots), self.used + len(ids)
        if need > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(max(need, len(self.pool)), dtype=np.int32)))
        while first + len(names) > len(self.begins):
            self.begins = np.concatenate((self.begins, np.zeros_like(self.begins)))
            self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)))
        self.pool[self.used : need] = ids
        self.begins[first : first + len(names)] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + len(names)] = counts
        self.slots.update(zip(names, range(first, first + len(names)), strict=True))
        self.used = need

    def _learn(self, names: list, words: list[bytes]) -> None:
        """Encodes new words, those of like length together."""
        classes: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            size = len(w)
            classes.setdefault(0 if size > _BATCH_BYTES else max(2, 1 << (size - 1).bit_length()), []).append(k)
        for leaves, members in classes.items():
            step = max(1, _CELLS // leaves) if leaves else 1
            for i in range(0, len(members), step):
                part = members[i : i + step]
                if leaves:
                    ids, counts = merge_many([words[k] for k in part], self.vocab)
                else:
                    ids = np.array(merge_one(words[part[0]], self.vocab), dtype=np.int64)
                    counts = np.array([len(ids)])
                self._keep([names[k] for k in part], ids, counts)

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another (int32), and how many ids each text has."""
        batch = TextBatch(texts, self.marks)
        n = len(batch.cp)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        starts = np.flatnonzero(pre_token_starts(batch))
        ends = np.concatenate((starts[1:], [n]))
        kinds, cps = batch.classes[starts], batch.cp[starts]
        separators = kinds == BREAK
        names = batch.hashes(starts, ends)
        if len(self.slots) > self.cache_words or self.used > 8 * self.cache_words:
            self._forget()
        slot = np.full(len(starts), -1, dtype=np.int64)
        text = batch.joined

        short = np.flatnonzero(~separators & (ends - starts <= _LONG))
        unique, first, inverse = np.unique(names[short], return_index=True, return_inverse=True)
        listed = unique.tolist()
        new = [k for k, name in enumerate(listed) if name not in self.slots]
        if new:
            at = short[first[new]]
            words = [text[a:b].encode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self._learn([listed[k] for k in new], words)
        slots = self.slots
        slot[short] = np.fromiter((slots[x] for x in listed), dtype=np.int64, count=len(listed))[inverse]

        for k in np.flatnonzero(~separators & (ends - starts > _LONG)).tolist():
            word = text[starts[k] : ends[k]]
            if word not in slots:
                self._learn([word], [word.encode()])
            slot[k] = slots[word]
        for k in np.flatnonzero(separators).tolist():
            cp = int(cps[k])
            if cp in self.mark_ids:
                if ("special", cp) not in slots:
                    self._keep([("special", cp)], np.array([self.mark_ids[cp]]), np.array([1]))
                slot[k] = slots[("special", cp)]

        real = slot >= 0
        counts = np.where(real, self.counts[slot], 0)
        ids = self.pool[ragged(self.begins[slot[real]], counts[real])]
        per_text = np.zeros(len(texts) + 1, dtype=np.int64)
        edges = np.searchsorted(starts, batch.begins[:-1])
        sums = np.concatenate(([0], np.cumsum(counts)))
        per_text = sums[np.concatenate((edges[1:], [len(starts)]))] - sums[edges]
        return ids, per_text

    def decode_bytes(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
        """The bytes of each text, from all ids and how many each text has."""
        lengths = self.vocab.byte_lengths[ids]
        data = self.vocab.byte_pool[ragged(self.vocab.byte_starts[ids], lengths)].tobytes()
        sums = np.concatenate(([0], np.cumsum(lengths)))
        edges = sums[np.concatenate(([0], np.cumsum(counts)))].tolist()
        for a, b in zip(edges, edges[1:], strict=False):
            yield data[a:b]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each row of ids; bytes that aren't UTF-8 become replacement characters."""
        return [b.decode("utf-8", "replace") for b in self.decode_bytes(ids, counts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This Python worker's encoder of a vocabulary file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _id_bytes(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each text's ids as little-endian unsigned 32-bit integers."""
    data, edges = ids.astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(counts))) * 4
    offsets = pa.py_buffer(edges.astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, pa.py_buffer(data)])


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids``: the ids of every whole text, as little-endian unsigned 32-bit integers."""
    return _coded(docs.select(id_col, text_col), vocab_path, with_text=False)


def round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids, decoded``: encodes every whole text and decodes its ids, in one pass."""
    return _coded(docs.select(id_col, text_col), vocab_path, with_text=True)


def _coded(docs: DataFrame, vocab_path: str, with_text: bool) -> DataFrame:
    id_col = docs.columns[0]
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids", *["decoded"] * with_text]

    def run(batches):
        enc = encoder(vocab_path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in chunks(texts):
                ids, counts = enc.encode(texts[i:j])
                columns = [b.column(0)[i:j], pa.array(counts, pa.int64()), _id_bytes(ids, counts)]
                if with_text:
                    columns.append(pa.array(enc.decode(ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary" + ", decoded string" * with_text)


def decode_documents(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: the text of every row of ids (null or empty ids: an empty text)."""
    encoded = encoded.select(id_col, ids_col)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(vocab_path)
        for b in batches:
            rows = [r or b"" for r in b.column(1).to_pylist()]
            counts = np.array([len(r) // 4 for r in rows], dtype=np.int64)
            ids = np.frombuffer(b"".join(rows), dtype="<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(enc.decode(ids, counts), pa.string())], names=[id_col, "text"]
            )

    return encoded.mapInArrow(run, f"`{id_col}` {kind}, text string")
