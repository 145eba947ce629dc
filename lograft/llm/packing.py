"""Packing documents into fixed windows by minimum bin slack (operator 5).

A document is its ids and one end id. Its full windows stand alone; what remains
(shorter than a window) goes to a bounded pool. For each next window a bitset
subset-sum over the multiset of remaining lengths finds the sum closest to the
capacity: bit ``s`` of an integer tells whether the sum ``s`` can be made, one
shift per copy of a length. Going back through the bitsets gives how many of each
length to take. Where even the closest sum leaves a gap, one more remainder is
cut to fill it. What is left at a task's end is cut at powers of two, which need
no padding, so that no sequence is padded.

Every task packs the documents of its own input split in one pass, with a pool of
bounded size: no id is shuffled, and a lost task is repeated with the same result.

Defined cases: a null text is empty, so its document is the end id alone; an empty
table gives no pieces; repeated rows are packed each; texts of any length are cut
into windows; only the id and text columns are read.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lograft.llm.bpe import encoder
from lograft.llm.spans import chunks

POOL = 2048  # remainders that wait for a window, per task


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is the largest up to ``capacity``."""
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        copies = min(counts[length], capacity // length)
        if not copies:
            continue
        steps.append((length, copies, reach))
        moved = reach
        for _ in range(copies):
            moved = (moved << length) & mask
            if not moved:
                break
            reach |= moved
        if reach >> capacity & 1:
            break
    left, taken = reach.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        k = next(k for k in range(copies + 1) if left >= k * length and before >> (left - k * length) & 1)
        if k:
            taken[length] = k
            left -= k * length
    return taken


class Packer:
    """Packs documents of one task; ``pieces`` are (doc, start, ids, doc tokens, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.pool: dict[int, deque] = defaultdict(deque)
        self.waiting = 0

    def _put(self, doc, start: int, ids: np.ndarray, tokens: int) -> None:
        self.pool[len(ids)].append((doc, start, ids, tokens))
        self.waiting += 1

    def _take(self, length: int):
        held = self.pool[length]
        item = held.popleft()
        if not held:
            del self.pool[length]
        self.waiting -= 1
        return item

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        """Full windows of a document at once; its remainder waits."""
        n = len(ids)
        for start in range(0, n - self.window + 1, self.window):
            yield doc, start, ids[start : start + self.window], n, self.sequence, 0
            self.sequence += 1
        rest = n - n % self.window
        if rest < n:
            self._put(doc, rest, ids[rest:].copy(), n)

    def _sequence(self, capacity: int) -> Iterator[tuple]:
        offset = 0
        taken = closest_fill({k: len(v) for k, v in self.pool.items()}, capacity)
        for length, k in taken.items():
            for _ in range(k):
                doc, start, ids, tokens = self._take(length)
                yield doc, start, ids, tokens, self.sequence, offset
                offset += length
        if gap := capacity - offset:
            doc, start, ids, tokens = self._take(max(self.pool))  # every one left is longer than the gap
            yield doc, start, ids[:gap], tokens, self.sequence, offset
            self._put(doc, start + gap, ids[gap:], tokens)
        self.sequence += 1

    def full(self, most: int) -> Iterator[tuple]:
        """Windows from the pool until at most ``most`` remainders wait and less than a window is left."""
        total = sum(k * len(v) for k, v in self.pool.items())
        while self.waiting > most and total >= self.window:
            yield from self._sequence(self.window)
            total -= self.window

    def finish(self) -> Iterator[tuple]:
        """All that waits: full windows, then sequences of powers of two."""
        yield from self.full(0)
        total = sum(k * len(v) for k, v in self.pool.items())
        while total:
            part = 1 << (total.bit_length() - 1)
            yield from self._sequence(part)
            total -= part


def pack_documents(
    docs: DataFrame,
    vocab_path: str,
    window: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    pool: int = POOL,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers. ``sequence_id`` holds the
    task's number in its upper bits and counts sequences below, so it is unique.
    """
    docs = docs.select(id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def rows(pieces, id_type):
        for at in range(0, len(pieces), 20_000):
            doc, start, ids, tokens, sequence, offset = zip(*pieces[at : at + 20_000], strict=True)
            longs = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, id_type), longs(start), longs([len(i) for i in ids]),
                    pa.array([i.tobytes() for i in ids], pa.binary()), longs(tokens), longs(sequence), longs(offset),
                ],
                names=names,
            )

    def run(batches):
        enc = encoder(vocab_path)
        packer, id_type = Packer(window, TaskContext.get().partitionId() << 40), None
        for b in batches:
            names_of, texts, id_type = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(0).type
            for i, j in chunks(texts):
                ids, counts = enc.encode(texts[i:j])
                ids, pieces = ids.astype("<u4"), []
                edges = np.concatenate(([0], np.cumsum(counts))).tolist()
                end = np.array([end_id], dtype="<u4")
                for k in range(i, j):
                    pieces += packer.add(names_of[k], np.concatenate((ids[edges[k - i] : edges[k - i + 1]], end)))
                pieces += packer.full(pool)
                yield from rows(pieces, id_type)
        if id_type is not None:
            yield from rows(list(packer.finish()), id_type)

    schema = f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.mapInArrow(run, schema)


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the ids' CRC-32 in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
