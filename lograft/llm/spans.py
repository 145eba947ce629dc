"""Text batches as numpy arrays: character classes, spans and 64-bit span hashes.

Several operators cut whole texts into words. Doing it per word in Python costs
more than the operators themselves, so a batch of texts is laid out as one array
of code points (texts separated by a surrogate, which no valid text holds), and
boundaries, classes and hashes are computed for the whole batch at once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

SEPARATOR = "\ud800"
SEPARATOR_CP = 0xD800
CHUNK_CHARS = 1 << 20

# Character classes.
LETTER, NUMBER, SPACE, OTHER, BREAK = 1, 2, 3, 4, 0

# White space as the Unicode property White_Space lists it (fixed values).
WHITE_SPACE = (
    [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letters (L*), numbers (N*), white space, others."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    major = {"L": LETTER, "N": NUMBER}
    for cp in range(0x110000):
        kind = major.get(unicodedata.category(chr(cp))[0])
        if kind:
            table[cp] = kind
    table[WHITE_SPACE] = SPACE
    table[0xD800:0xE000] = BREAK
    return table


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Simple lower-case mapping of every code point (itself where there is none of one character)."""
    table = np.arange(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        low = chr(cp).lower()
        if len(low) == 1:
            table[cp] = ord(low)
    return table


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, element by element (a public hash; fixed constants)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    return mix64(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BASE = 0x2545F4914F6CDD1B  # odd, so that it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_CHARS + 1024)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0][:n], _POWERS[1][:n]


class TextBatch:
    """A batch of texts as one array of code points (``cp``), its classes and hashes."""

    def __init__(self, texts: Sequence[str | None], marks: dict[str, str] | None = None, lower: bool = False):
        texts = [t or "" for t in texts]
        self.joined = SEPARATOR.join(texts)
        for found, mark in (marks or {}).items():
            if found in self.joined:
                self.joined = self.joined.replace(found, mark)
                texts = self.joined.split(SEPARATOR)
        self.cp = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if lower:
            self.cp = lower_table()[self.cp]
        self.classes = char_classes()[self.cp]
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        #: Where each text begins; the last entry is one past the end.
        self.begins = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.lengths = lengths

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """The number of the text that holds each position."""
        return np.searchsorted(self.begins, positions, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the spans; equal spans have equal hashes wherever they stand."""
        power, inverse = _powers(len(self.cp) + 1)
        sums = np.zeros(len(self.cp) + 1, dtype=np.uint64)
        np.cumsum(_codes()[self.cp] * power[: len(self.cp)], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * inverse[starts])

    def word_spans(self, kinds: tuple[int, ...] = (LETTER, NUMBER)) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of characters of the given classes."""
        inside = np.zeros(len(self.cp) + 2, dtype=np.int8)
        inside[1:-1] = np.isin(self.classes, kinds) if len(kinds) > 1 else self.classes == kinds[0]
        change = np.diff(inside)
        return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def chunks(texts: Sequence[str | None], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to ``most`` characters each (a longer text stands alone)."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(texts):
        yield begin, len(texts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of ``[start, start + length)`` for every row."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
