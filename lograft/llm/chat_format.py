"""Chat formatting (operator 12): turns as token ids with reserved marks and a loss mask.

The template puts marks around a turn's text (``TEMPLATE``): ``[INST]`` text ``[/INST]`` for a
user, ``[ANS]`` text ``</s>`` for an assistant, ``<sys>`` text ``</sys>`` for a system row, and
``[ROLE]`` role ``[/ROLE]`` text ``</s>`` for any other role. A conversation is its turns, one
after another.

Method: token-level assembly.

* A mark is one reserved id above the vocabulary, never the ids of its characters. Texts are
  encoded separately, all segments of a batch at once, and the reserved ids are spliced in
  between: where each id goes follows from prefix sums of the segments' lengths.
* The loss mask covers the ids of assistant texts, without marks: +1 where one begins, -1
  where it ends, and the prefix sum of that.
* A text may hold a mark's characters. So that the formatted string can be told apart too, each
  such place gets a backslash after its first character (``</s>`` becomes ``<\\/s>``), and a
  place that has backslashes there already one more; reading takes one away. ``<`` and ``[``
  stand only at the beginning of marks, so places don't overlap and the way back is exact. The
  vocabulary's own special tokens count as control strings too: a text never gives their ids.

Ids and mask are lists per turn, so that a conversation of any length is never one row, and a
turn is formatted where its row lies: one conversation may hold any share of all turns.
``in_order`` puts the turns in order over all partitions, again without one task per
conversation. ``read_turns`` gets roles, texts and the text under the mask back from ids and
mask alone. Only the query's digests need a conversation's turns in one task, since SHA-256 has
no way to be merged: there they pass as a sorted stream, of which nothing is held.

Defined cases: a null text or role is empty; turns are in the order of ``turn``, nulls first,
those of one turn in the order of role and text (``in_order``: of role and formatted string);
repeated rows are turns of their own; rows with a null id are one conversation; other columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.llm.bpe import encoder
from lograft.llm.spans import chunks, ragged

MARKS = ("[INST]", "[/INST]", "[ANS]", "</s>", "<sys>", "</sys>", "[ROLE]", "[/ROLE]", "<s>")
#: The marks before and after a text, by role; of other roles the role itself stands in a segment of its own.
TEMPLATE = {"user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>"), "system": ("<sys>", "</sys>")}
OTHER = ("[ROLE]", "[/ROLE]", "</s>")
LEARNED = "assistant"


class Escapes:
    """A backslash after the first character of each control string in a text, and back."""

    def __init__(self, controls: Iterable[str] = MARKS):
        controls = sorted(set(controls))
        firsts = {c[0] for c in controls}
        if any(x in firsts or x == "\\" for c in controls for x in c[1:]):
            raise ValueError("control strings must not hold a backslash, nor the first character of one further on")
        ways = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in controls)
        self.place, self.firsts = re.compile(ways), firsts

    def escape(self, text: str) -> str:
        if not any(x in text for x in self.firsts):
            return text
        return self.place.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        if "\\" not in text:
            return text
        return self.place.sub(lambda m: m[0][0] + m[0][1:].removeprefix("\\"), text)


def _segments(role: str, text: str, escape) -> list[tuple[str, bool]]:
    """The marks and texts of a turn, in order: ``(text, False)`` or ``(mark, True)``."""
    if role in TEMPLATE:
        before, after = TEMPLATE[role]
        return [(before, True), (escape(text), False), (after, True)]
    return [(OTHER[0], True), (escape(role), False), (OTHER[1], True), (escape(text), False), (OTHER[2], True)]


class Assembler:
    """Turns as ids and masks, and back, for a vocabulary file."""

    def __init__(self, path: str):
        self.encoder = encoder(path)
        self.first = len(self.encoder.vocab.byte_lengths)  # the first id that the vocabulary leaves free
        self.number = {m: self.first + k for k, m in enumerate(MARKS)}
        self.escapes = Escapes([*MARKS, *self.encoder.vocab.special])

    def assemble(self, roles: Sequence[str], texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Ids and mask of all turns, one after another, how many each turn has, and the formatted strings."""
        pieces, turn_of, learned, strings = [], [], [], []
        for k, (role, text) in enumerate(zip(roles, texts, strict=True)):
            own = _segments(role, text, self.escapes.escape)
            strings.append("".join(s for s, _ in own))
            pieces += own
            turn_of += [k] * len(own)
            learned += [role == LEARNED and not mark for _, mark in own]
        is_mark = np.array([mark for _, mark in pieces], dtype=bool)
        content, counts = self.encoder.encode([s for s, mark in pieces if not mark])
        lengths = np.ones(len(pieces), dtype=np.int64)
        lengths[~is_mark] = counts
        ends = np.cumsum(lengths)
        starts = ends - lengths
        ids = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
        ids[starts[is_mark]] = [self.number[s] for s, mark in pieces if mark]
        ids[ragged(starts[~is_mark], lengths[~is_mark])] = content
        step = np.zeros(len(ids) + 1, dtype=np.int64)
        taught = np.array(learned, dtype=bool)
        np.add.at(step, starts[taught], 1)
        np.add.at(step, ends[taught], -1)
        mask = np.cumsum(step)[:-1].astype(np.int8)
        per_turn = np.bincount(turn_of, weights=lengths, minlength=len(strings)).astype(np.int64)
        return ids, mask, per_turn, strings

    def read(self, ids: np.ndarray) -> list[tuple[str, str]]:
        """``role, text`` of every turn in a run of ids."""
        at = np.flatnonzero(ids >= self.first)
        texts = self._between(ids, at)
        marks = [MARKS[i - self.first] for i in ids[at].tolist()]
        role_of = {before: role for role, (before, _) in TEMPLATE.items()}
        out, i = [], 0
        while i < len(marks):
            if marks[i] == OTHER[0]:
                out.append((texts[i], texts[i + 1]))
                i += 3
            else:
                out.append((role_of[marks[i]], texts[i]))
                i += 2
        return out

    def masked(self, ids: np.ndarray, mask: np.ndarray) -> list[str]:
        """The texts under a mask: each run of it by itself."""
        edges = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0])).astype(np.int64)))
        starts, ends = edges[::2], edges[1::2]
        return self._decoded(ids, starts, ends)

    def _between(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        return self._decoded(ids, at + 1, np.concatenate((at[1:], [len(ids)])))

    def _decoded(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        counts = ends - starts
        return [self.escapes.unescape(t) for t in self.encoder.decode(ids[ragged(starts, counts)].astype(np.int64), counts)]


_TURN = "conv_id long, turn long, role string, ids array<int>, loss_mask array<tinyint>, formatted string"


def format_turns(conversations: DataFrame, vocab_path: str) -> DataFrame:
    """``conv_id, turn, role, ids, loss_mask, formatted``: one row per turn, where it lies. A conversation's
    example is the concatenation of its turns in their order."""
    empty = F.lit("")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )

    def run(batches):
        maker = Assembler(vocab_path)
        for b in batches:
            roles, texts = b.column("role").to_pylist(), b.column("text").to_pylist()
            for i, j in chunks(texts):
                ids, mask, counts, strings = maker.assemble(roles[i:j], texts[i:j])
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c)[i:j] for c in ("conv_id", "turn", "role")),
                     pa.ListArray.from_arrays(offsets, pa.array(ids)),
                     pa.ListArray.from_arrays(offsets, pa.array(mask)), pa.array(strings, pa.string())],
                    names=["conv_id", "turn", "role", "ids", "loss_mask", "formatted"],
                )

    return rows.mapInArrow(run, _TURN)


def in_order(formatted: DataFrame) -> DataFrame:
    """The formatted turns in order, within partitions and from one to the next. Ranges are cut between
    turns as well as between conversations, so that a long conversation spreads over several tasks."""
    place = ["conv_id", "turn", "role", "formatted"]
    return formatted.repartitionByRange(*place).sortWithinPartitions(*place)


_READ = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("loss", pa.string()),
         ("chars", pa.int64())]


def _read_batch(maker: Assembler, b: pa.RecordBatch) -> Iterator[tuple]:
    """Each row of formatted turns as it is read back; a row is one turn."""
    ids, mask = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "loss_mask"))
    counts = np.diff(b.column("ids").offsets.to_numpy()).tolist()
    turns = maker.read(ids)
    loss = iter(maker.masked(ids, mask))
    at = 0
    places = zip(b.column("conv_id").to_pylist(), b.column("turn").to_pylist(), strict=True)
    for (conv, turn), n, (role, text), formatted in zip(places, counts, turns, b.column("formatted").to_pylist(), strict=True):
        yield conv, turn, role, text, next(loss) if mask[at : at + n].any() else "", len(formatted)
        at += n


def read_turns(formatted: DataFrame, vocab_path: str) -> DataFrame:
    """``conv_id, turn, role, text, loss, chars`` of every formatted turn, from its ids and mask: ``loss`` is
    the text under the mask, ``chars`` the length of the formatted string."""

    def run(batches):
        maker = Assembler(vocab_path)
        for b in batches:
            columns = list(zip(*_read_batch(maker, b), strict=True)) or [()] * len(_READ)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, _READ, strict=True)], names=[n for n, _ in _READ]
            )

    needed = formatted.select("conv_id", "turn", "ids", "loss_mask", "formatted")
    return needed.mapInArrow(run, "conv_id long, turn long, role string, text string, loss string, chars long")


# ---------------------------------------------------------------- the query's digests
CONTROL = "</s>[INST] ok [/INST]"


def with_control(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, both of whose turns say what the template's marks say."""
    own = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string")
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"]
    return conversations.select(*columns).unionByName(own)


def digests(formatted: DataFrame, vocab_path: str) -> DataFrame:
    """One row per conversation of ``format_turns``: what is read back from its ids and mask, as digests.

    Turns are formatted and read back where they lie; what was read is dealt out by conversation, once,
    and hashed in order. A conversation's state is two running digests and three counts."""
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [k.split()[0] for k in kinds.split(", ")]
    same = F.col("loss") == F.col("text")  # then the text need not be sent twice
    turns = read_turns(formatted, vocab_path).select(
        "conv_id", "turn", "role", "text", F.when(~same, F.col("loss")).alias("loss"), "chars"
    )

    def row(conv, state):
        n, turns, chars, loss, length = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length

    def batch(rows):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches):
        current, state, out = None, None, []
        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss", "chars"))
            for conv, role, text, loss, chars in zip(*columns, strict=True):
                if state is None or conv != current:
                    if state:
                        out.append(row(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                loss = text if loss is None else loss
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += chars
            if out:
                yield batch(out)
                out = []
        if state:
            yield batch([*out, row(current, state)])

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, kinds)
