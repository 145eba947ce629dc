"""Conversation structure repair (operator 11): the cheapest edits that give well-formed roles.

A repaired conversation is empty, or an optional system row and then user and assistant in
turn. Every row is kept, given another role or deleted; rows without text may be inserted
anywhere. The first fault of a row counts: ``blank`` (white space only), ``duplicate`` (role
and text stood earlier in the conversation), ``truncated`` (no ``.``, ``!`` or ``?`` at its
end). Blank and duplicate rows must go. The cheapest edits win; of equally cheap ones the
string of their initials that is least in ASCII.

Method: Viterbi over the four states of the role pattern, with survivor coalescence.

* The survivors (one per state) are the leaves of a back-pointer tree whose nodes count
  their children. A node without children goes at once; as soon as all survivors descend
  from one child of the root, that child's edit is emitted and it becomes the root. What is
  held is the part of the conversation on which the survivors still differ.
* A survivor goes when another one, with whatever it would have to pay more for any possible
  rest (``Repair.regret``), is still strictly cheaper; ties always stay.
* Equally cheap survivors are compared by their whole unresolved edits. No edit string of
  one is the beginning of another's, so their order never changes later: it is kept as a
  rank, from which the next row's order follows. A tie so costs no walk back.

A conversation is cut into segments by turn, each a task's work, so that one may hold any
share of the rows: for each state at its beginning, a segment's summary has the cost and the
order of the best edits for each state at its end; the summaries of a conversation (a few
numbers each) are chained by the same coalescing search, which gives each segment the states
it begins and ends with. Conversations of one segment need neither. Rows of one turn, or
without a turn, stand in one segment. Duplicates are found by grouping digests, not by a
memory of what was seen.

Defined cases: nulls of role and text count as one space; rows are in the order of their
turn, nulls first, rows of one turn in the order of role and digest; rows with a null id are
one conversation; repeated rows are duplicates; other columns are not read; an empty table
gives no rows. Costs must be whole numbers, that of an insertion above 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import join_hot

START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role's initial leads from each state, and the states in which a conversation may end.
MOVES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ENDS = (START, ASSISTANT)
WHITE = " \t\n\x0b\f\r"
SEGMENT = 4096  # turns of a segment
FLUSH_ROWS, FLUSH_CHARS = 4096, 1 << 21

Kind = tuple[bool, str, bool]  # must go, initial of the role, truncated
Shape = tuple[tuple[int, int], ...]  # state and relative cost of each survivor, in the order of their edits


def _inserted(state: int) -> list[tuple[int, int]]:
    """The states that insertions lead to, and the fewest insertions for each."""
    out, at = {state: 0}, state
    while True:
        at = next(MOVES[at][x] for x in "ua" if x in MOVES[at])
        if at in out:
            return list(out.items())
        out[at] = len(out)


@dataclass
class Repair:
    """The costs of the edits, and the search's steps, which are computed once and remembered."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5
    _moves: dict = field(default_factory=dict, repr=False)
    _steps: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        if self.insert <= 0:
            raise ValueError("the cost of an insertion must be above 0")
        self.regret = self._regret()

    def _regret(self) -> list[list[int]]:
        """``[t][s]``: the most that a survivor in ``t`` may have to pay more than one in ``s``, for any rest."""
        skip = max(0, self.delete - min(self.keep, self.rerole))
        out = [[0] * 4 for _ in range(4)]
        while True:
            new = [[0] * 4 for _ in range(4)]
            for t in range(4):
                for s in range(4):
                    need = [min(k * self.insert for q, k in _inserted(t) if q in ENDS)] if s in ENDS else [0]
                    for x, then in MOVES[s].items():
                        same = [k * self.insert + out[MOVES[q][x]][then] for q, k in _inserted(t) if x in MOVES[q]]
                        need.append(min([*same, skip + out[t][then]]))
                    new[t][s] = 0 if s == t else max(need)
            if new == out:
                return out
            out = new

    def edit_cost(self, edit: str, truncated: bool) -> int:
        base = {"K": self.keep, "R": self.rerole, "D": self.delete, "I": self.insert}[edit]
        return base + (self.truncated if truncated and edit in "KR" else 0)

    def moves(self, kind: Kind) -> list[dict[int, tuple[int, str]]]:
        """From each state to each other: the cheapest (then least) edits that take in one row."""
        if kind not in self._moves:
            must, initial, truncated = kind
            table = []
            for state in range(4):
                best: dict[int, tuple[int, str]] = {}
                for q, k in _inserted(state):
                    found = [("D", q)]
                    if not must:
                        found += [("K", MOVES[q][x]) for x in MOVES[q] if x == initial]
                        found += [("R", MOVES[q][x]) for x in "ua" if x in MOVES[q]]
                    for edit, to in found:
                        own = (k * self.insert + self.edit_cost(edit, truncated), "I" * k + edit)
                        best[to] = min(best.get(to, own), own)
                table.append(best)
            self._moves[kind] = table
        return self._moves[kind]

    def survive(self, found: dict[int, tuple]) -> list[int]:
        """The states whose survivor stays, in the order of their edits. ``found``: state -> cost, then
        what orders the edits."""
        kept = [t for t, v in found.items() if all(o[0] + self.regret[q][t] >= v[0] for q, o in found.items())]
        return sorted(kept, key=lambda t: found[t][1:])

    def step(self, shape: Shape, kind: Kind) -> tuple[int, Shape, tuple[tuple[int, str], ...]]:
        """One row on: what the cheapest survivor paid, the new survivors, and for each the number of the
        one that it comes from and the edits added."""
        known = self._steps.get((shape, kind))
        if known is None:
            found: dict[int, tuple] = {}
            moves = self.moves(kind)
            for rank, (state, cost) in enumerate(shape):
                for to, (more, edits) in moves[state].items():
                    own = (cost + more, rank, edits)
                    found[to] = min(found.get(to, own), own)
            kept = self.survive(found)
            low = min(found[t][0] for t in kept)
            known = low, tuple((t, found[t][0] - low) for t in kept), tuple(found[t][1:] for t in kept)
            self._steps[shape, kind] = known
        return known

    def ending(self, shape: Shape) -> tuple[int, int]:
        """The survivor that ends best, by its number, and how many insertions follow it."""
        ways = [
            (cost + k * self.insert, rank, k)
            for rank, (state, cost) in enumerate(shape)
            for q, k in _inserted(state)
            if q in ENDS
        ]
        return min(ways)[1:]


class Tree:
    """Back pointers: nodes count their children, and what all survivors share is given out."""

    class Node:
        __slots__ = ("parent", "load", "children")

        def __init__(self, parent, load):
            self.parent, self.load, self.children = parent, load, []

    def __init__(self):
        self.root = self.Node(None, None)
        self.survivors = [self.root]

    def add(self, parent: Tree.Node, load) -> Tree.Node:
        node = self.Node(parent, load)
        parent.children.append(node)
        return node

    def settle(self, survivors: list[Tree.Node]) -> Iterator:
        """Takes the new survivors, drops what none of them descends from, and yields what they share."""
        kept = set(map(id, survivors))
        for node in self.survivors:
            while not node.children and id(node) not in kept and node.parent is not None:
                parent, node.parent = node.parent, None
                parent.children.remove(node)
                node = parent
        self.survivors = survivors
        while len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield self.root.load

    def path(self, node: Tree.Node) -> list:
        """What lies between the root and a survivor."""
        out = []
        while node is not self.root:
            out.append(node.load)
            node = node.parent
        return out[::-1]


class Segment:
    """The repair of a run of rows that come one by one. Yields ``edit, role, item, cost``; ``item`` is
    what was given with the row (``None`` for an insertion)."""

    def __init__(self, repair: Repair, entry: int = START, leave: int | None = None, last: bool = True):
        self.repair, self.leave, self.last = repair, leave, last
        self.tree, self.shape, self.state = Tree(), ((entry, 0),), entry

    def _out(self, load) -> tuple:
        edit, kind, item = load
        if edit == "D":
            role = None
        elif edit == "K":
            role, self.state = kind[1], MOVES[self.state][kind[1]]
        else:
            role = "assistant" if self.state == USER else "user"
            self.state = ASSISTANT if self.state == USER else USER
        return edit, role, item, self.repair.edit_cost(edit, bool(kind) and kind[2])

    def row(self, kind: Kind, item) -> Iterator[tuple]:
        _, self.shape, origins = self.repair.step(self.shape, kind)
        fresh = []
        for rank, edits in origins:
            node = self.tree.survivors[rank]
            for _ in edits[:-1]:
                node = self.tree.add(node, ("I", None, None))
            fresh.append(self.tree.add(node, (edits[-1], kind, item)))
        yield from map(self._out, self.tree.settle(fresh))

    def close(self) -> Iterator[tuple]:
        shape = self.shape
        if self.leave is not None:
            shape = tuple((s, c) if s == self.leave else (s, 1 << 62) for s, c in shape)
        rank, more = self.repair.ending(shape) if self.last else (min(range(len(shape)), key=lambda i: shape[i][1]), 0)
        yield from map(self._out, self.tree.path(self.tree.survivors[rank]))
        yield from (self._out(("I", None, None)) for _ in range(more))


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


# ---------------------------------------------------------------- the streams of rows
_ROW = ["conv_id", "segment", "turn", "kind", "role", "key", "blank", "truncated"]
_ORDER = ["conv_id", "segment", "turn", "kind", "role", "key"]
_BOUND, _MARK, _LINE = 0, 1, 2  # kinds of rows: a segment's states, a repeated row's digest, a row


def _read(batches, columns: list[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns), strict=True)


class _Faults:
    """The first fault of each row of a segment; marks of repeated rows come before their turn's rows."""

    def __init__(self):
        self.turn, self.marked, self.before = object(), set(), None

    def mark(self, turn, key) -> None:
        if turn != self.turn:
            self.turn, self.marked = turn, set()
        self.marked.add(key)

    def of(self, turn, key, blank, truncated) -> str | None:
        if turn != self.turn:
            self.turn, self.marked = turn, set()
        again = key in self.marked or (turn, key) == self.before
        self.before = (turn, key)
        return "blank" if blank else "duplicate" if again else "truncated" if truncated else None


def _kind(role: str, fault: str | None) -> Kind:
    return fault in ("blank", "duplicate"), _initial(role), fault == "truncated"


def _summaries(repair: Repair):
    """Per segment and state at its beginning: the states at its end in the order of their edits, with costs."""

    def run(batches):
        current = None
        for conv, segment, turn, kind, role, key, blank, truncated in _read(batches, _ROW):
            if current != (conv, segment):
                if current:
                    yield row(current, ways)
                current, faults = (conv, segment), _Faults()
                ways = [(0, ((entry, 0),)) for entry in range(4)]
            if kind == _MARK:
                faults.mark(turn, key)
                continue
            what = _kind(role, faults.of(turn, key, blank, truncated))
            for entry, (paid, shape) in enumerate(ways):
                low, shape, _ = repair.step(shape, what)
                ways[entry] = paid + low, shape
        if current:
            yield row(current, ways)

    def row(current, ways):
        found = [(e, t, paid + c) for e, (paid, shape) in enumerate(ways) for t, c in shape]
        entry, leave, cost = zip(*found, strict=True)
        return pa.RecordBatch.from_pydict(
            {"conv_id": pa.array([current[0]], pa.int64()), "segment": pa.array([current[1]], pa.int64()),
             "entry": [list(entry)], "leave": [list(leave)], "cost": [list(cost)]}
        )

    return run


def _chained(repair: Repair):
    """The states that each segment of a conversation begins and ends with."""

    def run(batches):
        names, out, late = ["conv_id", "segment", "entry", "leave", "cost"], [], None

        def flush(rows):
            conv, segment, entry, leave, last = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(segment, pa.int64()), pa.array(entry, pa.int32()),
                 pa.array(leave, pa.int32()), pa.array(last, pa.bool_())],
                names=["conv_id", "segment", "entry", "leave", "last"],
            )

        def put(loads):
            # a segment is given out when the next one is: only then is it known not to be the last
            nonlocal late
            for load in loads:
                if late is not None:
                    out.append((*late, False))
                late = load

        def close():
            nonlocal late
            put(tree.path(tree.survivors[repair.ending(shape)[0]]))
            out.append((*late, True))
            late = None

        current, tree = object(), None
        for conv, segment, entry, leave, cost in _read(batches, names):
            if conv != current:
                if tree:
                    close()
                current, tree, shape = conv, Tree(), ((START, 0),)
            found = {}
            for rank, (state, paid) in enumerate(shape):
                for place, (e, t, c) in enumerate(zip(entry, leave, cost, strict=True)):
                    own = (paid + c, rank, place)
                    if e == state:
                        found[t] = min(found.get(t, own), own)
            kept = repair.survive(found)
            low = min(found[t][0] for t in kept)
            fresh = [tree.add(tree.survivors[found[t][1]], (conv, segment, shape[found[t][1]][0], t)) for t in kept]
            shape = tuple((t, found[t][0] - low) for t in kept)
            put(tree.settle(fresh))
            if len(out) >= FLUSH_ROWS:
                yield flush(out)
                out.clear()
        if tree:
            close()
            yield flush(out)

    return run


_EDITS = (
    "conv_id long, segment long, n long, edit string, turn long, fault string, old_role string, role string, "
    "text string, cost long, whole boolean"
)
_EDIT_TYPES = [
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("n", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
    ("fault", pa.string()), ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string()),
    ("cost", pa.int64()), ("whole", pa.bool_()),
]


def _edits(repair: Repair):
    """The edits of every segment, in order."""

    def run(batches):
        out, held, current, chain, n = [], 0, None, None, 0

        def put(found):
            nonlocal held, n
            for edit, role, item, cost in found:
                turn, fault, old, text = item or (None, None, None, "")
                out.append((*current, n, edit, turn, fault, old, old if edit == "K" else role, text, cost, whole))
                held, n = held + len(text), n + 1

        def flush():
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, (_, t) in zip(columns, _EDIT_TYPES, strict=True)],
                names=[name for name, _ in _EDIT_TYPES],
            )

        columns = [*_ROW, "text", "entry", "leave", "last"]
        for conv, segment, turn, kind, role, key, blank, truncated, text, entry, leave, last in _read(batches, columns):
            if current != (conv, segment):
                if chain:
                    put(chain.close())
                current, n, faults = (conv, segment), 0, _Faults()
                whole = kind != _BOUND
                chain = Segment(repair) if whole else Segment(repair, entry, leave, last)
            if kind == _MARK:
                faults.mark(turn, key)
            elif kind == _LINE:
                fault = faults.of(turn, key, blank, truncated)
                put(chain.row(_kind(role, fault), (turn, fault, role, text)))
            if len(out) >= FLUSH_ROWS or held >= FLUSH_CHARS:
                yield flush()
                out.clear()
                held = 0
        if chain:
            put(chain.close())
        if out:
            yield flush()

    return run


def _rows(conversations: DataFrame, segment: int) -> DataFrame:
    """The rows with their segment, the digest of conversation, role and text, and what is wrong with the text."""
    turn = F.col("turn").cast("long")
    base = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(turn / F.lit(segment)).cast("long").alias("segment"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    content = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role"), "role", "text")
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    return base.withColumns(
        {
            "key": F.substring(F.unhex(F.sha2(content, 256)), 1, 16),
            "blank": end == "",
            "truncated": ~F.right(end, F.lit(1)).isin(".", "!", "?"),
            "kind": F.lit(_LINE),
        }
    )


def _least(column: str) -> Column:
    return F.min(F.struct(column))


def _marks(rows: DataFrame) -> DataFrame:
    """A row for each turn in which a row's role and text stand again after an earlier turn."""
    again = rows.groupBy("key").agg(_least("turn").alias("first"), F.max(F.struct("turn")).alias("_last"))
    again = again.where("first <> _last").drop("_last")
    seen = join_hot(rows.select("conv_id", "segment", "turn", "role", "key"), again, "key", "turn")
    later = seen.where(F.col("first").isNotNull() & (F.struct("turn") > F.col("first")))
    return later.drop("first").withColumn("kind", F.lit(_MARK))


def repair(conversations: DataFrame, costs: Repair | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per edit of every conversation, in order: ``conv_id, segment, n`` (its place), ``edit``
    (``K``eep, ``R``erole, ``D``elete, ``I``nsert), the row's ``turn, fault, old_role`` and ``text``, the new
    ``role`` (null if deleted), ``cost``, and whether the conversation is ``whole``, that is in one segment.

    Rows of a segment come one after another within a partition."""
    costs = costs or Repair()
    rows = _rows(conversations, segment)
    thin = rows.select(*_ROW)
    marks = _marks(rows)

    long = rows.groupBy("conv_id").agg(_least("segment").alias("_a"), F.max(F.struct("segment")).alias("_b"))
    long = long.where("_a <> _b").select(F.col("conv_id").alias("_conv"))
    parts = thin.unionByName(marks, allowMissingColumns=True)
    parts = parts.join(long, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    parts = parts.repartition("conv_id", "segment").sortWithinPartitions(*_ORDER)
    shape = "conv_id long, segment long, entry array<int>, leave array<int>, cost array<bigint>"
    sums = parts.select(*_ROW).mapInArrow(_summaries(costs), shape.replace("array<int>", "array<bigint>"))
    sums = sums.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    bounds = sums.mapInArrow(_chained(costs), "conv_id long, segment long, entry int, leave int, last boolean")
    bounds = bounds.withColumn("kind", F.lit(_BOUND))

    everything = rows.unionByName(marks, allowMissingColumns=True).unionByName(bounds, allowMissingColumns=True)
    dealt = everything.repartition("conv_id", "segment").sortWithinPartitions(*_ORDER)
    return dealt.select(*_ROW, "text", "entry", "leave", "last").mapInArrow(_edits(costs), _EDITS)


# ---------------------------------------------------------------- the query's damage and digests
def damage(conversations: DataFrame) -> DataFrame:
    """The rows with some dropped, emptied, cut, repeated or given another role, by a checksum of id and turn."""
    space = F.lit(" ")
    row = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    row = row.withColumn("_how", F.crc32(key) % 20).where("_how <> 0")
    text = F.when(F.col("_how") == 1, "").when(F.col("_how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_how") == 4, "user").otherwise(F.col("role"))
    row = row.select("conv_id", "turn", role.alias("role"), text.alias("text"), "_how")
    copies = F.when(F.col("_how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return row.withColumn("_copy", F.explode(copies)).drop("_copy", "_how")


_COUNTS = ["blank", "duplicate", "truncated"]
_PIECE = [
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("k", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("turns", pa.int64()), ("low", pa.int64()),
    ("high", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("audit", pa.string()), ("parts", pa.int64()),
    ("text", pa.string()), ("sha", pa.string()),
]
_LEGAL = ("su", "ua", "au")


class _Piece:
    """What is known of a stretch of edits; of a whole conversation also the digest, of others the text."""

    def __init__(self, conv, segment, k, whole):
        self.at, self.whole = (conv, segment, k), whole
        self.counts = dict.fromkeys([*_COUNTS, "illegal", "cost", "turns"], 0)
        self.low = self.high = self.first = self.last = None
        self.audit, self.lines, self.parts, self.chars = [], [], 0, 0
        self.hash = hashlib.sha256()

    def add(self, edit, turn, fault, old_role, role, text, cost):
        self.audit.append(edit)
        self.counts["cost"] += cost
        if fault:
            self.counts[fault] += 1
        if edit != "I":
            initial = old_role[:1]
            if self.first is None:
                self.first = initial
            else:
                self.counts["illegal"] += self.last + initial not in _LEGAL
            self.last = initial
            if turn is not None and turn != self.high:
                self.counts["turns"] += 1
                self.low, self.high = turn if self.low is None else self.low, turn
        if edit != "D":
            line = f"{role}:{text}"
            self.parts += 1
            if self.whole:
                self.hash.update((("\n" if self.parts > 1 else "") + line).encode())
            else:
                self.lines.append(line)
                self.chars += len(line)

    def row(self):
        c = self.counts
        text, sha = (None, self.hash.hexdigest()) if self.whole else ("\n".join(self.lines), None)
        return (*self.at, *(c[x] for x in _COUNTS), c["illegal"], c["cost"], c["turns"], self.low, self.high, self.first,
                self.last, "".join(self.audit), self.parts, text, sha)


def _batch(rows: list[tuple], types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], names=[n for n, _ in types]
    )


def _pieces(batches):
    columns = ["conv_id", "segment", "whole", "edit", "turn", "fault", "old_role", "role", "text", "cost"]
    current, piece, out, held = None, None, [], 0
    for conv, segment, whole, *edit in _read(batches, columns):
        if current != (conv, segment) or (not whole and piece.chars >= FLUSH_CHARS):
            if piece:
                out.append(piece.row())
                held += piece.chars
            k = piece.at[2] + 1 if current == (conv, segment) else 0
            after = piece.high if k else None
            current, piece = (conv, segment), _Piece(conv, segment, k, whole)
            piece.high = after  # a turn is counted once, in the piece where it begins
        piece.add(*edit)
        if len(out) >= FLUSH_ROWS or held >= FLUSH_CHARS:
            yield _batch(out, _PIECE)
            out, held = [], 0
    if piece:
        yield _batch([*out, piece.row()], _PIECE)


_DIGEST = [
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
]


def _joined(batches):
    """The pieces of a conversation, one after another, as one row."""
    out, current, total = [], object(), None

    def close():
        gaps = total["high"] - total["low"] + 1 - total["turns"] if total["low"] is not None else 0
        sha = total["sha"] or total["hash"].hexdigest()
        out.append((current, gaps, *(total[c] for c in _COUNTS), total["illegal"], total["cost"], "".join(total["audit"]), sha))

    for conv, _, _, *counts, illegal, cost, turns, low, high, first, last, audit, parts, text, sha in _read(
        batches, [n for n, _ in _PIECE]
    ):
        if conv != current:
            if total:
                close()
            current, total = conv, dict.fromkeys([*_COUNTS, "illegal", "cost", "turns", "parts"], 0)
            total |= {"low": None, "high": None, "last": None, "audit": [], "hash": hashlib.sha256(), "sha": None}
        for name, n in zip([*_COUNTS, "illegal", "cost", "turns"], [*counts, illegal, cost, turns], strict=True):
            total[name] += n
        if total["last"] is not None and first is not None:
            total["illegal"] += total["last"] + first not in _LEGAL
        total["last"] = total["last"] if last is None else last
        if low is not None:
            total["low"] = low if total["low"] is None else total["low"]
        total["high"] = high if high is not None else total["high"]
        total["audit"].append(audit)
        total["sha"] = sha
        if text is not None and parts:
            total["hash"].update((("\n" if total["parts"] else "") + text).encode())
        total["parts"] += parts
        if len(out) >= FLUSH_ROWS:
            yield _batch(out, _DIGEST)
            out.clear()
    if total:
        close()
        yield _batch(out, _DIGEST)


def digests(repaired: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per id of ``ids (conv_id)``: counts of faults, the audit of edits and the digest of the
    repaired rows. What is in one segment is digested where it lies; only a longer conversation's text moves."""
    kinds = {pa.int64(): "long", pa.string(): "string"}
    schema = lambda types: ", ".join(f"{n} {kinds[t]}" for n, t in types)
    pieces = repaired.mapInArrow(_pieces, schema(_PIECE))
    pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "k")
    found = pieces.mapInArrow(_joined, schema(_DIGEST)).withColumnRenamed("conv_id", "_id")
    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    numbers = {n: F.coalesce(F.col(n), F.lit(0).cast("long")) for n, t in _DIGEST[1:] if t == pa.int64()}
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.withColumns(
        numbers | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", empty)}
    )
