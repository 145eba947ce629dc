"""Conversation repair and chat formatting against plain-Python models."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from lograft.llm import chat_format, conversation_repair as cr
from lograft.llm.queries import op11_conversation_repair, op12_chat_format, vocabulary_path

SCHEMA = "conv_id long, turn long, role string, text string, audit string, ids int, kind string"
WHITE = " \t\n\x0b\f\r"
ROLES = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """The first fault of each row ``(role, text)``."""
    seen, out = set(), []
    for role, text in rows:
        rest = text.strip(WHITE)
        out.append("blank" if not rest else "duplicate" if (role, text) in seen else
                   "truncated" if rest[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, costs=None):
    """Cost, audit and repaired rows, by comparing whole edit strings in every state."""
    costs = costs or cr.Repair()
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def inserted(states):
        for _ in range(3):
            for s, (c, audit, out) in list(states.items()):
                for x in "ua":
                    if x in after[s]:
                        own = (c + costs.insert, audit + "I", (*out, ("user" if x == "u" else "assistant", "")))
                        to = after[s][x]
                        states[to] = min(states.get(to, own), own, key=lambda v: v[:2])
        return states

    states = inserted({"": (0, "", ())})
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        new = {}

        def put(s, own):
            new[s] = min(new.get(s, own), own, key=lambda v: v[:2])

        for s, (c, audit, out) in states.items():
            put(s, (c + costs.delete, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = costs.truncated if fault == "truncated" else 0
            if role[:1] in after[s]:
                put(after[s][role[:1]], (c + costs.keep + more, audit + "K", (*out, (role, text))))
            for x, name in (("u", "user"), ("a", "assistant")):
                if x in after[s]:
                    put(after[s][x], (c + costs.rerole + more, audit + "R", (*out, (name, text))))
        states = inserted(new)
    return min((states[s] for s in ("", "a") if s in states), key=lambda v: v[:2])


def exhaustive(rows, costs):
    """The same by trying every edit string."""
    best = None
    after = faults(rows)
    for edits in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            cost, audit, roles, ok = 0, "", [], True
            for i in range(len(rows) + 1):
                audit += "I" * gaps[i]
                roles += ["?"] * gaps[i]
                cost += costs.insert * gaps[i]
                if i == len(rows):
                    break
                audit += edits[i]
                bad = after[i] in ("blank", "duplicate")
                if edits[i] == "D":
                    cost += costs.delete
                    continue
                ok = ok and not bad
                cost += (costs.keep if edits[i] == "K" else costs.rerole) + costs.truncated * (after[i] == "truncated")
                roles.append(rows[i][0][:1] if edits[i] == "K" else "?")
            if not ok or (best and (cost, audit) >= best):
                continue
            for start in ("", "s"):
                rest = len(roles) - len(start)
                wanted = start + "ua" * (rest // 2)
                if (rest > 0 or not start) and rest % 2 == 0 and all(r == w or (r == "?" and w in "ua") for r, w in zip(roles, wanted, strict=True)):
                    best = (cost, audit)
    return best


def repaired_by_operator(rows, costs, tree=None):
    chain = cr.Segment(costs)
    out, held = [], 0
    for (role, text), fault in zip(rows, faults(rows), strict=True):
        out += chain.row(cr._kind(role, fault), (role, text))
        held = max(held, sum(1 for n in chain.tree.survivors for _ in chain.tree.path(n)))
    out += chain.close()
    texts = tuple((i[0] if e == "K" else r, i[1] if i else "") for e, r, i, _ in out if e != "D")
    return sum(c for *_, c in out), "".join(e for e, *_ in out), texts, held


def made_up(rnd, n, roles=("user", "assistant", "system", "tool", "")):
    return [(rnd.choice(roles), rnd.choice(["a.", "b!", "c?", "d", "", " \n", "e.", "f.", "g. "]) + rnd.choice(["", "", "x."])) for _ in range(n)]


@pytest.mark.parametrize("costs", [cr.Repair(), cr.Repair(insert=1), cr.Repair(rerole=3, insert=2, truncated=1), cr.Repair(keep=1, delete=4)])
def test_search_equals_whole_strings_and_all_edits(costs):
    rnd = random.Random(4)
    for k in range(400):
        rows = made_up(rnd, rnd.randint(0, 14), ("user", "assistant", "system") if k % 2 else ("user", "tool", "assistant", ""))
        want = cheapest(rows, costs)
        assert repaired_by_operator(rows, costs)[:3] == want
        assert ROLES.fullmatch("".join(r[:1] for r, _ in want[2]))
    for _ in range(25):
        rows = made_up(rnd, rnd.randint(0, 4))
        assert cheapest(rows, costs)[:2] == exhaustive(rows, costs)


def test_memory_is_bounded_by_what_is_undecided():
    rows = [("user" if k % 2 == 0 else "assistant", f"turn {k}.") for k in range(5000)]
    rows[2000:2003] = [("tool", "x1."), ("user", ""), ("user", "x2")]
    cost, audit, _, held = repaired_by_operator(rows, cr.Repair())
    assert (cost, audit) == cheapest(rows)[:2] and held < 40
    tied = [("tool", f"t{k}.") for k in range(301)]  # every place of the one deletion costs the same
    cost, audit, _, held = repaired_by_operator(tied, cr.Repair())
    assert (cost, audit) == (302, "D" + "R" * 300) == cheapest(tied)[:2]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        how = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out += [(conv, turn, role, text)] * (2 if how == 3 else 1)
    return out


def model(rows):
    """What the query returns, from plain Python (rows of a turn in any order that is the operator's)."""
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r)
    out = set()
    for conv, own in groups.items():
        def order(r):
            content = ":".join(["" if r[0] is None else str(r[0]), str(len(r[2])), r[2], r[3]])
            return r[1] is not None, r[1] or 0, r[2], hashlib.sha256(content.encode()).digest()[:16]

        own = [(t, r, x) for _, t, r, x in sorted(own, key=order)]
        pairs = [(r, x) for _, r, x in own]
        found = faults(pairs)
        turns = {t for t, _, _ in own if t is not None}
        cost, audit, texts = cheapest(pairs)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:], strict=False))
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in texts).encode()).hexdigest()
        out.add((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"),
                 found.count("duplicate"), found.count("truncated"), illegal, cost, audit, sha))
    return out


def digested(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    got = cr.digests(cr.repair(cr.damage(frame), **options), frame)
    return got, {tuple(r) for r in got.collect()}


def made_up_table(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        turn = rnd.randint(-3, 2)
        for role, text in made_up(rnd, rnd.randint(0, 12)):
            rows.append((conv, turn, role, text))
            turn += rnd.choice([0, 1, 1, 1, 2, 9])
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (700, None, "user", None), (700, None, None, "z."),
             (701, 2, "user", "q" * 200_000 + "."), (701, 3, "assistant", "r."), (702, 1, "user", "same."),
             (702, 1, "user", "same."), (702, 5, "user", "same."), (702, 9, "user", "same."), (703, 20, "user", "gone.")]
    return rows


@pytest.mark.parametrize("segment", [cr.SEGMENT, 3, 1])
def test_table_equals_model(spark, segment):
    """With segments of a few turns most conversations are chained from several of them."""
    rows = made_up_table(7)
    frame, got = digested(spark, rows, segment=segment)
    assert got == model(rows) and len(got) == len({r[0] for r in rows})
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert all(t == "bigint" for c, t in frame.dtypes if c not in ("audit", "repaired_sha256"))


def test_long_conversation_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(cr, "FLUSH_CHARS", 64)
    monkeypatch.setattr(cr, "FLUSH_ROWS", 3)
    rnd = random.Random(2)
    rows = [(5, t // 2, *x) for t, x in enumerate(made_up(rnd, 300))] + [(6, 1, "user", "hm.")]
    for segment in (10_000, 7):
        assert digested(spark, rows, segment=segment)[1] == model(rows)


def test_repair_query_equals_model(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in op11_conversation_repair(spark, SF001).collect()]
    assert set(got) == model(rows) and len(got) == len(model(rows))


def test_repair_gives_edits_and_no_rows_for_none(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "assistant", "c.")]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = cr.repair(frame).orderBy("n").collect()
    assert [(r["edit"], r["turn"], r["fault"], r["role"], r["text"]) for r in got] == [
        ("K", 0, None, "user", "a."), ("D", 1, "truncated", None, "b"), ("K", 2, None, "assistant", "c.")]
    assert cr.repair(frame.limit(0)).count() == 0
    assert cr.digests(cr.repair(cr.damage(frame.limit(0))), frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        cr.Repair(insert=0)


# ---------------------------------------------------------------- formatting
def chat_model(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in groups.items():
        turns = [(r, x) for *_, r, x in sorted(own)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


HARD = ["", "</s>", "<\\/s>", "<\\\\\\/s> [INST][/INST] [\\/INST]", "<</s>s>", "[[INST]", "<s></s", "\\", "<|endoftext|> x <\\|endoftext|>",
        "a\r\n\t b 　\U0001F600‍", "[ROLE]user[/ROLE]", "</s>[INST] ok [/INST]", " lead and trail ", "\x00\x01", "日本語 — ß"]


def test_escapes_are_reversible_and_hide_every_mark():
    vocabulary = ["<|endoftext|>"]
    e = chat_format.Escapes([*chat_format.MARKS, *vocabulary])
    rnd = random.Random(1)
    for k in range(3000):
        text = "".join(rnd.choice([*chat_format.MARKS, *vocabulary, "\\", "<", "[", "/s>", "INST]", "a"]) for _ in range(rnd.randint(0, 8)))
        hidden = e.escape(text)
        assert e.unescape(hidden) == text
        assert not any(m in hidden for m in [*chat_format.MARKS, *vocabulary])
    with pytest.raises(ValueError):
        chat_format.Escapes(["<a>", "[<b]"])


def test_formatting_reads_back(spark):
    rnd = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "</s>", "as\nsistant"]
    rows = [(c, rnd.choice([None, 0, 1, 2, 3]), rnd.choice(roles), rnd.choice([*HARD, None])) for c in range(40) for _ in range(rnd.randint(1, 9))]
    rows += [(None, 1, "user", "x"), (50, 1, "assistant", "y" * 300_000), (51, 1, "user", "z"), (51, 1, "user", "z")]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    made = chat_format.format_turns(frame, vocabulary_path())
    got = chat_format.digests(made, vocabulary_path())
    assert {r["conv_id"]: tuple(r)[1:5] for r in got.collect()} == chat_model(rows)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(vocabulary_path())
    size = tokens.get_vocab_size()
    for r in made.limit(200).collect():
        assert len(r["ids"]) == len(r["loss_mask"])
        text = "".join(chat_format.MARKS[i - size] if i >= size else "\x00" for i in r["ids"] if i >= size)
        assert text in ("[INST][/INST]", "[ANS]</s>", "<sys></sys>", "[ROLE][/ROLE]</s>")
        assert all(i != tokens.token_to_id("<|endoftext|>") for i in r["ids"])
        parts, run = [], []
        for i in r["ids"]:
            if i >= size:
                parts += [tokens.decode(run, skip_special_tokens=False), chat_format.MARKS[i - size]]
                run = []
            else:
                run.append(i)
        assert "".join(parts) == r["formatted"]
        assert all(m == 0 for i, m in zip(r["ids"], r["loss_mask"], strict=True) if i >= size)
    assert chat_format.format_turns(frame.limit(0), vocabulary_path()).count() == 0
    read = chat_format.read_turns(made.where("conv_id = 51"), vocabulary_path())
    assert [(r["role"], r["text"], r["loss"]) for r in read.collect()] == [("user", "z", "")] * 2


def test_turns_of_one_conversation_spread_over_tasks(spark):
    """Formatting moves no row; order is kept from one partition to the next, also inside one conversation."""
    rows = [(9, k * 7 % 500, ("user", "assistant")[k % 2], f"turn {k} </s>") for k in range(500)]
    rows += [(c, t, "user", "hm") for c in (None, 3) for t in (None, 2, 1)]
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)
    made = chat_format.format_turns(frame, vocabulary_path())
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # that of the test's own rows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would be one partition
    try:
        ordered = chat_format.in_order(made).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    place = [(r["conv_id"] is not None, r["conv_id"] or 0, r["turn"] is not None, r["turn"] or 0, r["role"]) for r in ordered]
    assert place == sorted(place) and len(place) == len(rows)
    assert len({r["part"] for r in ordered if r["conv_id"] == 9}) > 1
    got = chat_format.digests(made, vocabulary_path()).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == chat_model(rows)


def test_format_query_equals_model(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", chat_format.CONTROL), (-7, 1, "assistant", chat_format.CONTROL)]
    got = op12_chat_format(spark, SF001).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == chat_model(rows) and len(got) == len(chat_model(rows))
    assert all(r["formatted_chars"] > 0 for r in got)
