"""Task retries, cached memory and overlap partners against plain-Python models."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from conftest import SF0001

from lograft.functions.parse import parse_lines, with_identity
from lograft.operators import memory, messages, timeline

START = dt.datetime(2017, 3, 29, 10, 0, 0)


def line(second, text):
    return f"{START + dt.timedelta(seconds=second):%y/%m/%d %H:%M:%S} INFO {text}"


def retry_lines(seed):
    """Lines of tasks tried up to four times; finish lines go missing, times tie and run backwards."""
    rnd = random.Random(seed)
    lines, tries, tid = [], [], 0
    for app in ("01", "02"):
        for stage in range(3):
            for stage_attempt in range(rnd.randint(1, 2)):
                for index in range(4):
                    second = rnd.randint(0, 50)
                    for attempt in range(rnd.choice([1, 1, 2, 3, 4])):
                        tid += 1
                        second += rnd.choice([0, 0, 5, 17, -3])
                        done = rnd.random() < 0.4
                        text = f"task {index}.{attempt} in stage {stage}.{stage_attempt} (TID {tid})"
                        head = f"logs/application_1_0001/container_1_0001_{app}_000002.log"
                        lines.append((head, line(second, f"executor.Executor: Running {text}")))
                        if done:
                            lines.append((head, line(second + 2, f"executor.Executor: Finished {text}. 10 bytes result sent to driver")))
                        tries.append(((app, stage, stage_attempt, index), attempt, second, tid, done))
    rnd.shuffle(lines)
    return lines, tries


@pytest.mark.parametrize("seed", [1, 2])
def test_retries_equal_model(spark, seed):
    lines, tries = retry_lines(seed)
    rows = with_identity(parse_lines(spark.createDataFrame(lines, "path string, line string").repartition(3)))
    chains = defaultdict(list)
    for task, *rest in tries:
        chains[task].append(tuple(rest))
    want = set()
    for task, chain in chains.items():
        chain.sort()
        if len(chain) < 2:
            continue
        done = [k for k, (*_, ok) in enumerate(chain) if ok]
        lost = sum(max(0, chain[k + 1][1] - chain[k][1]) for k in range(min(done[0] if done else len(chain), len(chain) - 1)))
        want.add((*task, len(chain), len(done), chain[-1][0], chain[done[0]][0] if done else None, lost, bool(done) and done[0] > 0))
    got = messages.task_retries(messages.task_events(rows)).select(
        "attempt", "stage_id", "stage_attempt", "task_index", "num_attempts", "finished_attempts", "last_attempt",
        "succeeded_on", "lost_sec", "recovered")
    assert {tuple(r) for r in got.collect()} == want and any(w[-1] for w in want) and any(w[-2] for w in want)


def test_retries_take_one_exchange_and_one_match(spark):
    from lograft.plans.catalog import QUERIES

    for key in ("task_retries", "file_task_retries"):
        plan = QUERIES[key](spark, SF0001)._jdf.queryExecution()
        assert plan.executedPlan().toString().count("Exchange hashpartitioning") + plan.executedPlan().toString().count(
            "REPARTITION_BY_COL") // 2 <= 2
        assert plan.optimizedPlan().toString().count("regexp_replace(") == 1


def stored(second, host, block, size):
    return line(second, f"storage.BlockManagerInfo: Added {block} in memory on {host}:52848 (size: {size}, free: 2.5 GB)")


def test_cached_bytes_equal_model(spark):
    rnd = random.Random(5)
    units = {"B": 1, "KB": 1024, "MB": 1024**2}
    rows, state, want, peaks = [], {}, {}, {}
    for n in range(400):
        second = n // 3 * rnd.choice([1, 1, 1]) + 3000 * (n // 100)
        app, host = f"application_9_000{rnd.randint(1, 2)}", f"node-{min(2, rnd.randint(0, 9))}"
        block, number, unit = f"rdd_1_{rnd.randint(0, 5)}", rnd.choice(["1.5", "4.0", "0.1"]), rnd.choice([*units])
        rows.append((n, stored(second, host, block, f"{number} {unit}") + f" for {app}"))
    rows.append((400, "24/13/45 10:00:00 INFO storage.BlockManagerInfo: Added rdd_9_9 in memory on node-0:1 (size: 1.0 MB, free: 2.5 GB)"))
    for n, text in rows[:-1]:
        app, host = text.split(" for ")[1], text.split(" on ")[1].split(":")[0]
        block = text.split("Added ")[1].split(" ")[0]
        number, unit = text.split("size: ")[1].split(",")[0].split()
        state.setdefault(host, {})[app, block] = round(float(number) * units[unit])
        want[n] = sum(state[host].values())
        when = START + dt.timedelta(seconds=int((dt.datetime.strptime(text[:17], "%y/%m/%d %H:%M:%S") - START).total_seconds()))
        if host not in peaks or want[n] > peaks[host][0]:
            peaks[host] = (want[n], when)
    frame = parse_lines(spark.createDataFrame(rows, "event_id long, line string").repartition(4))
    cached = memory.cached_over_time(memory.block_changes(frame))
    assert {r["event_id"]: r["cached_bytes"] for r in cached.collect()} == want
    got = {r["host"]: r for r in memory.cache_peaks(cached).collect()}
    assert {h: (r["peak_bytes"], r["peak_at"]) for h, r in got.items()} == peaks
    assert sum(r["num_stored"] for r in got.values()) == 400
    kept = sum(map(len, state.values()))
    assert sum(r["num_replaced"] for r in got.values()) == 400 - kept
    assert {h: r["last_bytes"] for h, r in got.items()} == {h: sum(b.values()) for h, b in state.items()}


def test_hit_share(spark):
    rows = [(1, line(1, "storage.BlockManager: Found block rdd_2_7 locally"))] * 3
    size = "(estimated size 1.0 KB, free 2.5 GB)"
    rows += [(2, line(2, f"storage.MemoryStore: Block rdd_2_1 stored as bytes in memory {size}")),
             (3, line(2, f"storage.MemoryStore: Block rdd_3_1 stored as values in memory {size}")),
             (4, line(2, f"storage.MemoryStore: Block broadcast_1 stored as bytes in memory {size}")),
             (5, line(2, "storage.MemoryStore: Block rdd_3_1 dropped"))]
    got = memory.hit_share(parse_lines(spark.createDataFrame(rows, "event_id long, line string")))
    assert {tuple(r) for r in got.collect()} == {(2, 3, 1, 0.75), (3, 0, 1, 0.0)}


def overlaps(rows):
    out = {}
    for c, a, s, e in rows:
        best = min(
            ((-(min(e, f) - max(s, t)), -f, b) for d, b, t, f in rows if d == c and b != a and t <= e and s <= f), default=None
        )
        out[c, a] = (best[2], -best[0]) if best else (None, None)
    return out


@pytest.mark.parametrize(("seed", "span", "widths"), [(1, 12, timeline.SECONDS), (2, 400, {"_a": 7, "_b": 60}), (3, 100_000, timeline.SECONDS)])
def test_longest_overlap_equals_brute_force(spark, seed, span, widths):
    """One cluster holds most applications; many ties of starts, ends and durations."""
    rnd = random.Random(seed)
    rows = []
    for k in range(220):
        s = rnd.randint(0, span)
        rows.append((rnd.choice(["hot", "hot", "hot", "b", "c"]), f"application_{k:04d}", s, s + rnd.choice([0, 1, 3, rnd.randint(0, span)])))
    rows.append(("alone", "application_9999", 5, 9))
    at = lambda n: START + dt.timedelta(seconds=n)
    frame = spark.createDataFrame([(c, a, at(s), at(e)) for c, a, s, e in rows],
                                  "cluster_id string, application_id string, start_time timestamp_ntz, end_time timestamp_ntz")
    got = {(r["cluster_id"], r["application_id"]): (r["partner_id"], r["overlap_sec"]) for r in timeline.longest_overlap(frame, widths).collect()}
    assert got == overlaps(rows)
    assert timeline.longest_overlap(frame.limit(0), widths).count() == 0


def test_longest_overlap_makes_no_pairs(spark):
    """A thousand applications that all overlap give points in proportion, not their pairs."""
    plans = []
    rows = [("hot", f"application_{k:05d}", START + dt.timedelta(seconds=k), START + dt.timedelta(seconds=5000 + k)) for k in range(1000)]
    frame = spark.createDataFrame(rows, "cluster_id string, application_id string, start_time timestamp_ntz, end_time timestamp_ntz")
    found = timeline.longest_overlap(frame)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    got = {r["application_id"]: (r["partner_id"], r["overlap_sec"]) for r in found.collect()}
    assert got["application_00000"] == ("application_00001", 4999) and got["application_00500"] == ("application_00501", 4999)
    assert all("NestedLoop" not in p and "Cartesian" not in p for p in plans)
