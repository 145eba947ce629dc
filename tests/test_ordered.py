"""Skew-safe ordered helpers and the exact percentile against brute force."""

import math
import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lograft.operators.ordered import previous_row, running_total
from lograft.operators.quantiles import exact_percentile


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 5)}"
        out.append((key, i, rnd.randint(0, 400), rnd.randint(-5, 5)))
    return out


def test_running_total_equals_window(spark):
    df = spark.createDataFrame(_rows(), "k string, id bigint, t int, v int").withColumn("b", F.floor(F.col("t") / 37))
    got = running_total(df, ["k"], [F.col("t"), F.col("id")], "b", "v", "rs")
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("rs", F.sum("v").over(w))
    assert sorted(got.select("id", "rs").collect()) == sorted(want.select("id", "rs").collect())
    gmax = running_total(df, ["k"], [F.col("t"), F.col("id")], "b", "v", "rm", how="max")
    wmax = df.withColumn("rm", F.max("v").over(w))
    assert sorted(gmax.select("id", "rm").collect()) == sorted(wmax.select("id", "rm").collect())


def test_previous_row_equals_lag(spark):
    df = spark.createDataFrame(_rows(), "k string, id bigint, t int, v int").withColumn("b", F.floor(F.col("t") / 50))
    got = previous_row(df, ["k"], ["t", "id"], "b", ["id", "v"])
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.withColumn("prev_id", F.lag("id").over(w)).withColumn("prev_v", F.lag("v").over(w))
    cols = ["id", "prev_id", "prev_v"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def _nearest_rank(values, p):
    vals = sorted(values)
    k = max(1, min(len(vals), math.ceil(p * len(vals))))
    return vals[k - 1]


def test_exact_percentile_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for g in range(12):
        n = rnd.choice([1, 2, 3, 10, 57, 400, 2500])
        kind = g % 4
        for _ in range(n):
            if kind == 0:
                x = rnd.gauss(0, 1e6)
            elif kind == 1:
                x = float(rnd.randint(0, 5))  # heavy ties
            elif kind == 2:
                x = 42.0  # constant group
            else:
                x = math.exp(rnd.uniform(0, 30))  # heavy tail
            rows.append((f"g{g}", x))
    rows.append(("g0", None))
    df = spark.createDataFrame(rows, "g string, x double")
    pdf = pd.DataFrame(rows, columns=["g", "x"]).dropna()
    for p in (0.5, 0.95, 0.99, 0.0, 1.0):
        got = {r["g"]: r["q"] for r in exact_percentile(df, ["g"], "x", p, "q").collect()}
        narrow = {r["g"]: r["q"] for r in exact_percentile(df, ["g"], "x", p, "q", accuracy=50, band=0.001).collect()}
        assert narrow == got
        want = {g: _nearest_rank(s.tolist(), p) for g, s in pdf.groupby("g")["x"]}
        assert got == want, p
    # Spark's own exact percentile_disc agrees
    disc = df.groupBy("g").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY x)").alias("q"))
    ours = exact_percentile(df, ["g"], "x", 0.95, "q")
    assert sorted(disc.collect()) == sorted(ours.collect())


def test_timeline_sweeps_with_hour_buckets(spark):
    """Finer buckets give the same answers as day buckets."""
    from conftest import SF001
    from lograft.operators import timeline
    from lograft.plans.catalog import _timeline

    tl = _timeline(spark, SF001)
    for fn in (timeline.app_gaps, timeline.peak_concurrency, timeline.app_overlap_counts):
        assert sorted(fn(tl, {"_h": "hour"}).collect()) == sorted(fn(tl).collect())


def test_exact_percentile_extra_aggregates(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None), ("b", None)], "g string, x double"
    )
    got = {r["g"]: r for r in exact_percentile(df, ["g"], "x", 0.5, "q", extra=[F.count(F.lit(1)).alias("rows")]).collect()}
    assert got["a"]["q"] == 2.0 and got["a"]["rows"] == 3
    assert got["b"]["q"] is None and got["b"]["rows"] == 2


def test_exact_percentile_null_groups_and_hard_values(spark):
    """NULL keys are groups; equal values, infinities, NaN and huge ranges end; any sketch error is made up for."""
    inf, nan = float("inf"), float("nan")
    values = {None: list(range(20)), "same": [7.0] * 50, "wide": [-1e308, 0.0, 1e308, 5e-324], "inf": [-inf, 1.0, inf, 2.0],
              "nan": [nan, 1.0, 2.0], "one": [3.0]}
    df = spark.createDataFrame([(k, i % 2, float(x)) for k, own in values.items() for i, x in enumerate(own)], "g string, z int, x double")
    for p in (0.0, 0.3, 0.5, 0.95, 1.0):
        for accuracy in (10000, 1):
            got = {r["g"]: r["q"] for r in exact_percentile(df, ["g"], "x", p, "q", accuracy=accuracy).collect()}
            for k, own in values.items():
                want = sorted(own, key=lambda v: (v != v, v))[max(0, -(-int(round(p * 1000)) * len(own) // 1000) - 1)]
                assert got[k] == want or (want != want and got[k] != got[k]), (k, p, got[k], want)
    extra = exact_percentile(df, ["g", "z"], "x", 0.5, "q", extra=[F.count(F.lit(1)).alias("n")]).filter("g IS NULL")
    assert {(r["z"], r["q"], r["n"]) for r in extra.collect()} == {(0, 8.0, 10), (1, 9.0, 10)}


def test_many_groups_join_without_broadcast(spark, monkeypatch):
    from lograft.operators import joins

    df = spark.createDataFrame([(i % 7, float(i)) for i in range(70)], "g int, x double")
    want = sorted(exact_percentile(df, ["g"], "x", 0.5, "q").collect())
    monkeypatch.setattr(joins, "BROADCAST_GROUPS", 3)
    assert sorted(exact_percentile(df, ["g"], "x", 0.5, "q").collect()) == want


def test_bucketed_helpers_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(
        rows=st.lists(
            st.tuples(
                st.sampled_from(["hot", "hot", "hot", "a", None]),
                st.integers(0, 500) | st.none(),
                st.integers(-9, 9) | st.none(),
            ),
            min_size=1, max_size=300,
        ),
        width=st.integers(1, 60),
        depth=st.integers(1, 3),
    )
    def check(rows, width, depth):
        data = [(k, i, t, v) for i, (k, t, v) in enumerate(rows)]
        df = spark.createDataFrame(data, "k string, id bigint, t int, v int").withColumn(
            "b", F.floor(F.col("t") / width)
        ).withColumn("b2", F.floor(F.col("b") / 3)).withColumn("b3", F.floor(F.col("b2") / 2))
        levels = ["b", "b2", "b3"][:depth]
        w = Window.partitionBy("k").orderBy("t", "id")
        got = running_total(df, ["k"], [F.col("t"), F.col("id")], levels, "v", "rs")
        want = df.withColumn("rs", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        assert sorted(got.select("id", "rs").collect()) == sorted(want.select("id", "rs").collect())
        prev = previous_row(df, ["k"], ["t", "id"], levels, ["v"])
        lag = df.withColumn("prev_v", F.lag("v").over(w))
        assert sorted(prev.select("id", "prev_v").collect()) == sorted(lag.select("id", "prev_v").collect())

    check()


def test_cluster_rank_with_ties(spark):
    from lograft.operators.timeline import cluster_rank

    counts = [5, 9, 9, 1, 5, 5, 12]
    summary = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(counts)], "cluster_id string, num_applications bigint")
    got = {r["cluster_id"]: r["usage_rank"] for r in cluster_rank(summary).collect()}
    want = {f"c{i}": 1 + sum(1 for m in counts if m > n) for i, n in enumerate(counts)}
    assert got == want


def test_sweeps_match_brute_force(spark):
    """Overlap counts and peak concurrency on random closed intervals with many
    same-instant starts and ends, against brute force."""
    import datetime as dt

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from lograft.operators.timeline import app_overlap_counts, peak_concurrency

    base = dt.datetime(2024, 1, 1)

    @settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(
        st.lists(
            st.tuples(st.sampled_from(["c1", "c1", "c2"]), st.integers(0, 40), st.integers(0, 12)),
            min_size=1, max_size=60,
        )
    )
    def check(spans):
        rows = [(c, f"app_{i:03d}", base + dt.timedelta(hours=s), base + dt.timedelta(hours=s + d))
                for i, (c, s, d) in enumerate(spans)]
        tl = spark.createDataFrame(rows, "cluster_id string, application_id string, start_time timestamp_ntz, end_time timestamp_ntz")
        got = {r["application_id"]: r["overlapping_apps"] for r in app_overlap_counts(tl, {"_h": "hour"}).collect()}
        want = {
            a: sum(1 for c2, b, s2, e2 in rows if c2 == c and b != a and s2 <= e and s <= e2)
            for c, a, s, e in rows
        }
        assert got == want
        peaks = {r["cluster_id"]: (r["peak_concurrency"], r["peak_at"]) for r in peak_concurrency(tl, {"_h": "hour", "_d": "day"}).collect()}
        for c in {r[0] for r in rows}:
            mine = [(s, e) for c2, _, s, e in rows if c2 == c]
            times = sorted({t for se in mine for t in se})
            live = {t: sum(1 for s, e in mine if s <= t <= e) for t in times}
            best = max(live.values())
            assert peaks[c] == (best, min(t for t in times if live[t] == best))

    check()


def test_multiline_entries_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from lograft.functions.parse import parse_lines
    from lograft.operators.multiline import assemble_entries

    @settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(
        files=st.lists(st.lists(st.booleans(), min_size=1, max_size=40), min_size=1, max_size=3),
        bucket=st.integers(1, 7),
    )
    def check(files, bucket):
        rows = []
        for f, flags in enumerate(files):
            for n, is_header in enumerate(flags):
                text = f"24/01/05 10:00:{n % 60:02d} INFO f{f} line {n}" if is_header else f"    at frame {f}.{n}"
                rows.append((f"file{f}", n, text))
        df = spark.createDataFrame(rows, "path string, line_no bigint, line string")
        got = sorted(
            (r["path"], r["entry_id"], r["n_lines"], r["text"])
            for r in assemble_entries(parse_lines(df), ["path"], "line_no", bucket_rows=bucket).collect()
        )
        want = []
        for f, flags in enumerate(files):
            groups, cur = [], None
            for n, is_header in enumerate(flags):
                if is_header or cur is None:
                    cur = [n]
                    groups.append(cur)
                else:
                    cur.append(n)
            texts = {n: t for p, n, t in rows if p == f"file{f}"}
            want += [(f"file{f}", g[0], len(g), "\n".join(texts[n] for n in g)) for g in groups]
        assert got == sorted(want)

    check()
