"""Hand-made edge lines for the parse expressions."""

import datetime as dt

from lograft.functions.parse import parse_lines, size_to_bytes
from lograft.operators import levels, timeline
from pyspark.sql import functions as F

LINES = [
    "17/03/29 10:04:41 INFO A: application_1485248649253_0052 and application_1485248649253_0053",
    "17/03/29  10:04:42 WARN B: application_1485248649253_0052",
    "17/13/45 10:04:43 ERROR X: application_1485248649253_0052",
    "  at java.lang INFORMATION none",
    "x 17/03/29 10:04:44 DEBUG mid application_1485248649253_0052",
    "17/03/29 10:04:45 INFO a.B: saw ERROR in text",
    "",
]


def _parsed(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(LINES)], "event_id bigint, line string")
    return parse_lines(df)


def test_levels_and_times(spark):
    rows = {r["event_id"]: r for r in _parsed(spark).collect()}
    assert rows[0]["log_level"] == "INFO"
    assert rows[0]["application_id"] == "application_1485248649253_0052"  # first app wins
    assert rows[0]["cluster_id"] == "1485248649253"
    assert rows[0]["event_time"] == dt.datetime(2017, 3, 29, 10, 4, 41)
    assert rows[1]["log_level"] == "WARN" and rows[1]["event_time"] is None  # double space
    assert rows[2]["log_level"] == "ERROR" and rows[2]["event_time"] is None  # month 13
    assert rows[3]["log_level"] == "" and rows[3]["level_loose"] == "INFO"
    assert rows[4]["ts_head"] == "" and rows[4]["event_time"] == dt.datetime(2017, 3, 29, 10, 4, 44)
    assert rows[5]["log_level"] == "INFO" and rows[5]["component"] == "a.B"
    assert rows[6]["log_level"] == "" and rows[6]["event_time"] is None


def test_token_counts_and_timeline(spark):
    p = _parsed(spark)
    tokens = {r["level"]: r["count"] for r in levels.level_token_counts(p).collect()}
    assert tokens == {"INFO": 3, "WARN": 1, "ERROR": 2, "DEBUG": 1}
    counts = {r["log_level"]: r["count"] for r in levels.level_counts(p).collect()}
    assert counts == {"INFO": 2, "WARN": 1, "ERROR": 1, "DEBUG": 1}
    tl = timeline.app_timeline(p).collect()
    assert len(tl) == 1
    assert tl[0]["start_time"] == dt.datetime(2017, 3, 29, 10, 4, 41)
    assert tl[0]["end_time"] == dt.datetime(2017, 3, 29, 10, 4, 44)
    assert tl[0]["app_number"] == "0052"


def test_size_to_bytes(spark):
    df = spark.createDataFrame([("4.0", "MB"), ("2.5", "GB"), ("512", "B"), ("1.5", "KB"), ("x", "MB")], "n string, u string")
    got = [r[0] for r in df.select(size_to_bytes(F.col("n"), F.col("u"))).collect()]
    assert got == [4.0 * 1024**2, 2.5 * 1024**3, 512.0, 1536.0, None]


def test_unfinished_anti_equals_grouped(spark):
    from conftest import SF001
    from lograft.operators import messages
    from lograft.plans.catalog import parsed

    events = messages.task_events(parsed(spark, SF001))
    a = sorted(messages.unfinished_tasks(events).collect())
    keys, valid = ["application_id", "tid"], events.filter("application_id <> '' AND tid IS NOT NULL")
    starts = valid.filter("kind = 'running'").groupBy(*keys).agg(F.min("stage_id").alias("stage_id"), F.min("event_time").alias("start_time"))
    b = sorted(starts.join(valid.filter("kind = 'finished'").select(*keys), keys, "left_anti").collect())
    assert a == b and len(a) == 77


def test_histogram_log_scale(spark):
    from lograft.operators.distribution import histogram

    df = spark.createDataFrame([("c", float(x)) for x in [0, 1, 9, 99, 999, 9999]], "cluster_id string, x double")
    rows = histogram(df, bins=4, log_scale=True).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 1, 1, 2]
    assert abs(rows[0]["bin_lo"]) < 1e-9 and abs(rows[-1]["bin_hi"] - 9999) < 1e-6


def test_strict_parse_and_rand_sample(spark):
    import pytest
    from lograft.functions.parse import parse_log_time_strict

    ok = spark.createDataFrame([("24/01/05 10:00:00",)], "s string").select(parse_log_time_strict("s")).first()[0]
    assert ok == dt.datetime(2024, 1, 5, 10, 0, 0)
    with pytest.raises(Exception):
        spark.createDataFrame([("24/13/45 10:00:00",)], "s string").select(parse_log_time_strict("s")).collect()
    p = _parsed(spark)
    s = levels.sample_lines(p, 3, "7", method="rand").collect()
    assert len(s) == 3 and all(r["log_level"] != "" for r in s)
