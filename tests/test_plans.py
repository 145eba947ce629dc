"""End-to-end report jobs and the streaming variant."""

import os
import tempfile

from lograft.plans.catalog import lines as event_lines
from lograft.plans.daily_report import run_daily_report
from lograft.plans.level_report import run_level_report
from lograft.plans.usage_report import run_usage_report
from lograft.operators.daily import trips_from_lineitem
from lograft.sources.tables import table
from lograft.streaming.logs import log_line_stream, start_to_table, streaming_level_counts

from conftest import SF0001, SF001


def _out():
    return tempfile.mkdtemp(prefix="lograft-report-", dir="/tmp")


def test_level_report(spark):
    out = _out()
    res = run_level_report(spark, event_lines(spark, SF001), out)
    assert res["total_lines"] == 10000 and res["lines_with_level"] == 9000
    assert sum(c for _, c in res["counts"]) == 9000
    assert "Unique log levels found: 4" in res["summary"]
    sample = spark.read.option("header", True).csv(os.path.join(out, "level_sample.csv"))
    assert sample.count() == 10 and sample.columns == ["log_entry", "log_level"]
    text = spark.read.text(os.path.join(out, "level_summary.txt")).collect()
    assert text[0][0].startswith("Total log lines processed: 10,000")


def test_usage_report(spark):
    out = _out()
    res = run_usage_report(spark, event_lines(spark, SF001), out)
    assert res["total_clusters"] == 6 and res["total_applications"] == 150
    assert abs(res["avg_apps_per_cluster"] - 25.0) < 1e-12
    hist = spark.read.option("header", True).option("inferSchema", True).csv(os.path.join(out, "duration_histogram.csv"))
    assert hist.count() == 30 and sum(r["count"] for r in hist.collect()) == 25


def test_daily_report(spark):
    out = _out()
    trips = trips_from_lineitem(table(spark, SF001, "lineitem"))
    res = run_daily_report(spark, trips, 1996, out)
    assert res["days"] == 366 and str(res["first_day"]) == "1996-01-01"
    exact = run_daily_report(spark, trips, 1996, _out(), exact_p95=True)
    assert exact["total_trips"] == res["total_trips"]


def test_streaming_level_counts(spark):
    src = tempfile.mkdtemp(prefix="lograft-stream-src-", dir="/tmp")
    lines = event_lines(spark, SF0001)
    lines.select("line").write.mode("overwrite").text(os.path.join(src, "application_x"))
    stream = log_line_stream(spark, src, glob="part-*")
    q = start_to_table(streaming_level_counts(stream), "level_counts_stream", tempfile.mkdtemp(prefix="lograft-ckpt-", dir="/tmp"))
    q.awaitTermination(120)
    got = {r["log_level"]: r["count"] for r in spark.sql("SELECT * FROM level_counts_stream").collect()}
    from lograft.operators.levels import level_counts
    from lograft.functions.parse import parse_lines

    want = {r["log_level"]: r["count"] for r in level_counts(parse_lines(lines)).collect()}
    assert got == want


def test_streaming_timeline(spark):
    from lograft.functions.parse import parse_lines
    from lograft.operators.timeline import app_timeline
    from lograft.streaming.logs import streaming_timeline

    src = tempfile.mkdtemp(prefix="lograft-stream-src-", dir="/tmp")
    lines = event_lines(spark, SF0001)
    lines.select("line").write.mode("overwrite").text(os.path.join(src, "batch1"))
    stream = log_line_stream(spark, src, glob="part-*")
    q = start_to_table(streaming_timeline(stream), "timeline_stream",
                       tempfile.mkdtemp(prefix="lograft-ckpt-", dir="/tmp"), mode="complete")
    q.awaitTermination(120)
    got = sorted(spark.sql("SELECT cluster_id, application_id, start_time, end_time FROM timeline_stream").collect())
    want = sorted(app_timeline(parse_lines(lines)).select("cluster_id", "application_id", "start_time", "end_time").collect())
    assert got == want and len(got) > 0


def test_streaming_to_parquet(spark):
    from lograft.streaming.logs import read_newest, start_to_parquet

    src = tempfile.mkdtemp(prefix="lograft-stream-src-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="lograft-stream-out-", dir="/tmp")
    lines = event_lines(spark, SF0001)
    lines.select("line").write.mode("overwrite").text(os.path.join(src, "b1"))
    q = start_to_parquet(streaming_level_counts(log_line_stream(spark, src, glob="part-*")),
                         os.path.join(out, "levels"), os.path.join(out, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = {r["log_level"]: r["count"] for r in read_newest(spark, os.path.join(out, "levels")).collect()}
    assert sum(got.values()) == 900 and set(got) == {"INFO", "WARN", "ERROR", "DEBUG"}
    # a later result without rows is the newest one
    spark.range(0).selectExpr("'x' AS log_level", "id AS count").coalesce(1).write.parquet(os.path.join(out, "levels", "batch=99"))
    assert read_newest(spark, os.path.join(out, "levels")).count() == 0


def test_empty_input(spark):
    from lograft.functions.parse import parse_lines
    from lograft.operators import timeline

    empty = spark.createDataFrame([], "event_id bigint, line string")
    stats = timeline.cluster_stats(timeline.cluster_summary(timeline.app_timeline(parse_lines(empty)))).first()
    assert (stats["total_clusters"], stats["total_applications"], stats["avg_apps_per_cluster"]) == (0, 0, 0.0)
    res = run_level_report(spark, empty.select("line"), _out())
    assert res["total_lines"] == 0 and res["counts"] == []
    assert "Unique log levels found: 0" in res["summary"]


def test_queries_see_new_rows(spark):
    """Nothing is kept between queries: twice the events, twice the lines; and nothing is left behind."""
    from lograft.plans.catalog import QUERIES

    root = tempfile.mkdtemp(prefix="lograft-twice-", dir="/tmp")
    events = spark.read.parquet(f"{SF0001}/events.parquet")
    events.write.parquet(f"{root}/events.parquet")
    once = QUERIES["level_totals"](spark, root).first()["total_lines"]
    events.write.mode("append").parquet(f"{root}/events.parquet")
    assert QUERIES["level_totals"](spark, root).first()["total_lines"] == 2 * once
    assert os.listdir(root) == ["events.parquet"]


def test_streaming_sessions_match_batch(spark):
    import datetime as dt

    from lograft.streaming.logs import app_sessions, streaming_app_sessions

    src = tempfile.mkdtemp(prefix="lograft-stream-src-", dir="/tmp")
    lines = event_lines(spark, SF0001)
    lines.select("line").write.mode("overwrite").text(os.path.join(src, "b1"))
    stream = log_line_stream(spark, src, glob="part-*")
    q = start_to_table(streaming_app_sessions(stream, "6 hours", "1 hour"), "sessions_stream",
                       tempfile.mkdtemp(prefix="lograft-ckpt-", dir="/tmp"), mode="append")
    q.awaitTermination(120)
    cols = ["cluster_id", "application_id", "start_time", "end_time", "lines"]
    got = set(spark.sql("SELECT * FROM sessions_stream").select(*cols).collect())
    want = set(app_sessions(lines, "6 hours").select(*cols).collect())
    newest = max(r["end_time"] for r in want)
    # a session is emitted (and its state dropped) once the watermark passes its end
    closed = {r for r in want if r["end_time"] + dt.timedelta(hours=7) <= newest}
    assert closed and closed <= got <= want
