"""Text sources on real nested directories, file identity, multi-line entries, sinks."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from lograft.functions.parse import parse_lines
from lograft.operators import levels, multiline, timeline
from lograft.sinks import write_csv, write_single_csv
from lograft.sources import check_path, list_files, read_log_lines, read_ordered_lines, with_file_identity
from lograft.sources.tables import TIMELINE_SCHEMA, csv_with_schema

APP1 = "application_1485248649253_0001"
APP2 = "application_1472621869829_0002"

FILES = {
    f"{APP1}/container_1485248649253_0001_01_000001.log": [
        "17/01/24 17:00:28 INFO ApplicationMaster: Registered signal handlers",
        "17/01/24 17:00:30 ERROR ApplicationMaster: boom",
        "java.lang.RuntimeException: boom",
        "    at a.b(C.java:1)",
        "17/01/24 17:01:00 INFO ApplicationMaster: done",
    ],
    f"{APP1}/container_1485248649253_0001_01_000002.log": [
        "17/01/24 17:00:40 INFO executor.Executor: Running task 0.0 in stage 0.0 (TID 0)",
        "17/01/24 17:00:45 INFO executor.Executor: Finished task 0.0 in stage 0.0 (TID 0). 2213 bytes result sent to driver",
    ],
    f"{APP2}/container_1472621869829_0002_01_000001.log": [
        "    orphan continuation line",
        "16/09/09 07:43:47 WARN YarnAllocator: something",
    ],
}


@pytest.fixture(scope="module")
def logdir():
    root = tempfile.mkdtemp(prefix="lograft-logs-", dir="/tmp")
    for rel, lines in FILES.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
    with open(os.path.join(root, "README.txt"), "w") as fh:
        fh.write("not a log\n")
    return root


def test_recursive_read(spark, logdir):
    lines = read_log_lines(spark, logdir)
    assert lines.count() == sum(len(v) for v in FILES.values())
    assert read_log_lines(spark, logdir, glob=None).count() == sum(len(v) for v in FILES.values()) + 1


def test_file_identity(spark, logdir):
    df = with_file_identity(read_log_lines(spark, logdir, with_path=True))
    ids = {(r["file_application_id"], r["container_number"], r["container_role"]) for r in df.collect()}
    assert (APP1, "000001", "AM") in ids and (APP1, "000002", "EXECUTOR") in ids and (APP2, "000001", "AM") in ids
    tl = {r["application_id"]: r for r in timeline.timeline_by_file(parse_lines(df)).collect()}
    assert set(tl) == {APP1, APP2}
    assert str(tl[APP1]["end_time"]) == "2017-01-24 17:01:00"
    files = {r["application_id"]: r["num_files"] for r in timeline.app_file_counts(df, None).collect()}
    assert files == {APP1: 2, APP2: 1}


def test_numbered_lines_and_entries(spark, logdir):
    numbered = read_ordered_lines(spark, logdir)
    assert numbered.count() == sum(len(v) for v in FILES.values())
    entries = multiline.assemble_entries(parse_lines(numbered), keys=["path"], order_col="line_no", bucket_rows=2)
    rows = entries.collect()
    assert len(rows) == 3 + 2 + 2
    boom = [r for r in rows if "boom" in r["text"] and r["log_level"] == "ERROR"][0]
    assert boom["n_lines"] == 3 and boom["text"].endswith("at a.b(C.java:1)")
    orphan = [r for r in rows if r["text"].startswith("    orphan")][0]
    assert orphan["n_lines"] == 1 and orphan["entry_id"] == 0


def test_listing_and_diagnostics(spark, logdir):
    files = list_files(spark, logdir, "*.log").collect()
    assert len(files) == 3 and all(r["length"] > 0 for r in files)
    assert check_path(spark, logdir)["files"] == 4
    missing = check_path(spark, os.path.join(logdir, "nope"))
    assert missing["exists"] is False and missing["error"]


def test_csv_round_trip_and_error_lines(spark, logdir):
    out = tempfile.mkdtemp(prefix="lograft-out-", dir="/tmp")
    tl = timeline.app_timeline(parse_lines(read_log_lines(spark, logdir))).select(
        "cluster_id", "application_id", "start_time", "end_time"
    )
    write_single_csv(tl, os.path.join(out, "timeline"), ["cluster_id"], timestamp_format="yyyy-MM-dd HH:mm:ss")
    assert len([f for f in os.listdir(os.path.join(out, "timeline")) if f.endswith(".csv")]) == 1
    back = csv_with_schema(spark, os.path.join(out, "timeline"), TIMELINE_SCHEMA, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    assert sorted(back.collect()) == sorted(tl.collect())
    errors = levels.lines_containing(read_log_lines(spark, logdir), "ERROR")
    write_csv(errors, os.path.join(out, "errors"))
    assert spark.read.option("header", "true").csv(os.path.join(out, "errors")).count() == 1


def test_inventory_and_single_app(spark, logdir):
    from lograft.operators.levels import log_inventory, only_application

    df = with_file_identity(read_log_lines(spark, logdir, with_path=True))
    inv = log_inventory(df).first()
    assert (inv["applications"], inv["log_files"], inv["lines"]) == (2, 3, 9)
    approx = log_inventory(df, approximate=True).first()
    assert (approx["applications"], approx["log_files"]) == (2, 3)
    assert only_application(df, APP2, "file_application_id").count() == 2


def test_parquet_set_and_range(spark):
    from lograft.sources.tables import id_range, month_paths, parquet_set

    paths = month_paths("/root/testdata", [(0, 1)], "{root}/sf0.001/orders.parquet")
    assert parquet_set(spark, paths * 2).count() == 2 * spark.read.parquet(paths[0]).count()
    assert parquet_set(spark, paths, ignore_missing=True).count() > 0
    df = id_range(spark, 1000)
    assert df.filter(df.id % 2 == 0).select((df.id * 2).alias("x")).count() == 500


def test_glob_read_and_partition_pruning(spark, logdir):
    from lograft.sources import read_log_glob
    from lograft.sources.tables import partitioned_parquet

    assert read_log_glob(spark, os.path.join(logdir, "application_*/*.log")).count() == 9
    out = tempfile.mkdtemp(prefix="lograft-part-", dir="/tmp")
    spark.range(100).selectExpr("id", "IF(id < 40, 2021, 2022) AS yyyy").write.partitionBy("yyyy").parquet(
        os.path.join(out, "t")
    )
    df = partitioned_parquet(spark, os.path.join(out, "t"))
    q = df.filter(F.col("yyyy") == 2021)
    assert q.count() == 40
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan and "(yyyy" in plan
    only = partitioned_parquet(spark, os.path.join(out, "t"), "yyyy=2022/*.parquet")
    assert only.count() == 60 and "yyyy" in only.columns


def test_ordered_lines_match_whole_file_numbering(spark):
    from lograft.sources import read_ordered_lines

    logdir = tempfile.mkdtemp(prefix="lograft-biglog-", dir="/tmp")
    for rel, lines in FILES.items():
        os.makedirs(os.path.dirname(os.path.join(logdir, rel)), exist_ok=True)
        with open(os.path.join(logdir, rel), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    big = os.path.join(logdir, "application_1485248649253_0003")
    os.makedirs(big, exist_ok=True)
    with open(os.path.join(big, "container_1485248649253_0003_01_000002.log"), "w") as fh:
        for i in range(5000):
            fh.write(f"17/01/24 17:{i // 60 % 60:02d}:{i % 60:02d} INFO X: line {i}\n" if i % 7 else f"    at frame({i})\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits per file
    try:
        ordered = read_ordered_lines(spark, logdir)
        want = []
        for folder, _, names in os.walk(logdir):
            for name in names:
                if name.endswith(".log"):
                    with open(os.path.join(folder, name)) as fh:
                        want += [(name, i, line.rstrip("\n")) for i, line in enumerate(fh)]
        got = [(os.path.basename(r["path"]), r["line_no"], r["line"]) for r in ordered.collect()]
        assert sorted(got) == sorted(want)
        n_splits = spark.read.text(big).select("_metadata.file_block_start").distinct().count()
        assert n_splits > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_text_tree_matches_catalog(spark):
    """The same lines read back from a nested log tree give the same answers."""
    from conftest import SF0001
    from lograft.plans.catalog import lines as event_lines
    from lograft.plans.catalog import parsed as event_parsed

    rows = event_lines(spark, SF0001).orderBy("event_id").collect()
    root = tempfile.mkdtemp(prefix="lograft-tree-", dir="/tmp")
    by_app = {}
    for r in rows:
        m = re.search(r"application_(\d+_\d+)", r["line"])
        app = f"application_{m.group(1) if m else '1485248649253_9999'}"
        by_app.setdefault(app, []).append(r["line"])
    for app, lines in by_app.items():
        d = os.path.join(root, app)
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"container_{app[len('application_'):]}_01_000001.log"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    from_files = parse_lines(read_log_lines(spark, root))
    assert sorted(levels.level_counts(from_files).collect()) == sorted(levels.level_counts(event_parsed(spark, SF0001)).collect())
    assert sorted(timeline.app_timeline(from_files).collect()) == sorted(
        timeline.app_timeline(event_parsed(spark, SF0001)).collect()
    )


def test_usage_report_by_file(spark, logdir):
    from lograft.plans.usage_report import run_usage_report

    out = tempfile.mkdtemp(prefix="lograft-usage-file-", dir="/tmp")
    res = run_usage_report(spark, read_log_lines(spark, logdir, with_path=True), out, identity="file")
    assert res["total_applications"] == 2 and res["total_clusters"] == 2


def test_extractors_take_the_application_from_the_path(spark):
    """Documented lines name no application; their file's path does, and tells attempts apart."""
    from lograft.functions.parse import with_identity
    from lograft.operators import messages

    root = tempfile.mkdtemp(prefix="lograft-app-", dir="/tmp")
    app = "application_1485248649253_0052"
    for attempt, seconds in (("01", 5), ("02", 7)):
        folder = os.path.join(root, app)
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, f"container_1485248649253_0052_{attempt}_000002.log"), "w") as fh:
            fh.write("17/03/29 10:04:41 INFO executor.Executor: Running task 0.0 in stage 1.0 (TID 3)\n")
            fh.write(f"17/03/29 10:04:{41 + seconds} INFO executor.Executor: Finished task 0.0 in stage 1.0 (TID 3). 2087 bytes result sent to driver\n")
            fh.write("17/03/29 10:05:00 INFO python.PythonRunner: Times: total = 41, boot = 5, init = 35, finish = 1\n")
            fh.write("17/03/29 10:05:01 ERROR executor.Executor: Running task 1.0 in stage 1.0 (TID 4)\n")
    rows = with_identity(parse_lines(read_log_lines(spark, root, with_path=True)))
    tasks = messages.task_events(rows)
    done = sorted((r["application_id"], r["attempt"], r["tid"], r["duration_sec"], r["result_bytes"]) for r in messages.task_durations(tasks).collect())
    assert done == [(app, "01", 3, 5, 2087), (app, "02", 3, 7, 2087)]
    assert sorted((r["attempt"], r["tid"]) for r in messages.unfinished_tasks(tasks).collect()) == [("01", 4), ("02", 4)]
    rate = messages.error_rate(rows).first()
    assert (rate["application_id"], rate["level_lines"], rate["error_lines"]) == (app, 8, 2)
    times = messages.python_time_stats(messages.python_times(rows)).first()
    assert (times["application_id"], times["num_runs"], times["sum_total_ms"]) == (app, 2, 82)


def test_partition_pruning(spark):
    from lograft.sources.tables import partitioned_parquet

    root = os.path.join(tempfile.mkdtemp(prefix="lograft-parts-", dir="/tmp"), "trips")
    spark.range(20).selectExpr("id", "2020 + id % 3 AS yyyy").write.partitionBy("yyyy").parquet(root)
    found = partitioned_parquet(spark, root).where("yyyy = 2021")
    assert sorted(r["id"] for r in found.collect()) == [1, 4, 7, 10, 13, 16, 19]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan
