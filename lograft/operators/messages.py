"""Typed columns from documented message formats, and the queries on top.

Each extractor tests a cheap substring first, then matches the line once: the match's
groups become an array behind a generator of one row, which neither the filter on it nor
the columns taken from it are merged into. The application of a line is
the column ``application_id``, whether it comes from the text or from the file's path
(``functions.parse.with_identity``); with an ``attempt`` column, tasks are told apart by
attempt too, since their ids start anew with each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lograft.functions import patterns as P
from lograft.functions.parse import size_to_bytes

_MARK = "\x01"


def matched(parsed: DataFrame, pattern: str, line_col: str) -> DataFrame:
    """The lines that match a message format, with its groups as array ``_g`` (``_g[1]`` is the
    first; a group that took no part is ``''``)."""
    line = F.col(line_col)
    likely = F.lit(False)
    for marker in P.MARKERS[pattern]:
        likely = likely | line.contains(marker)
    n = re.compile(pattern).groups
    groups = F.regexp_replace(line, f"(?s)^.*?{pattern}.*$", "".join(f"{_MARK}${i}" for i in range(1, n + 1)))
    rows = parsed.filter(likely).select("*", F.explode(F.array(F.split(groups, _MARK))).alias("_g"))
    return rows.filter(F.size("_g") == n + 1)


def text(i: int) -> Column:
    return F.col("_g")[i]


def num(i: int, to: str = "bigint") -> Column:
    return text(i).try_cast(to)


def _ids(parsed: DataFrame) -> list[str]:
    return [c for c in ("application_id", "attempt") if c in parsed.columns]


# ---------------------------------------------------------------- X1
def executor_requests(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.EXECUTOR_REQUEST, line_col)
    return rows.select(
        "application_id",
        num(1).alias("executors"),
        num(2).alias("cores"),
        num(3).alias("memory_mb"),
        num(4).alias("overhead_mb"),
    )


def requested_resources(requests: DataFrame) -> DataFrame:
    """Requested executors, cores and memory per application (X1 query)."""
    return requests.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("num_requests"),
        F.sum("executors").alias("total_executors"),
        F.sum(F.col("executors") * F.col("cores")).alias("total_cores"),
        F.sum(F.col("executors") * F.col("memory_mb")).alias("total_memory_mb"),
        F.max("memory_mb").alias("max_memory_mb"),
        F.count("overhead_mb").alias("requests_with_overhead"),
    )


# ---------------------------------------------------------------- X2
def container_requests(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.CONTAINER_REQUEST, line_col)
    return rows.select("application_id", text(1).alias("host"), num(2).alias("memory_mb"), num(3).alias("vcores"))


def requests_per_host(requests: DataFrame) -> DataFrame:
    return requests.groupBy("host").agg(
        F.count(F.lit(1)).alias("num_requests"),
        F.sum("memory_mb").alias("total_memory_mb"),
        F.sum("vcores").alias("total_vcores"),
    )


# ---------------------------------------------------------------- X3, J2, J4
def task_events(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    """One row per ``Running task`` / ``Finished task`` line."""
    rows = matched(parsed, P.TASK_LINE, line_col)
    return rows.select(
        *_ids(parsed),
        F.lower(text(1)).alias("kind"),
        num(6).alias("tid"),
        num(4, "int").alias("stage_id"),
        num(5, "int").alias("stage_attempt"),
        num(2, "int").alias("task_index"),
        num(3, "int").alias("task_attempt"),
        num(7).alias("result_bytes"),
        "event_time",
    )


def task_table(events: DataFrame) -> DataFrame:
    """Start and finish of every task in one shuffle keyed by application, attempt (where known)
    and task id (J2).

    Conditional aggregates replace a self-join of start lines with finish
    lines: one exchange instead of two, and no join fan-out on repeated lines.
    """
    is_run = F.col("kind") == "running"
    is_fin = F.col("kind") == "finished"
    keep = (F.col("application_id") != "") & F.col("tid").isNotNull()
    return events.groupBy(*_ids(events), "tid").agg(
        F.min(F.when(is_run, F.col("stage_id"))).alias("stage_id"),
        F.min(F.when(is_run, F.col("event_time"))).alias("start_time"),
        F.max(F.when(is_fin, F.col("event_time"))).alias("end_time"),
        F.max(F.when(is_fin, F.col("result_bytes"))).alias("result_bytes"),
        F.count_if(is_run).alias("_runs"),
        F.count_if(is_fin).alias("_fins"),
    ).filter(keep)


def task_durations(events: DataFrame) -> DataFrame:
    """Tasks with both a start and a finish line, and their duration in seconds."""
    t = task_table(events).filter((F.col("_runs") > 0) & (F.col("_fins") > 0))
    return t.select(
        *_ids(t), "tid", "stage_id", "start_time", "end_time",
        F.expr("timestampdiff(SECOND, start_time, end_time)").alias("duration_sec"),
        "result_bytes",
    )


def unfinished_tasks(events: DataFrame) -> DataFrame:
    """Tasks that started but have no finish line."""
    t = task_table(events).filter((F.col("_runs") > 0) & (F.col("_fins") == 0))
    return t.select(*_ids(t), "tid", "stage_id", "start_time")


def task_attempts(events: DataFrame) -> DataFrame:
    """Every try of every task (X3): the tries of one task (application, container attempt, stage,
    stage attempt, index) in order of their attempt number, each with the next one's start.

    One exchange keyed by the task serves the aggregate (start and finish line of a try) and the window.
    """
    task = [*_ids(events), "stage_id", "stage_attempt", "task_index"]
    is_run, is_fin = F.col("kind") == "running", F.col("kind") == "finished"
    known = events.filter((F.col("application_id") != "") & F.col("tid").isNotNull())
    tries = known.repartition(*task).groupBy(*task, "task_attempt", "tid").agg(
        F.min(F.when(is_run, F.col("event_time"))).alias("start_time"),
        F.max(F.when(is_fin, F.col("event_time"))).alias("end_time"),
        F.bool_or(is_fin).alias("finished"),
    )
    order = Window.partitionBy(*task).orderBy("task_attempt", F.col("start_time").asc_nulls_first(), "tid")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    return tries.withColumns(
        {
            "next_start": F.lead("start_time").over(order),
            "done_before": F.coalesce(F.bool_or("finished").over(upto), F.lit(False)),
        }
    )


def task_retries(events: DataFrame) -> DataFrame:
    """Tasks that were tried more than once (X3): tries, finished ones, the attempt that first
    succeeded, whether only a later one did, and the time lost in those before it.

    A try that did not succeed lasted until its task's next try began; where that is unknown, or
    times run backwards, it counts no time. Tries after the first success lost nothing.
    """
    tries = task_attempts(events)
    task = [*_ids(events), "stage_id", "stage_attempt", "task_index"]
    lost = F.greatest(F.expr("timestampdiff(SECOND, start_time, next_start)"), F.lit(0))
    grouped = tries.groupBy(*task).agg(
        F.count(F.lit(1)).alias("num_attempts"),
        F.count_if("finished").alias("finished_attempts"),
        F.max("task_attempt").alias("last_attempt"),
        F.min(F.when(F.col("finished"), F.col("task_attempt"))).alias("succeeded_on"),
        F.bool_or(~F.col("finished") & ~F.col("done_before")).alias("_failed"),
        F.coalesce(F.sum(F.when(~F.col("finished") & ~F.col("done_before"), lost)), F.lit(0)).alias("lost_sec"),
    )
    recovered = F.col("_failed") & F.col("succeeded_on").isNotNull()
    return grouped.filter("num_attempts > 1").withColumn("recovered", recovered).drop("_failed")


def stage_skew(durations: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Duration spread per stage (X11): max, median, p95, max/median, skew flag.

    Durations are whole seconds, so a stage has few distinct ones: they are counted
    first, and the exact percentiles come from the counts. A median below one second
    counts as one second, so a stage of many short tasks and a long one is skewed.
    """
    d = durations.filter(F.col("duration_sec").isNotNull())
    keys = [*_ids(d), "stage_id"]
    counts = d.groupBy(*keys, "duration_sec").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy("duration_sec").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(Window.partitionBy(*keys))})
    at = lambda p: F.min(F.when(F.col("_upto") >= F.ceil(F.lit(p) * F.col("_all")), F.col("duration_sec")))
    g = ranked.groupBy(*keys).agg(
        F.sum("_n").alias("num_tasks"),
        F.max("duration_sec").alias("max_sec"),
        at(0.5).alias("median_sec"),
        at(0.95).alias("p95_sec"),
    )
    ratio = F.col("max_sec").cast("double") / F.greatest(F.col("median_sec"), F.lit(1)).cast("double")
    return g.withColumn("max_over_median", ratio).withColumn("is_skewed", F.col("max_over_median") > F.lit(threshold))


def slow_tasks(durations: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` slowest tasks overall (X12): a top-k, per-task heaps then one merge."""
    d = durations.filter(F.col("duration_sec").isNotNull())
    return d.orderBy(F.desc("duration_sec"), *[F.asc(c) for c in _ids(d)], F.asc("tid")).limit(k).select(
        *_ids(d), "tid", "stage_id", "duration_sec"
    )


# ---------------------------------------------------------------- X4
def input_splits(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.INPUT_SPLIT, line_col)
    return rows.select("application_id", text(1).alias("uri"), num(2).alias("offset"), num(3).alias("length"))


def bytes_per_input(splits: DataFrame) -> DataFrame:
    return splits.groupBy("uri").agg(
        F.count(F.lit(1)).alias("num_splits"),
        F.sum("length").alias("total_bytes"),
        F.min("offset").alias("min_offset"),
        F.max(F.col("offset") + F.col("length")).alias("end_offset"),
    )


# ---------------------------------------------------------------- X5
def python_times(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.PYTHON_TIMES, line_col)
    names = ["total_ms", "boot_ms", "init_ms", "finish_ms"]
    return rows.select("application_id", *[num(i).alias(n) for i, n in enumerate(names, 1)])


def python_time_stats(times: DataFrame) -> DataFrame:
    return times.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("num_runs"),
        F.sum("total_ms").alias("sum_total_ms"),
        F.avg("total_ms").alias("avg_total_ms"),
        F.max("boot_ms").alias("max_boot_ms"),
        F.sum("init_ms").alias("sum_init_ms"),
        F.sum("finish_ms").alias("sum_finish_ms"),
    )


# ---------------------------------------------------------------- X6
def memory_capacity(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.MEMORY_STORE, line_col)
    return rows.select("application_id", size_to_bytes(text(1), text(2)).alias("capacity_bytes"))


def capacity_per_app(capacity: DataFrame) -> DataFrame:
    return capacity.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("num_stores"),
        F.max("capacity_bytes").alias("max_capacity_bytes"),
        F.min("capacity_bytes").alias("min_capacity_bytes"),
    )


# ---------------------------------------------------------------- X7
def stored_blocks(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.BLOCK_STORED, line_col)
    return rows.select(
        "application_id",
        text(1).alias("block"),
        text(2).alias("kind"),
        size_to_bytes(text(3), text(4)).alias("size_bytes"),
        size_to_bytes(text(5), text(6)).alias("free_bytes"),
    )


def cached_bytes_per_kind(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("kind").agg(
        F.count(F.lit(1)).alias("num_blocks"),
        F.sum("size_bytes").alias("total_bytes"),
        F.max("size_bytes").alias("max_bytes"),
        F.min("free_bytes").alias("min_free_bytes"),
    )


# ---------------------------------------------------------------- X8
def broadcast_reads(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.BROADCAST_READ, line_col)
    return rows.select("application_id", num(1).alias("broadcast_id"))


def broadcast_reads_per_app(reads: DataFrame) -> DataFrame:
    return reads.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("num_reads"),
        F.count_distinct("broadcast_id").alias("distinct_broadcasts"),
    )


# ---------------------------------------------------------------- X9
def added_blocks(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.BLOCK_ADDED, line_col)
    return rows.select(
        "application_id",
        text(1).alias("block"),
        text(2).alias("host"),
        num(3, "int").alias("port"),
        size_to_bytes(text(4), text(5)).alias("size_bytes"),
    )


def blocks_per_host(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("host").agg(
        F.count(F.lit(1)).alias("num_blocks"),
        F.sum("size_bytes").alias("total_bytes"),
    )


def local_block_hits(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    rows = matched(parsed, P.BLOCK_LOCAL, line_col)
    return rows.select("application_id", num(1).alias("rdd_id"), num(2).alias("partition"))


def local_hits_per_rdd(hits: DataFrame) -> DataFrame:
    return hits.groupBy("rdd_id").agg(
        F.count(F.lit(1)).alias("num_local_hits"),
        F.count_distinct("partition").alias("distinct_partitions"),
    )


# ---------------------------------------------------------------- X10
def error_rate(parsed: DataFrame) -> DataFrame:
    """ERROR lines over lines with a level, per application.

    Levels are counted conditionally inside the aggregate (no filter on the
    derived level column, which would evaluate its regex a second time);
    applications without a levelled line are dropped afterwards.
    """
    has_level = F.col("log_level") != ""
    g = parsed.groupBy("application_id").agg(
        F.count_if(has_level).alias("level_lines"),
        F.count_if(F.col("log_level") == "ERROR").alias("error_lines"),
    )
    g = g.filter((F.col("application_id") != "") & (F.col("level_lines") > 0))
    return g.withColumn("error_rate", F.col("error_lines") / F.col("level_lines"))
