"""Named queries over the driver tables: one callable ``(spark, root) -> DataFrame`` per key.

Log queries read ``events``, derive log lines from it and parse the columns that they
use. The ``file_*`` queries derive lines of container files, whose application comes from
the path. Trip queries read ``lineitem``; text queries read ``documents``. Every query
covers its whole table (the trip queries: the year that the job asks for).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.functions.csv_text import csv_line
from lograft.functions.parse import parse_lines, parse_log_time_strict, with_identity
from lograft.operators import daily, distribution, levels, memory, messages, multiline, quantiles, sketches, timeline
from lograft.operators.joins import join_groups
from lograft.session import materialize
from lograft.sources.event_lines import container_lines_from_events, log_lines_from_events
from lograft.sources.sets import union_by_name
from lograft.sources.tables import sql_on, table

Query = Callable[[SparkSession, str], DataFrame]


def lines(spark: SparkSession, root: str) -> DataFrame:
    """``event_id, line``: the raw log lines."""
    return log_lines_from_events(table(spark, root, "events"))


def parsed(spark: SparkSession, root: str) -> DataFrame:
    """The log lines with their parsed columns; each query computes those that it uses."""
    return parse_lines(lines(spark, root))


def file_lines(spark: SparkSession, root: str) -> DataFrame:
    """The lines of container files, parsed, with the application, attempt and container of the path."""
    return with_identity(file_parsed(spark, root))


def file_parsed(spark: SparkSession, root: str) -> DataFrame:
    """The lines of container files, parsed."""
    return parse_lines(container_lines_from_events(table(spark, root, "events")))


def _timeline(spark, root):
    """The timeline (one row per application), computed once per query: the
    sweeps, lookups and distributions below read it several times."""
    return materialize(timeline.app_timeline(parsed(spark, root)))


def _lookup(spark, root):
    tl = _timeline(spark, root)
    return timeline.with_cluster_lookup(tl, timeline.cluster_summary(tl))


def _durations(spark, root):
    tl = _timeline(spark, root)
    return distribution.top_cluster_durations(tl, timeline.cluster_summary(tl))


def _file_durations(spark, root):
    """Durations of the applications of the busiest cluster, by file."""
    tl = materialize(timeline.timeline_by_file(file_lines(spark, root)))
    return distribution.top_cluster_durations(tl, timeline.cluster_summary(tl))


def _tasks(spark, root):
    return messages.task_events(parsed(spark, root))


def _file_tasks(spark, root):
    return messages.task_events(file_lines(spark, root))


def _cached(spark, root):
    return memory.cached_over_time(memory.block_changes(parsed(spark, root)))


def _file_summary(spark, root):
    return timeline.cluster_summary(materialize(timeline.timeline_by_file(file_lines(spark, root))))


def _trips(spark, root):
    return daily.trips_from_lineitem(table(spark, root, "lineitem"))


def _container_roles(spark, root):
    """Files and lines by attempt and role of the container."""
    named = file_lines(spark, root).groupBy("path", "container_id", "attempt", "container_role").agg(
        F.count(F.lit(1)).alias("lines")
    )
    return named.groupBy("attempt", "container_role").agg(
        F.count(F.lit(1)).alias("files"), F.count_distinct("container_id").alias("containers"), F.sum("lines").alias("lines")
    )


def _level_order(spark, root):
    """Levels with their position in the report's order (SRT1): by count, then name."""
    ranked = levels.level_counts(parsed(spark, root)).orderBy(F.desc("count"), F.asc("log_level"))
    whole = ranked.agg(F.array_sort(F.collect_list(F.struct(-F.col("count"), "log_level"))).alias("all"))  # a row per level
    return whole.select(F.posexplode("all").alias("position", "l")).select("position", F.col("l.log_level").alias("log_level"))


def _strict_times(spark, root):
    """The times at the heads of log lines that hold a valid one, read strictly."""
    head = F.regexp_extract("line", r"^(\d{2}/(?:0\d|1[0-2])/\d{2} \d{2}:\d{2}:\d{2}) ", 1)
    valid = lines(spark, root).select(F.explode(F.array(head)).alias("head"), "event_id").where("head <> ''")
    return valid.select("event_id", parse_log_time_strict("head").alias("event_time"))


def _union(spark, root):
    """Three files of different columns as one table (SRC3): rows, ids, marks and characters by file."""
    paths = [f"{root}/{name}.parquet" for name in ("documents", "labels", "benchmark")]
    rows = union_by_name(spark, paths, source="file")
    name = F.regexp_extract("file", r"/([a-z]+)\.parquet", 1)
    return rows.groupBy(name.alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("n_doc_id"), F.count("item_id").alias("n_item_id"),
        F.sum("quality").alias("quality"), F.sum("n_chars").alias("n_chars"), F.sum(F.length("text")).alias("text_chars"),
    )


def _fare_quantiles(spark, root):
    """Quantiles of fares per month and of all, from one stored sketch per day (AGG7)."""
    trips = daily.with_day(_trips(spark, root), "tpep_pickup_datetime")
    days = materialize(sketches.value_sketches(trips, daily.DAY_KEYS, "fare_amount"))
    merged = sketches.month_and_all(days, sketches.merge_values)
    bounds = {f"p{q}": sketches.value_bounds(q / 100) for q in (50, 95)}
    return merged.select(
        "level", "dt_year", "dt_month", "n", *[c.alias(f"{p}_{end}") for p, b in bounds.items() for c, end in zip(b, ("low", "high"), strict=True)]
    )


def _price_sketch(spark, root):
    keys = ["l_returnflag", "l_linestatus"]
    found = sketches.value_sketches(table(spark, root, "lineitem"), keys, "l_extendedprice")
    low, high = sketches.value_bounds(0.95)
    return found.select(*keys, "n", low.alias("p95_low"), high.alias("p95_high"))


def _distinct_users(spark, root):
    """Distinct users per month and of all, from one stored sketch per day (AGG16): the exact counts, and
    whether the merged estimates lie within three standard errors of them."""
    events = daily.with_day(table(spark, root, "events"), "ts").withColumn("user_id", F.col("user_id").cast("bigint"))
    days = materialize(sketches.distinct_sketches(events, daily.DAY_KEYS, "user_id"))
    estimates = sketches.month_and_all(days, sketches.merge_distinct)
    users = materialize(events.groupBy("dt_year", "dt_month", "user_id").agg(F.lit(1).alias("_one")))
    exact = users.groupBy("dt_year", "dt_month").agg(F.count(F.lit(1)).alias("num_users")).withColumn("level", F.lit("month"))
    every = users.groupBy("user_id").agg(F.lit(1).alias("_one")).agg(F.count(F.lit(1)).alias("num_users"))
    every = every.select(F.lit("all").alias("level"), F.lit(None).cast("int").alias("dt_year"), F.lit(None).cast("int").alias("dt_month"), "num_users")
    on = ["level", "dt_year", "dt_month"]
    both = join_groups(exact.unionByName(every).select(*on, "num_users"), estimates, on)
    off = F.abs(sketches.distinct_estimate() - F.col("num_users")) / F.col("num_users")
    return both.select(*on, "num_users", (off <= sketches.distinct_error()).alias("within_error"))


def _timeline_csv(spark, root):
    """The timeline as CSV lines with ISO times and zone (SNK1, SNK2), each with its place in the written
    order (SRT2: by cluster, start and id)."""
    tl = timeline.app_timeline(parsed(spark, root))
    at = lambda c: F.col(c).cast("timestamp").alias(c)
    return tl.select("application_id", csv_line("cluster_id", "application_id", "app_number", at("start_time"), at("end_time")).alias("csv"))


def _lines_csv(spark, root):
    """Every log line as a CSV line: quoted where it must be (SNK3)."""
    return parsed(spark, root).select("event_id", csv_line("event_id", "log_level", "line", "event_time", timestamp_format="yyyy-MM-dd HH:mm:ss").alias("csv"))


TRIP_YEAR = 1996


def _sql_even_keys(spark, root):
    return sql_on(
        spark,
        table(spark, root, "orders"),
        "orders_view",
        "SELECT COUNT(*) AS total, SUM(o_orderkey * 2) AS doubled_sum FROM orders_view WHERE o_orderkey % 2 = 0",
    )


QUERIES: dict[str, Query] = {
    # level distribution
    "level_counts": lambda s, r: levels.level_counts(parsed(s, r)),
    "level_share": lambda s, r: levels.level_share(parsed(s, r)),
    "level_totals": lambda s, r: levels.level_totals(parsed(s, r)),
    "level_counts_unfiltered": lambda s, r: levels.level_counts_unfiltered(parsed(s, r)),
    "level_tokens_all": lambda s, r: levels.level_token_counts(lines(s, r)),
    "component_counts": lambda s, r: levels.component_counts(parsed(s, r), 20),
    "log_sample": lambda s, r: levels.sample_lines(parsed(s, r), 10, "42"),
    "line_inventory": lambda s, r: levels.line_inventory(parsed(s, r)),
    "error_lines": lambda s, r: levels.lines_containing(lines(s, r), "ERROR").select("event_id", "line"),
    # application timeline and cluster usage
    "app_timeline": lambda s, r: timeline.app_timeline(parsed(s, r)).select(
        "cluster_id", "application_id", "app_number", "start_time", "end_time"
    ),
    "cluster_summary": lambda s, r: timeline.cluster_summary(timeline.app_timeline(parsed(s, r))),
    "cluster_stats": lambda s, r: timeline.cluster_stats(timeline.cluster_summary(timeline.app_timeline(parsed(s, r)))),
    # the summary is read twice (clusters and their count histogram): built on the materialised timeline
    "cluster_rank": lambda s, r: timeline.cluster_rank(timeline.cluster_summary(_timeline(s, r))),
    "top_clusters": lambda s, r: timeline.most_used_clusters(
        timeline.cluster_summary(timeline.app_timeline(parsed(s, r))), 5
    ),
    "app_gaps": lambda s, r: timeline.app_gaps(_timeline(s, r)),
    "peak_concurrency": lambda s, r: timeline.peak_concurrency(_timeline(s, r)),
    "app_overlaps": lambda s, r: timeline.app_overlap_counts(_timeline(s, r)),
    "longest_overlap": lambda s, r: timeline.longest_overlap(timeline.app_timeline(parsed(s, r))),
    "file_longest_overlap": lambda s, r: timeline.longest_overlap(timeline.timeline_by_file(file_lines(s, r))),
    "cluster_start_lookup": lambda s, r: _lookup(s, r),
    "duration_histogram": lambda s, r: distribution.histogram(_durations(s, r), 30),
    "duration_density": lambda s, r: distribution.density(_durations(s, r), 200, 3.0),
    "duration_histogram_log": lambda s, r: distribution.histogram(_file_durations(s, r), 20, log_scale=True),
    "duration_histogram_clusters": lambda s, r: distribution.histogram(distribution.all_durations(_timeline(s, r)), 30),
    "duration_density_clusters": lambda s, r: distribution.density(
        distribution.all_durations(_timeline(s, r)), 100, 3.0, 9
    ),
    # daily KPIs
    "daily_trips": lambda s, r: daily.daily_summary(_trips(s, r), TRIP_YEAR),
    "daily_trips_exact": lambda s, r: daily.daily_summary(_trips(s, r), TRIP_YEAR, exact_p95=True),
    "daily_totals": lambda s, r: daily.daily_totals(daily.daily_summary(_trips(s, r), TRIP_YEAR)),
    "daily_range": lambda s, r: daily.daily_range(daily.daily_summary(_trips(s, r), TRIP_YEAR)),
    "daily_newest": lambda s, r: daily.newest_days(daily.daily_summary(_trips(s, r), TRIP_YEAR), 10).select(
        "position", *daily.DAY_KEYS, "num_trips"
    ),
    "daily_events": lambda s, r: daily.daily_metrics(table(s, r, "events"), "ts", "value", "user_id"),
    "price_p95_exact": lambda s, r: quantiles.exact_percentile(
        table(s, r, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.95, "p95_price"
    ),
    "price_p95_approx": _price_sketch,
    "fare_quantiles": _fare_quantiles,
    "distinct_users": _distinct_users,
    # tasks
    "task_durations": lambda s, r: messages.task_durations(_tasks(s, r)),
    "unfinished_tasks": lambda s, r: messages.unfinished_tasks(_tasks(s, r)),
    "task_retries": lambda s, r: messages.task_retries(_tasks(s, r)),
    "stage_skew": lambda s, r: messages.stage_skew(messages.task_durations(_tasks(s, r)), 2.0),
    "slow_tasks": lambda s, r: messages.slow_tasks(messages.task_durations(_tasks(s, r)), 10),
    # message extractors
    "executor_requests": lambda s, r: messages.requested_resources(messages.executor_requests(parsed(s, r))),
    "container_requests": lambda s, r: messages.requests_per_host(messages.container_requests(parsed(s, r))),
    "input_splits": lambda s, r: messages.bytes_per_input(messages.input_splits(parsed(s, r))),
    "python_times": lambda s, r: messages.python_time_stats(messages.python_times(parsed(s, r))),
    "memory_capacity": lambda s, r: messages.capacity_per_app(messages.memory_capacity(parsed(s, r))),
    "block_bytes": lambda s, r: messages.cached_bytes_per_kind(messages.stored_blocks(parsed(s, r))),
    "broadcast_reads": lambda s, r: messages.broadcast_reads_per_app(messages.broadcast_reads(parsed(s, r))),
    "block_hosts": lambda s, r: messages.blocks_per_host(messages.added_blocks(parsed(s, r))),
    "local_blocks": lambda s, r: messages.local_hits_per_rdd(messages.local_block_hits(parsed(s, r))),
    "cache_timeline": lambda s, r: _cached(s, r).select(
        "event_id", "host", "application_id", "block", "size_bytes", "cached_bytes"
    ),
    "cache_peaks": lambda s, r: memory.cache_peaks(_cached(s, r)),
    "cache_hit_share": lambda s, r: memory.hit_share(parsed(s, r)),
    "error_rate": lambda s, r: messages.error_rate(parsed(s, r)),
    # multi-line entries and line numbers
    "multiline_entries": lambda s, r: multiline.assemble_entries(parsed(s, r)),
    "document_line_counts": lambda s, r: multiline.line_counts(table(s, r, "documents")),
    # SQL on a temp view
    "sql_even_keys": _sql_even_keys,
    # container files: application, attempt and container from the path
    "file_inventory": lambda s, r: levels.log_inventory(file_lines(s, r)),
    "files_per_application": lambda s, r: timeline.app_file_counts(file_lines(s, r), 10),
    "container_roles": _container_roles,
    "file_timeline": lambda s, r: timeline.timeline_by_file(file_lines(s, r)),
    "file_cluster_rank": lambda s, r: timeline.cluster_rank(_file_summary(s, r)),
    "file_task_durations": lambda s, r: messages.task_durations(_file_tasks(s, r)),
    "file_unfinished_tasks": lambda s, r: messages.unfinished_tasks(_file_tasks(s, r)),
    "file_task_retries": lambda s, r: messages.task_retries(_file_tasks(s, r)),
    "file_stage_skew": lambda s, r: messages.stage_skew(messages.task_durations(_file_tasks(s, r)), 2.0),
    "file_slow_tasks": lambda s, r: messages.slow_tasks(messages.task_durations(_file_tasks(s, r)), 10),
    "file_executor_requests": lambda s, r: messages.requested_resources(messages.executor_requests(file_lines(s, r))),
    "file_python_times": lambda s, r: messages.python_time_stats(messages.python_times(file_lines(s, r))),
    "file_memory_capacity": lambda s, r: messages.capacity_per_app(messages.memory_capacity(file_lines(s, r))),
    "file_broadcast_reads": lambda s, r: messages.broadcast_reads_per_app(messages.broadcast_reads(file_lines(s, r))),
    "file_error_rate": lambda s, r: messages.error_rate(file_lines(s, r)),
    "file_entries": lambda s, r: multiline.assemble_entries(file_parsed(s, r), ["path"], "line_no"),
    "file_line_entries": lambda s, r: multiline.tag_entries(file_parsed(s, r), ["path"], "line_no").drop("line"),
    "document_lines": lambda s, r: multiline.numbered_lines(table(s, r, "documents"), "doc_id", "text"),
    # order and source semantics
    "level_order": _level_order,
    "strict_times": _strict_times,
    "table_union": _union,
    # CSV text
    "timeline_csv": _timeline_csv,
    "lines_csv": _lines_csv,
}

# Keys whose result has no SQL oracle.
NO_ORACLE: set[str] = set()


def flagship(spark: SparkSession, root: str) -> DataFrame:
    """Level distribution with shares: the level job's headline output."""
    return levels.level_share(parsed(spark, root)).orderBy(F.desc("count"), F.asc("log_level"))
