"""Level counts and application timeline kept up to date as log files arrive.

The same parse expressions and aggregates as the batch jobs, run by
Structured Streaming over the file source: each micro-batch reads only new
files, the running aggregates live in the state store (checkpointed in the
given location, so a restarted query resumes where it stopped).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.functions.parse import parse_lines


def log_line_stream(spark: SparkSession, path: str, glob: str = "*.log", max_files: int = 1000) -> DataFrame:
    return (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", str(max_files))
        .load(path)
        .withColumnRenamed("value", "line")
    )


def streaming_level_counts(lines: DataFrame) -> DataFrame:
    """Running ``log_level, count`` (complete or update output mode)."""
    parsed = parse_lines(lines)
    return parsed.groupBy("log_level").agg(F.count(F.lit(1)).alias("count")).filter(F.col("log_level") != "")


def streaming_timeline(lines: DataFrame) -> DataFrame:
    """Running first/last mention per application (update output mode)."""
    parsed = parse_lines(lines)
    return (
        parsed.groupBy("cluster_id", "application_id")
        .agg(F.min("event_time").alias("start_time"), F.max("event_time").alias("end_time"))
        .filter((F.col("application_id") != "") & F.col("start_time").isNotNull())
    )


def app_sessions(lines: DataFrame, gap: str = "1 hour") -> DataFrame:
    """Activity sessions per application: runs of mentions no more than ``gap``
    apart, with first and last time and line count. Works on batch and
    streaming frames alike."""
    parsed = parse_lines(lines).filter((F.col("application_id") != "") & F.col("event_time").isNotNull())
    return parsed.groupBy("cluster_id", "application_id", F.session_window("event_time", gap).alias("session")).agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.count(F.lit(1)).alias("lines"),
    )


def streaming_app_sessions(lines: DataFrame, gap: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """``app_sessions`` with bounded state: the watermark (``delay`` behind the
    newest time seen) closes a session once no line can extend it, emits it in
    append mode and drops its state. Lines later than the watermark are not
    counted."""
    parsed = parse_lines(lines).filter((F.col("application_id") != "") & F.col("event_time").isNotNull())
    # watermarks need a zoned timestamp; the (UTC) session makes the cast exact
    parsed = parsed.withColumn("event_time", F.col("event_time").cast("timestamp")).withWatermark("event_time", delay)
    agg = parsed.groupBy("cluster_id", "application_id", F.session_window("event_time", gap).alias("session")).agg(
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.count(F.lit(1)).alias("lines"),
    )
    return agg.withColumns(
        {"start_time": F.col("start_time").cast("timestamp_ntz"), "end_time": F.col("end_time").cast("timestamp_ntz")}
    )


def start_to_table(agg: DataFrame, name: str, checkpoint: str, mode: str = "complete", available_now: bool = True):
    """Run an aggregate stream into an in-memory table ``name`` (tests, notebooks only:
    the memory sink lives in the driver)."""
    writer = agg.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def start_to_parquet(agg: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Write each complete aggregate to a folder of its own, ``path/batch=<id>``.

    Each micro-batch of a complete-mode aggregate carries the whole (small)
    result. Readers take the newest finished one (``read_newest``), so none reads a
    table that is being replaced; a retried batch rewrites its own folder only. A batch without
    rows leaves a folder too. Older folders stay until the caller removes them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # one task, so that a result without rows is a file too
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = agg.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest result that ``start_to_parquet`` has finished, which may hold no rows."""
    files = spark.read.parquet(path).inputFiles()  # a batch's files appear when it is finished
    newest = max(int(re.search(r"/batch=(\d+)/[^/]*$", f)[1]) for f in files)
    return spark.read.parquet(f"{path}/batch={newest}")
